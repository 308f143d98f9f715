"""What to load and how: one small record per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

# Fixed values.
DISPOSITIONS = ("replace", "append", "merge")
STRATEGIES = ("timestamp", "sequence", "custom")
DEFAULT_CHUNK_ROWS = 10_000


@dataclass(frozen=True)
class Incremental:
    """Watermark settings. `initial` is the bound of the first run."""

    column: str
    initial: Any
    strategy: str = "timestamp"

    def __post_init__(self) -> None:
        if not self.column:
            raise ValueError("an incremental load needs a watermark column")
        if self.initial is None:
            raise ValueError("an incremental load needs an initial value")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown incremental strategy {self.strategy!r}")


@dataclass(frozen=True)
class TableSpec:
    """One table to load.

    `source` is a catalog table, a path, or the label of a query; `query` replaces the
    table by the result of a SQL text and `where` filters it. `source_types` holds declared
    source types by column, `hints` the target types that win over derived ones. With
    `merge_on_read` a merge writes its own rows only, which are resolved when read. With `evolve`
    the destination takes over new columns and wider types of the source; a narrower type is an
    error in any case.
    """

    source: str
    destination: str | None = None
    disposition: str = "replace"
    primary_key: Sequence[str] = ()
    order_by: Sequence[str] = ()
    incremental: Incremental | None = None
    where: str | None = None
    query: str | None = None
    columns: Sequence[str] = ()
    source_types: Mapping[str, str] = field(default_factory=dict)
    hints: Mapping[str, str] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    naming: str = "direct"
    chunk_rows: int = DEFAULT_CHUNK_ROWS
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    enabled: bool = True
    merge_on_read: bool = False
    evolve: bool = False

    def __post_init__(self) -> None:
        if not self.source:
            raise ValueError("a table needs a source")
        if self.disposition not in DISPOSITIONS:
            raise ValueError(f"unknown disposition {self.disposition!r}")
        if self.disposition == "merge" and not self.primary_key:
            raise ValueError("a merge needs a primary key")
        if self.merge_on_read and self.disposition != "merge":
            raise ValueError("merge_on_read is for merges")
        if self.chunk_rows <= 0:
            raise ValueError("chunk_rows must be positive")

    @property
    def target(self) -> str:
        """Destination name: the last segment of the source name, lower-cased, by default."""
        return self.destination or table_label(self.source)


def table_label(source: str) -> str:
    name = source.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
    return name.rsplit(".", 1)[-1].lower()


def split_name(source: str, default_schema: str = "dbo") -> tuple[str, str]:
    """Schema and table of a qualified name; everything after the first dot is the table."""
    schema, dot, table = source.partition(".")
    return (schema, table) if dot else (default_schema, source)
