"""What every load of a table has done: where it began, how far it came and how many rows it wrote.

The table `load_state` of a dataset has a partition for each destination and source with one row per load, which is
rewritten whenever a load ends: a few bytes a load, however large the destination. It says where the next load begins and
which loads hold rows from a bound on, so that the destination is not read for either.

State follows the data: a row counts only for the version of the destination that it was written for, and a load whose
rows are there but whose state is not, as a crash between the two leaves it, is worked out from the files of that load.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from typing import Any
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.load import LOAD_ID, LOAD_SOURCE, Dataset

STATE = "load_state"
_COLUMNS = "number INT, load_id STRING, began STRING, bound STRING, highest STRING, kind STRING, rows BIGINT, version STRING"


@dataclass(frozen=True)
class LoadState:
    """One load. `bound` is the watermark after it, `highest` that of its own rows; `load_id` is None for all that was
    loaded before states were kept."""

    number: int
    load_id: str | None
    began: Any
    bound: Any
    highest: Any
    rows: int | None
    version: str


def bound_text(value: Any) -> str | None:
    return None if value is None else value.isoformat() if isinstance(value, date) else str(value)


def bound_kind(value: Any) -> str | None:
    """Type of a watermark as it is kept; datetimes are without zone."""
    kinds = ((datetime, "timestamp_ntz"), (date, "date"), (int, "bigint"), (float, "double"), (Decimal, "decimal"), (str, "string"))
    return next((kind for type_, kind in kinds if isinstance(value, type_)), None)


def bound_value(text: str | None, kind: str | None) -> Any:
    parse = {"timestamp_ntz": datetime.fromisoformat, "date": date.fromisoformat, "bigint": int, "double": float, "decimal": Decimal}
    return None if text is None else parse.get(kind, str)(text)


class States:
    """The loads that one source has made into one table."""

    def __init__(self, dataset: Dataset, destination: str, source: str) -> None:
        self.dataset, self.destination, self.source = dataset, destination, source

    def all(self) -> list[LoadState]:
        """Loads in order, of the version that the destination has now; empty if there is none."""
        if not self.dataset.exists(STATE):
            return []
        mine = (F.col("destination") == self.destination) & (F.col("source") == self.source)
        found = self.dataset.read(STATE).where(mine).orderBy("number").collect()
        loads = [
            LoadState(
                row.number, row.load_id, bound_value(row.began, row.kind), bound_value(row.bound, row.kind),
                bound_value(row.highest, row.kind), row.rows, row.version,
            )
            for row in found
        ]
        version = self.dataset.version(self.destination)
        return loads if loads and loads[-1].version == version else []

    def put(self, loads: Sequence[LoadState]) -> None:
        """Keep these loads instead of what was kept before, for the version that the destination has now."""
        create_state(self.dataset)
        version = self.dataset.version(self.destination)
        rows = []
        for load in loads:
            kind = bound_kind(load.bound if load.bound is not None else load.began)
            texts = [bound_text(value) for value in (load.began, load.bound, load.highest)]
            rows.append((load.number, load.load_id, *texts, kind, load.rows, version, self.destination, self.source))
        frame = self.dataset.spark.createDataFrame(rows, f"{_COLUMNS}, destination STRING, source STRING")
        frame.coalesce(1).write.insertInto(self.dataset.table(STATE), overwrite=True)


def create_state(dataset: Dataset) -> None:
    dataset.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {dataset.table(STATE)} ({_COLUMNS}, destination STRING, source STRING) USING parquet "
        "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (destination, source)"
    )


def written_loads(dataset: Dataset, destination: str, source: str) -> set[str] | None:
    """Load ids under which a source has rows in a table, from its list of partitions; None where it has no such list."""
    try:
        listed = dataset.spark.sql(f"SHOW PARTITIONS {dataset.table(dataset.version(destination))}").collect()
    except AnalysisException:
        return None
    loads = set()
    for row in listed:
        values = dict(part.split("=", 1) for part in row[0].split("/"))
        if LOAD_ID not in values:
            return None
        if unquote(values.get(LOAD_SOURCE, source)) == source:
            loads.add(unquote(values[LOAD_ID]))
    return loads


def figures(rows: DataFrame, column: str) -> tuple[Any, int]:
    """Highest watermark and number of rows."""
    highest = F.max(column)
    if rows.schema[column].dataType.simpleString() == "timestamp":
        highest = highest.cast("timestamp_ntz")
    found = rows.agg(highest.alias("highest"), F.count(F.lit(1)).alias("rows")).first()
    return found.highest, found.rows


def later(one: Any, other: Any) -> Any:
    """The greater of two watermarks, either of which may be missing."""
    known = [value for value in (one, other) if value is not None]
    return max(known) if known else None


def repaired(loads: list[LoadState], missing: Sequence[str], rows_of, column: str) -> list[LoadState]:
    """The loads with those that were written but not noted, in no other order than that of their ids; only the files
    of these are read."""
    for load_id in sorted(missing):
        highest, rows = figures(rows_of(load_id), column)
        began = loads[-1].bound if loads else None
        number = loads[-1].number + 1 if loads else 1
        loads = [*loads, LoadState(number, load_id, began, later(began, highest), highest, rows, "")]
    return loads


def holding(loads: Sequence[LoadState], limit: Column, kind: str, dataset: Dataset) -> list[str] | None:
    """Ids of the loads that may hold rows from a bound on; None if rows from before states were kept may do so."""
    known = [(load.load_id, bound_text(load.highest)) for load in loads if load.highest is not None]
    if not known:
        return []
    frame = dataset.spark.createDataFrame(known, "load_id STRING, highest STRING")
    found = [row.load_id for row in frame.where(F.col("highest").cast(kind) >= limit).collect()]
    return None if None in found else found


def carry_over(dataset: Dataset, destination: str, old: str, new: str) -> None:
    """Let states of one version of a table count for another one that holds the same rows."""
    if not dataset.exists(STATE):
        return
    rows = dataset.read(STATE).where((F.col("destination") == destination) & (F.col("version") == old)).collect()
    if rows:
        frame = dataset.spark.createDataFrame(rows, dataset.read(STATE).schema).withColumn("version", F.lit(new))
        frame.coalesce(1).write.insertInto(dataset.table(STATE), overwrite=True)


def load_states(dataset: Dataset) -> DataFrame:
    """All loads that are known, with what each has written."""
    create_state(dataset)
    columns = ("destination", "source", "number", "load_id", "began", "bound", "highest", "rows")
    return dataset.read(STATE).select(*columns)
