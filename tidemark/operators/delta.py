"""Upserts that write their own rows only: changes beside a base, resolved when read, folded in now and then.

A merge adds a partition to the table of changes; the view of the destination takes the latest row of every key from
base and changes. While the changes are few, which every merge checks, their keys are broadcast and the base is scanned
without a shuffle. `compact`
folds them into the base: into a new version, or, where the base is partitioned by key columns, into the partitions
that the changes touch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import read_as_wider
from tidemark.operators.keys import latest_per_key, require_keys
from tidemark.operators.load import Dataset
from tidemark.operators.state import carry_over

CHANGE = "_change"  # number of the merge
CHANGE_LOAD = "_change_load"  # its load id
SHOWN, FEW = "tidemark.changes", "tidemark.few_changes"  # what a view resolves, and whether it broadcasts it
BROADCAST_ROWS = 1_000_000


def merge_delta(
    dataset: Dataset, name: str, df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
    load_id: str | None = None, by_order: bool = False, partition_by: Sequence[str] = (), evolve: bool = False,
) -> None:
    """Upsert into a table by writing the batch alone, its latest row of every key.

    Of several merges the last one counts for a key, or with `by_order` the row that is greatest by `order` and then by all
    other columns, whenever it came. A merge under a load id used before replaces what that wrote and keeps its place.
    With `evolve` the table takes over new columns and wider types; its changes are folded in before.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns of a merge must be key columns")
    latest = latest_per_key(require_keys(df, keys), keys, order)
    if not dataset.exists(name):
        dataset.replace(name, latest, partition_by)
        return
    if evolve and _is_new(dataset.stored(name).schema, latest.schema):
        compact(dataset, name)
        old = dataset.version(name)
        dataset.evolve(name, latest)
        carry_over(dataset, name, old, dataset.version(name))
    version = dataset.version(name)
    fitted = dataset._fitted(version, latest)
    changes = _changes(version)
    ranked = order if by_order else None
    if dataset.properties(name).get(SHOWN) != changes:
        _begin(dataset, name, version, changes, keys, ranked)
    load_id = load_id or uuid.uuid4().hex
    taken = _numbers(dataset, changes)
    number = taken.get(load_id, max(taken.values(), default=0) + 1)
    marked = fitted.withColumns({CHANGE: F.lit(number), CHANGE_LOAD: F.lit(load_id)})
    marked.write.insertInto(dataset.table(changes), overwrite=True)
    few = dataset.properties(name)[FEW] == "true"
    if few != (dataset.spark.table(dataset.table(changes)).count() <= BROADCAST_ROWS):
        _show(dataset, name, version, changes, keys, ranked, not few)


def _is_new(held: T.StructType, schema: T.StructType) -> bool:
    """Whether a batch has columns or wider types that a table lacks."""
    known = {field.name.lower(): field.dataType for field in held.fields}
    return any(
        field.name.lower() not in known or read_as_wider(known[field.name.lower()], field.dataType) for field in schema.fields
    )


def changed_rows(dataset: Dataset, name: str, load_id: str) -> DataFrame:
    """What a merge has written: its own files only. The first merge of a table wrote the base."""
    changes = dataset.properties(name).get(SHOWN)
    if changes is None:
        return dataset.read(name)
    return dataset.spark.table(dataset.table(changes)).where(F.col(CHANGE_LOAD) == load_id).drop(CHANGE, CHANGE_LOAD)


def change_share(dataset: Dataset, name: str) -> float:
    """Rows of the changes as a share of the base's; counts come from the files' footers."""
    changes = dataset.properties(name).get(SHOWN)
    if changes is None:
        return 0.0
    return dataset.spark.table(dataset.table(changes)).count() / max(1, dataset.stored(name).count())


def compact(dataset: Dataset, name: str) -> None:
    """Fold all changes into the base; the rows stay the same. A run that fails halfway can be run again."""
    changes = dataset.properties(name).get(SHOWN)
    if changes is None:
        return
    version = dataset.version(name)
    partition_by = dataset._partitions(version)
    if partition_by:
        base = dataset.stored(name)
        touched = dataset.spark.table(dataset.table(changes)).select(*partition_by).distinct()
        folded = dataset.read(name).join(touched, partition_by, "left_semi").select(*base.columns)
        folded.hint("rebalance", *partition_by).write.insertInto(dataset.table(version), overwrite=True)
        dataset._show(name, version)
        dataset.spark.sql(f"DROP TABLE {dataset.table(changes)}")
        return
    dataset.replace(name, dataset.read(name))
    carry_over(dataset, name, version, dataset.version(name))


def _changes(version: str) -> str:
    return "__c".join(version.rsplit("__v", 1))


def _begin(
    dataset: Dataset, name: str, version: str, changes: str, keys: Sequence[str], order: Sequence[str] | None
) -> None:
    """An empty table of changes, and a view that resolves them. A table left by a compaction is not taken up again."""
    fields = dataset.stored(name).schema.fields
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
    dataset.spark.sql(f"DROP TABLE IF EXISTS {dataset.table(changes)}")
    dataset.spark.sql(
        f"CREATE TABLE {dataset.table(changes)} ({columns}, {CHANGE} INT, {CHANGE_LOAD} STRING) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({CHANGE}, {CHANGE_LOAD})"
    )
    _show(dataset, name, version, changes, keys, order, True)


def _show(
    dataset: Dataset, name: str, version: str, changes: str, keys: Sequence[str], order: Sequence[str] | None, few: bool
) -> None:
    text = _resolved(dataset.table(version), dataset.table(changes), dataset.stored(name).columns, keys, order, few)
    dataset.view(name, text, {SHOWN: changes, FEW: str(few).lower()})


def _resolved(
    base: str, changes: str, columns: Sequence[str], keys: Sequence[str], order: Sequence[str] | None, few: bool
) -> str:
    """SELECT of the latest row of every key. Without an order all changes are later than the base."""
    hint = "/*+ BROADCAST(c) */" if few else ""
    others = [name for name in columns if name not in keys]
    ranked = [CHANGE, *others] if order is None else [*order, *[name for name in others if name not in order]]
    key, rank = _names(keys), _names(ranked)
    same = " AND ".join(f"b.`{name}` = c.`{name}`" for name in keys)
    result = ", ".join(f"`{name}`" if name in keys else f"_best.`{name}`" for name in columns)
    steps = [f"latest AS (SELECT {key}, max(struct({rank})) AS _best FROM {changes} GROUP BY {key})"]
    if order is not None:
        steps.append(f"held AS (SELECT {hint} {key}, struct({rank}) AS _best FROM {base} b LEFT SEMI JOIN latest c ON {same})")
        both = "SELECT * FROM latest UNION ALL SELECT * FROM held"
        steps.append(f"best AS (SELECT {key}, max(_best) AS _best FROM ({both}) GROUP BY {key})")
    return (
        f"WITH {', '.join(steps)} SELECT {hint} {_names(columns)} FROM {base} b LEFT ANTI JOIN latest c ON {same} "
        f"UNION ALL SELECT {result} FROM {'latest' if order is None else 'best'}"
    )


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{name}`" for name in columns)


def _numbers(dataset: Dataset, changes: str) -> dict[str, int]:
    """Number of the merge of each load id, from the list of partitions."""
    listed = dataset.spark.sql(f"SHOW PARTITIONS {dataset.table(changes)}").collect()
    values = [dict(part.split("=", 1) for part in row[0].split("/")) for row in listed]
    return {unquote(one[CHANGE_LOAD]): int(one[CHANGE]) for one in values}
