"""Packing the small partitions of many loads together.

A table that is appended to has a partition for each load, so that a load run again replaces its own rows only. `pack_loads`
moves the rows of earlier loads, which are not run again, into a table beside it: partitioned by batch key where one is
given, with files of the size that Spark rebalances to. The view shows both; a filter on the batch key prunes the
packed partitions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import functions as F

from tidemark.operators.load import LOAD_ID, PACK, PACKED, PENDING, Dataset, quoted
from tidemark.operators.state import STATE


def pack_loads(dataset: Dataset, name: str, by: Sequence[str] = (), load_ids: Sequence[str] | None = None) -> list[str]:
    """Pack the given loads, or all but the last one of each source by the states of loads; returns their ids.

    Rows, load ids and sources stay as they are. The packed rows are written first and shown in one step with the
    loads they come from hidden, whose partitions are dropped then: a run that fails can be run again.
    """
    version = dataset.version(name)
    partitions = dataset._partitions(version)
    if LOAD_ID not in partitions:
        raise ValueError(f"table {name} is not partitioned by load")
    known = dataset.properties(name)
    number = int(known.get(PACKED, 0))
    # What an earlier run has shown as packed but not dropped.
    _drop(dataset, version, json.loads(known.get(PENDING, "[]")))
    if PENDING in known:
        dataset._show(name, version, {PACKED: str(number)})
    chosen = sorted(_written(dataset, version) & set(_earlier_loads(dataset, name) if load_ids is None else load_ids))
    if not chosen:
        return []
    recent = dataset.recent(name)
    packed = dataset.packed_table(version)
    columns = [name for name in recent.columns if name not in by]
    rows = recent.where(F.col(LOAD_ID).isin(chosen)).select(*columns, F.lit(number + 1).alias(PACK), *by)
    rows = rows.hint("rebalance", *by) if by else rows.hint("rebalance")
    if dataset.exists(packed):
        held = dataset.spark.table(dataset.table(packed))
        if held.schema.simpleString() != rows.schema.simpleString():
            raise ValueError(f"{packed} has other columns than the loads to pack: {held.schema.simpleString()}")
        rows.write.insertInto(dataset.table(packed), overwrite=True)
    else:
        writer = rows.write.format("parquet").option("partitionOverwriteMode", "dynamic").partitionBy(PACK, *by)
        writer.saveAsTable(dataset.table(packed))
    dataset._show(name, version, {PACKED: str(number + 1), PENDING: json.dumps(chosen)})
    _drop(dataset, version, chosen)
    dataset._show(name, version, {PACKED: str(number + 1)})
    return chosen


def _written(dataset: Dataset, version: str) -> set[str]:
    return {values[LOAD_ID] for values in _listed(dataset, version)}


def _listed(dataset: Dataset, version: str) -> list[dict[str, str]]:
    rows = dataset.spark.sql(f"SHOW PARTITIONS {dataset.table(version)}").collect()
    return [{key: unquote(value) for key, value in (part.split("=", 1) for part in row[0].split("/"))} for row in rows]


def _earlier_loads(dataset: Dataset, name: str) -> list[str]:
    """Ids of all loads that are noted and not the last one of any source."""
    if not dataset.exists(STATE):
        return []
    loads = dataset.read(STATE).where((F.col("destination") == name) & F.col("load_id").isNotNull())
    last = loads.groupBy("source").agg(F.max_by("load_id", "number").alias("load_id")).select("load_id")
    return [row.load_id for row in loads.select("load_id").distinct().join(last, "load_id", "left_anti").collect()]


def _drop(dataset: Dataset, version: str, load_ids: Sequence[str]) -> None:
    wanted = set(load_ids)
    for values in _listed(dataset, version) if wanted else []:
        if values[LOAD_ID] in wanted:
            partition = ", ".join(f"`{key}` = {quoted(value)}" for key, value in values.items())
            dataset.spark.sql(f"ALTER TABLE {dataset.table(version)} DROP IF EXISTS PARTITION ({partition})")
