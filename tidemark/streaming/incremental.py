"""Incremental loads as file streams: process what is new, then stop.

Every micro-batch writes under an id of its own, made of the stream's persistent id and the
number of the batch: a batch that is run again after a failure replaces its first attempt, and
streams that fill one table leave each other alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.delta import compact, merge_delta
from tidemark.operators.load import Dataset


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, optionally those matching a glob."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_append(
    rows: DataFrame,
    dataset: Dataset,
    table: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Append all new rows of a stream to a table, then stop."""

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        Dataset(batch.sparkSession, dataset.name).append(table, prepare(batch), load_id=f"{stream}-{number:08d}")

    _run(rows, checkpoint, write)


def stream_merge(
    rows: DataFrame,
    dataset: Dataset,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Upsert all new rows of a stream into a table, the latest row of a key counting, then stop.

    Events that come twice or late do no harm, as the latest row of a key counts whenever it comes;
    so none is dropped before.
    """

    def write(batch: DataFrame, number: int) -> None:
        into = Dataset(batch.sparkSession, dataset.name)
        if into.exists(table):
            # A late row must not replace a newer one, so the rows it would replace compete.
            held = into.read(table).join(batch.select(*keys).distinct(), list(keys), "left_semi")
            batch = batch.unionByName(held)
        into.merge(table, batch, keys, order, partition_by)

    _run(rows, checkpoint, write)


def stream_merge_delta(
    rows: DataFrame,
    dataset: Dataset,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    compact_every: int | None = None,
) -> None:
    """The same upsert, for which a micro-batch writes its own rows only and reads none of the table.

    The greatest row of a key is found when the table is read. After every `compact_every` micro-batches
    the changes are folded into the base.
    """

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        into = Dataset(batch.sparkSession, dataset.name)
        merge_delta(into, table, batch, keys, order, f"{stream}-{number:08d}", by_order=True)
        if compact_every and (number + 1) % compact_every == 0:
            compact(into, table)

    _run(rows, checkpoint, write)


def _run(rows: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    stream = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
