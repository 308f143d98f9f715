"""Incremental loads as file streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.watermarks import batch_key
from tidemark.operators.coerce import coerce
from tidemark.operators.load import Dataset
from tidemark.plans.registry import Tables, query
from tidemark.session import fresh_path
from tidemark.streaming.incremental import file_stream, stream_append, stream_merge, stream_merge_delta


def _stream(tables: Tables, name: str) -> DataFrame:
    return file_stream(tables.spark, tables.folder, tables[name].schema, files=f"{name}.parquet")


@query(
    "stream_incremental_append",
    """
    SELECT event_id, user_id, CAST(value AS DECIMAL(19,4)) AS value, CAST(strftime(ts, '%Y%m%d') AS INT) AS batch_key
    FROM events
    """,
)
def stream_incremental_append(tables: Tables) -> DataFrame:
    """The second run finds no new file."""
    dataset, checkpoint = Dataset(tables.spark), fresh_path(tables.spark, "stream")

    def prepare(batch: DataFrame) -> DataFrame:
        rows = batch.select("event_id", "user_id", "value", batch_key(F.col("ts")).alias("batch_key"))
        return coerce(rows, {"value": "money"})

    for _ in range(2):
        stream_append(_stream(tables, "events"), dataset, "events", checkpoint, prepare)
    return dataset.read("events").drop("_load_id")


@query(
    "stream_incremental_merge",
    """
    SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def stream_incremental_merge(tables: Tables) -> DataFrame:
    """Last event of every user."""
    dataset, checkpoint = Dataset(tables.spark), fresh_path(tables.spark, "stream")
    stream_merge(
        _stream(tables, "events"), dataset, "last_event", ["user_id"], ["ts", "event_id"], checkpoint
    )
    return dataset.read("last_event")


@query(
    "stream_merge_delta",
    """
    SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def stream_merge_delta_days(tables: Tables) -> DataFrame:
    """Last event of every user from files by day, four of them a micro-batch, in no order of time."""
    spark, folder = tables.spark, fresh_path(tables.spark, "days")
    days = tables["events"].withColumn("day", batch_key(F.col("ts")))
    days.repartition("day").write.partitionBy("day").parquet(folder)
    dataset, checkpoint = Dataset(spark), fresh_path(spark, "stream")
    stream = file_stream(spark, folder, tables["events"].schema, files_per_batch=4).drop("day")
    stream_merge_delta(stream, dataset, "last_event", ["user_id"], ["ts", "event_id"], checkpoint, compact_every=5)
    return dataset.read("last_event")


@query(
    "stream_append_two_sources",
    "SELECT o_orderkey AS order_key FROM orders UNION ALL SELECT l_orderkey FROM lineitem",
)
def stream_append_two_sources(tables: Tables) -> DataFrame:
    """Two streams with checkpoints of their own fill one table."""
    dataset = Dataset(tables.spark)
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        stream_append(
            _stream(tables, name), dataset, "keys", fresh_path(tables.spark, "stream"),
            lambda batch, key=key: batch.select(F.col(key).alias("order_key")),
        )
    return dataset.read("keys").select("order_key")
