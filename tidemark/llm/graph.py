"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import delete_path, fresh_path


def components(edges: DataFrame, max_turns: int = 60) -> DataFrame:
    """(node, root) for every node of (a, b) edges of whole numbers; root is the least node it is connected with.

    Each turn joins nodes with the least of their neighbours, so that a node with very many neighbours is an
    aggregate and a join that Spark can split, never one group in a task. The edges of a turn are written to the
    shared folder. Loops and repeated edges do no harm; no edges give no rows.
    """
    spark = edges.sparkSession
    schema = "a bigint, b bigint"
    path = fresh_path(spark, "edges")
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges.select(high.alias("a"), low.alias("b")).where("a <> b").distinct().write.parquet(path)
    before = None
    for _ in range(max_turns):
        current = spark.read.schema(schema).parquet(path)
        # Large star: every larger neighbour of a node goes to the least of the node and its neighbours.
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        after = fresh_path(spark, "edges")
        small.where("a <> b").distinct().write.parquet(after)
        delete_path(spark, path)
        path = after
        now = spark.read.schema(schema).parquet(path).agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not found in {max_turns} turns")
    stars = spark.read.schema(schema).parquet(path)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
