"""Reading source tables. Filters and column lists stay declarative so that the scan prunes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import TableSpec


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan(spark: SparkSession, spec: TableSpec, **frames: DataFrame) -> DataFrame:
    """Source of a spec: a query, a JDBC table, files or a catalog table, then its filter.

    JDBC needs a driver on the class path; the tests cover its options only.
    """
    if spec.format == "jdbc":
        df = spark.read.format("jdbc").options(**jdbc_options(spec)).load()
    elif spec.query:
        df = scan_query(spark, spec.query, **frames)
    elif spec.source in frames:
        df = frames[spec.source]
    elif "/" in spec.source:
        df = spark.read.format(spec.format).options(**spec.options).load(spec.source)
    else:
        df = spark.table(spec.source)
    df = scan_where(df, spec.where)
    return df.select(*spec.columns) if spec.columns else df


def jdbc_options(spec: TableSpec) -> dict[str, str]:
    """Options of a JDBC read: a table or query in chunks of the spec's size. Options given by
    the user win; `jdbc_partitions` gives those of a parallel read."""
    source = {"query": spec.query} if spec.query else {"dbtable": spec.source}
    return {"fetchsize": str(spec.chunk_rows)} | source | dict(spec.options)


def scan_query(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Result of a user's SELECT; `{name}` in the text stands for a frame given by name."""
    return spark.sql(text, **frames)


def scan_where(df: DataFrame, predicate: str | None) -> DataFrame:
    return df.where(F.expr(predicate)) if predicate else df


def scan_projection(df: DataFrame, columns: Sequence[str], predicate: str | None = None) -> DataFrame:
    return scan_where(df, predicate).select(*columns)


def jdbc_partitions(column: str, lower: int, upper: int, rows: int, chunk_rows: int) -> dict[str, str]:
    """Options for a JDBC read in bounded chunks over a numeric key range."""
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    parts = max(1, -(-rows // chunk_rows))
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper + 1),
        "numPartitions": str(parts),
        "fetchsize": str(chunk_rows),
    }


def chunk_of(column: Column, lower: Column, chunk_rows: int) -> Column:
    """Number of the fixed-width key range a row belongs to."""
    return F.floor((column - lower) / F.lit(chunk_rows)).cast("bigint")


def scan_chunked(df: DataFrame, column: str, chunk_rows: int) -> DataFrame:
    """All rows, each with the number of its chunk of the key; no shuffle."""
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    lowest = df.agg(F.min(column)).scalar()
    return df.withColumn("chunk", chunk_of(F.col(column), lowest, chunk_rows))
