"""Profiles of tables and reports on loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import SourceType, declared_types
from tidemark.operators.load import Dataset


def column_profile(
    df: DataFrame, table: str, source_types: Mapping[str, str] | None = None, approximate: bool = False
) -> DataFrame:
    """One row per column: declared type, length, precision, scale, nullability and position,
    with rows, NULLs and distinct values of the data.

    One pass over the table. Exact distinct counts group by column and value: a row gives one narrow
    row for each column, and equal values combine before the shuffle. `approximate` keeps to one
    aggregate without a shuffle of values.
    """
    declared = declared_types(df) | dict(source_types or {})
    described = []
    for place, field in enumerate(df.schema.fields):
        parsed = SourceType.parse(declared[field.name])
        decimal = parsed.scale is not None
        described.append(
            F.struct(
                F.lit(place).alias("_place"),
                F.lit(field.name).alias("column_name"),
                F.lit(place + 1).alias("position"),
                F.lit(parsed.name).alias("data_type"),
                F.lit(None if decimal else parsed.size).cast("int").alias("max_length"),
                F.lit(parsed.size if decimal else None).cast("int").alias("numeric_precision"),
                F.lit(parsed.scale).cast("int").alias("numeric_scale"),
                F.lit(field.nullable).alias("nullable"),
                F.lit(parsed.problematic).alias("problematic"),
            )
        )
    figures = ["row_count", "null_count", "distinct_count"]
    found = _approximate_figures(df) if approximate else _exact_figures(df)
    columns = df.sparkSession.range(1).select(F.inline(F.array(*described)))
    counted = [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in figures]
    return columns.join(found, "_place", "left").select(
        F.lit(table).alias("table_name"), *columns.drop("_place").columns, *counted
    )


def _exact_figures(df: DataFrame) -> DataFrame:
    """Rows, NULLs and distinct values by the place of a column.

    Every type of the table has a value column of its own, so that nothing is cast.
    """
    fields = df.schema.fields
    kinds = list(dict.fromkeys(field.dataType for field in fields))
    cells = [
        F.struct(
            F.lit(place).alias("_place"),
            *[
                (F.col(f"`{field.name}`") if field.dataType == kind else F.lit(None).cast(kind)).alias(f"_value_{number}")
                for number, kind in enumerate(kinds)
            ],
        )
        for place, field in enumerate(fields)
    ]
    values = [f"_value_{number}" for number in range(len(kinds))]
    by_value = df.select(F.inline(F.array(*cells))).groupBy("_place", *values).agg(F.count(F.lit(1)).alias("_rows"))
    empty = reduce(lambda one, other: one & other, [F.col(name).isNull() for name in values])
    return by_value.groupBy("_place").agg(
        F.sum("_rows").alias("row_count"),
        F.sum(F.when(empty, F.col("_rows")).otherwise(0)).alias("null_count"),
        F.count_if(~empty).alias("distinct_count"),
    )


def _approximate_figures(df: DataFrame) -> DataFrame:
    measures, rows = [], []
    for place, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        measures += [F.count_if(column.isNull()).alias(f"_null_{place}"), F.approx_count_distinct(column).alias(f"_distinct_{place}")]
        rows.append(
            F.struct(
                F.lit(place).alias("_place"), F.col("_rows").alias("row_count"), F.col(f"_null_{place}").alias("null_count"),
                F.col(f"_distinct_{place}").alias("distinct_count"),
            )
        )
    return df.agg(F.count(F.lit(1)).alias("_rows"), *measures).select(F.inline(F.array(*rows)))


SKETCH_BITS = 14
SKETCH_ERROR = 0.025  # three standard errors of a distinct count from sketches of so many bits


def column_sketches(df: DataFrame) -> DataFrame:
    """One row per column that can be merged with those of other batches: type, rows, NULLs, least and greatest value as
    text, and a sketch of the distinct values. One aggregate over the batch."""
    measures, rows = [], []
    for place, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        whole = isinstance(field.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
        measures += [
            F.count_if(column.isNull()).alias(f"_null_{place}"),
            F.min(column).cast("string").alias(f"_low_{place}"),
            F.max(column).cast("string").alias(f"_high_{place}"),
            F.hll_sketch_agg(column if whole else column.cast("string"), F.lit(SKETCH_BITS)).alias(f"_sketch_{place}"),
        ]
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("row_count"),
                *[F.col(f"_{kind}_{place}").alias(name) for kind, name in _SKETCHED.items()],
            )
        )
    return df.agg(F.count(F.lit(1)).alias("_rows"), *measures).select(F.inline(F.array(*rows)))


_SKETCHED = {"null": "null_count", "low": "lowest", "high": "highest", "sketch": "sketch"}


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The profile of all batches together; only their sketches are read.

    Rows, NULLs and extremes are exact, distinct counts have an error of SKETCH_ERROR at most, nearly always.
    """
    kinds = [row.data_type for row in sketches.select("data_type").distinct().collect()]  # types of columns
    # Text does not order as its values do, so extremes are compared in their types.
    extremes = []
    for place, kind in enumerate(kinds):
        for name, best in (("lowest", F.min), ("highest", F.max)):
            value = F.when(F.col("data_type") == kind, F.col(name).cast(kind))
            extremes.append(best(value).cast("string").alias(f"_{name}_{place}"))
    merged = sketches.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
        *extremes,
    )
    found = [
        F.coalesce(*[F.col(f"_{name}_{place}") for place in range(len(kinds))], F.lit(None).cast("string")).alias(name)
        for name in ("lowest", "highest")
    ]
    return merged.select("column_name", "data_type", "row_count", "null_count", "distinct_estimate", *found)


def keep_sketches(dataset: Dataset, table: str, batch: DataFrame, load_id: str) -> None:
    """Keep the sketches of one load beside its table; a load run again replaces its own."""
    dataset.append(f"{table}_sketches", column_sketches(batch), load_id=load_id)


def kept_profile(dataset: Dataset, table: str) -> DataFrame:
    """The profile of a table from the sketches of its loads."""
    return merged_sketches(dataset.read(f"{table}_sketches"))


def estimate_rows(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")


def schema_summary(profile: DataFrame) -> DataFrame:
    """Per table and declared type: columns and whether the type is problematic, with the
    column and row count of the table."""
    types = profile.groupBy("table_name", "data_type").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.bool_or("problematic").alias("problematic"),
        F.max("row_count").alias("row_count"),
    )
    totals = profile.groupBy("table_name").agg(F.count(F.lit(1)).alias("total_columns"))
    return types.join(totals, "table_name")


def columns_by_type(profile: DataFrame) -> DataFrame:
    """Column names per declared type, the type with most columns first.

    The lists are as long as the tables are wide, not as the data is large.
    """
    names = F.array_join(F.array_sort(F.collect_list("column_name")), ", ")
    grouped = profile.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("column_count"),
        names.alias("columns"),
        F.sum(F.col("row_count") - F.col("null_count")).alias("value_count"),
    )
    return grouped.orderBy(F.desc("column_count"), "data_type")


def data_state(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct batches, first and last batch; zeros when empty."""
    none = F.lit(0)
    batches = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return batches.agg(
        F.coalesce(F.sum("_rows"), none).alias("total_records"),
        F.count(key).alias("unique_batches"),
        F.coalesce(F.min(key), none).alias("earliest_batch"),
        F.coalesce(F.max(key), none).alias("latest_batch"),
    )


def batch_stats(df: DataFrame, key: str, at: str) -> DataFrame:
    """Per batch: rows, first and last time, rows with thousands separators."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min(at).alias("earliest_record"),
        F.max(at).alias("latest_record"),
        F.format_number(F.count(F.lit(1)), 0).alias("formatted_count"),
    )


def prefix_distribution(df: DataFrame, column: str, labels: Mapping[str, str], other: str) -> DataFrame:
    """Rows per label, the label going by the first prefix that a text begins with."""
    label: Column = F.lit(other)
    for prefix, text in reversed(labels.items()):
        label = F.when(F.col(column).startswith(prefix), text).otherwise(label)
    return df.groupBy(label.alias("data_type")).agg(
        F.count(F.lit(1)).alias("record_count"), F.format_number(F.count(F.lit(1)), 0).alias("formatted_count")
    )


def load_total(df: DataFrame, initial: Column) -> DataFrame:
    """Row count under a label that goes by the kind of load."""
    metric = F.when(initial, "Total Records After Initial Load").otherwise("Total Records After Incremental Load")
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        metric.alias("metric"), "value", F.format_number("value", 0).alias("formatted_value")
    )


def load_outcomes(audit: DataFrame, by: Sequence[str], failed: Column, duration: Column) -> DataFrame:
    """Loads, successes, failures, total and mean duration and success rate, per group of an
    audit table; a decimal duration makes the sums exact."""
    loads, failures = F.count(F.lit(1)), F.count_if(failed)
    total = F.coalesce(F.sum(duration), F.lit(0))
    hundred = F.lit(100).cast("double")
    return audit.groupBy(*by).agg(
        loads.alias("loads"),
        (loads - failures).alias("successes"),
        failures.alias("failures"),
        total.cast("decimal(28,4)").alias("total_duration"),
        F.coalesce(total.cast("double") / F.nullif(loads, F.lit(0)), F.lit(0.0)).alias("mean_duration"),
        F.coalesce(hundred * (loads - failures) / F.nullif(loads, F.lit(0)), F.lit(0.0)).alias("success_rate"),
    )


def loaded_row_rate(audit: DataFrame, keys: Sequence[str], rows: Column, seconds: Column) -> DataFrame:
    """Rows per second of each load; NULL when no time passed."""
    rate = rows / F.nullif(seconds.cast("double"), F.lit(0.0))
    return audit.select(*keys, rate.alias("rows_per_second"))
