"""Verification of loads. Every check returns rows of one schema; the caller decides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.draws import draw, id_text
from tidemark.operators.coerce import unpivot_columns
from tidemark.operators.ordered import semi_on_keys

RESULT_TYPES = {
    "table_name": "string",
    "check_name": "string",
    "passed": "boolean",
    "source_value": "bigint",
    "dest_value": "bigint",
    "difference": "bigint",
    "tolerance": "bigint",
    "error": "string",
}


def _result(**values: Column | str | int | None) -> list[Column]:
    """The columns of a check result; those not given are NULL."""
    made = []
    for name, spark_type in RESULT_TYPES.items():
        value = values.get(name)
        made.append((value if isinstance(value, Column) else F.lit(value)).cast(spark_type).alias(name))
    return made


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def row_count(name: str, source: DataFrame, destination: DataFrame, tolerance: int = 0) -> DataFrame:
    """Source count against destination count. Filter the source as it was filtered for the load."""
    if tolerance < 0:
        raise ValueError("tolerance cannot be negative")
    spark = source.sparkSession
    counted = spark.range(1).select(_count(source).alias("s"), _count(destination).alias("d"))
    difference = F.abs(F.col("s") - F.col("d"))
    return counted.select(
        *_result(
            table_name=name, check_name="row_count", passed=difference <= tolerance, source_value=F.col("s"),
            dest_value=F.col("d"), difference=difference, tolerance=tolerance,
        )
    )


def failed(spark: SparkSession, table: str, check: str, error: str) -> DataFrame:
    """A check that could not be made."""
    return spark.range(1).select(*_result(table_name=table, check_name=check, passed=F.lit(False), error=error))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ],
    )


def table_ranges(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: row count, least and greatest key; each table comes with its key column."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.min(key).cast("bigint").alias("min_key"),
                F.max(key).cast("bigint").alias("max_key"),
            ).select(F.lit(name).alias("table_name"), "row_count", "min_key", "max_key")
            for name, (df, key) in tables.items()
        ],
    )


def tables_loaded(spark: SparkSession, expected: Sequence[str], ranges: DataFrame) -> DataFrame:
    """Every expected table is there and holds rows."""
    names = spark.createDataFrame([(name,) for name in expected], "table_name string")
    found = names.join(ranges.select("table_name", "row_count"), "table_name", "left")
    rows = F.coalesce(F.col("row_count"), F.lit(0))
    return found.select(
        *_result(table_name=F.col("table_name"), check_name="table_existence", passed=rows > 0, dest_value=rows)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with their counts. NULL is a key value like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def primary_key(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows against distinct keys; NULL parts count as values."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("different")
    )
    return totals.select(
        *_result(
            table_name=name, check_name="primary_key_integrity", passed=F.col("total") == F.col("different"),
            source_value=F.col("total"), dest_value=F.col("different"),
            difference=F.col("total") - F.col("different"),
        )
    )


def custom_check(spark: SparkSession, name: str, text: str, **frames: DataFrame) -> DataFrame:
    """A user's query passes when it finds 0 violations: a single number counts them, no row
    means none, several rows are one violation each. An error fails the check, not the run.
    """
    try:
        found = spark.sql(text, **frames)
        only = found.columns[0]
        numeric = len(found.columns) == 1 and isinstance(found.schema[0].dataType, T.NumericType)
        value = F.max(F.col(f"`{only}`")).cast("bigint") if numeric else F.lit(None).cast("bigint")
        rows, number = found.agg(F.count(F.lit(1)), value).first()
        violations = number if rows == 1 and numeric else rows
        passed, error = violations == 0, None
    except PySparkException as problem:
        violations, passed, error = None, False, str(problem).splitlines()[0]
    return spark.range(1).select(
        *_result(
            table_name="custom", check_name=name, passed=passed, dest_value=violations, difference=violations,
            tolerance=0, error=error,
        )
    )


def rules(name: str, df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """Many violation predicates in one pass; a rule passes when no row violates it."""
    counted = df.agg(*[F.count_if(broken).alias(f"n_{place}") for place, broken in enumerate(violations.values())])
    listed = unpivot_columns(counted, list(violations), ["n"], "rule")
    return listed.select(
        *_result(
            table_name=name, check_name=F.col("rule"), passed=F.col("n") == 0, dest_value=F.col("n"),
            difference=F.col("n"), tolerance=0,
        )
    )


def reconcile_batches(source: DataFrame, destination: DataFrame, key: str) -> DataFrame:
    """Per batch: rows on both sides, difference and status."""
    left = source.groupBy(key).agg(F.count(F.lit(1)).alias("_s"))
    right = destination.groupBy(key).agg(F.count(F.lit(1)).alias("_d"))
    there, here = F.coalesce(F.col("_s"), F.lit(0)), F.coalesce(F.col("_d"), F.lit(0))
    status = (
        F.when(F.col("_d").isNull(), "missing_in_destination")
        .when(F.col("_s").isNull(), "missing_in_source")
        .when(there == here, "match")
        .otherwise("differs")
    )
    return left.join(right, key, "full_outer").select(
        key,
        there.alias("source_count"),
        here.alias("dest_count"),
        (there - here).alias("difference"),
        status.alias("status"),
    )


def compare_profiles(source: DataFrame, destination: DataFrame) -> DataFrame:
    """Columns of two profiles side by side, with what differs."""
    facts = ["data_type", "nullable", "row_count", "null_count", "distinct_count"]
    left = source.select("column_name", *[F.col(fact).alias(f"source_{fact}") for fact in facts])
    right = destination.select("column_name", *[F.col(fact).alias(f"dest_{fact}") for fact in facts])
    both = left.join(right, "column_name", "full_outer")
    differing = [
        F.when(~F.col(f"source_{fact}").eqNullSafe(F.col(f"dest_{fact}")), F.lit(fact)) for fact in facts
    ]
    status = (
        F.when(F.col("dest_data_type").isNull(), "missing_in_destination")
        .when(F.col("source_data_type").isNull(), "missing_in_source")
        .otherwise(F.array_join(F.array_compact(F.array(*differing)), ","))
    )
    sides = [f"{side}_{fact}" for fact in facts for side in ("source", "dest")]
    return both.select("column_name", *sides, status.alias("differences"))


def _side_by_side(source: DataFrame, destination: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: rows on each side and one row of each side.

    Both sides are stacked and grouped, so that a key held by very many rows is combined
    before the shuffle instead of multiplying in a join.
    """
    others = [name for name in source.columns if name not in keys]
    types = {field.name: field.dataType for field in source.schema.fields}
    fitted = destination.select(*[F.col(name).cast(types[name]).alias(name) for name in source.columns])
    stacked = source.withColumn("_side", F.lit("s")).unionByName(fitted.withColumn("_side", F.lit("d")))
    state = F.struct(*others)
    grouped = []
    for side in "sd":
        here = F.col("_side") == side
        grouped += [
            F.count_if(here).alias(f"_{side}_rows"),
            F.min(F.when(here, state)).alias(f"_{side}"),
        ]
    return stacked.groupBy(*keys).agg(*grouped)


def compare_values(source: DataFrame, destination: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: same, changed, missing or extra; a key held twice on a side is a duplicate.

    Columns of the source are compared, NULL being a value like any other.
    """
    both = _side_by_side(source, destination, keys)
    status = (
        F.when(F.col("_d_rows") == 0, "missing")
        .when(F.col("_s_rows") == 0, "extra")
        .when((F.col("_s_rows") > 1) | (F.col("_d_rows") > 1), "duplicate")
        .when(F.col("_s").eqNullSafe(F.col("_d")), "same")
        .otherwise("changed")
    )
    counts = [F.col("_s_rows").alias("source_rows"), F.col("_d_rows").alias("dest_rows")]
    return both.select(*keys, status.alias("status"), *counts)


CHECKSUM_RANGES = 1_024
CHECKSUM_LEAVES = 1_024  # of each range that differs
MOST_LEAVES = 10_000  # beyond so many, whole ranges are compared


def _fitted(destination: DataFrame, source: DataFrame) -> DataFrame:
    """The source's columns of a destination, in the source's types."""
    return destination.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in source.schema.fields])


def _differing(source: DataFrame, destination: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """Groups in which the two sides do not hold the same rows equally often, by what is left of the sums of one side
    when those of the other are taken off: rows, folded hashes, added hashes.

    Which columns are NULL is hashed too, as a NULL alone leaves a hash unchanged.
    """
    names = [F.col(name) for name in source.columns]
    row = F.xxhash64(*names, F.struct(*[name.isNull() for name in names])).alias("_row")
    groups = [column.alias(name) for name, column in by.items()]
    sides = [frame.select(*groups, row, F.lit(sign).alias("_sign")) for frame, sign in ((source, 1), (destination, -1))]
    left = sides[0].unionByName(sides[1]).groupBy(*by).agg(
        F.sum("_sign").alias("_rows"),
        F.bit_xor("_row").alias("_folded"),
        F.sum(F.col("_sign") * F.col("_row").bitwiseAND(0xFFFFFFFF)).alias("_added"),
    )
    return left.where("_rows <> 0 OR _folded <> 0 OR _added <> 0").select(*by)


def compare_by_checksum(
    source: DataFrame, destination: DataFrame, keys: Sequence[str], ranges: int = CHECKSUM_RANGES, leaves: int = CHECKSUM_LEAVES
) -> DataFrame:
    """The keys whose rows differ between the sides, with the status of `compare_values`, found from checksums.

    Both sides are summed by ranges of the first key (by hash where it is no whole number). Ranges that
    differ are read again in finer ones, and only rows of those that still differ are compared. Equal
    tables shuffle a line for each range and task and nothing else. A key that both sides hold several
    times with the same rows does not differ.
    """
    destination = _fitted(destination, source)
    empty = compare_values(source.limit(0), destination.limit(0), keys)
    whole = isinstance(source.schema[keys[0]].dataType, T.IntegralType)
    number = F.col(keys[0]).cast("decimal(20,0)") if whole else F.xxhash64(*keys).cast("decimal(20,0)")
    if whole:
        bounds = [frame.agg(F.min(keys[0]), F.max(keys[0])).first() for frame in (source, destination)]
        known = [value for pair in bounds for value in pair if value is not None]
        low, high = (min(known), max(known)) if known else (0, 0)
    else:
        low, high = -(1 << 63), (1 << 63) - 1
    width = -(-(high - low + 1) // ranges)

    def part_of(size: int) -> Column:
        exact = [F.lit(str(value)).cast("decimal(20,0)") for value in (low, size)]
        # A NULL key has a part of its own.
        return F.coalesce(F.call_function("div", number - exact[0], exact[1]), F.lit(-1).cast("bigint"))

    place = part_of(width)
    differing = [row.part for row in _differing(source, destination, {"part": place}).collect()]
    if not differing:
        return empty

    def within(df: DataFrame, part: Column, numbers: Sequence[int]) -> DataFrame:
        # At most as many numbers as there are ranges, or MOST_LEAVES.
        wanted = F.broadcast(df.sparkSession.createDataFrame([(number,) for number in numbers], "_part bigint"))
        chosen = df.withColumn("_part", part).join(wanted, "_part", "left_semi").drop("_part")
        if whole and min(differing) >= 0:  # bounds that the scan can prune by
            first, last = low + min(differing) * width, low + (max(differing) + 1) * width - 1
            chosen = chosen.where(F.col(keys[0]).between(F.lit(first), F.lit(last)))
        return chosen

    left, right = within(source, place, differing), within(destination, place, differing)
    leaf = part_of(-(-width // leaves))
    found = [row.part for row in _differing(left, right, {"part": leaf}).limit(MOST_LEAVES + 1).collect()]
    if len(found) <= MOST_LEAVES:
        left, right = within(left, leaf, found), within(right, leaf, found)
    wrong = _differing(left, right, {key: F.col(key) for key in keys})
    left, right = semi_on_keys(left, wrong, keys), semi_on_keys(right, wrong, keys)
    return compare_values(left, right, keys).where("status <> 'same'")


def compare_rows(source: DataFrame, destination: DataFrame) -> DataFrame:
    """Without a key: rows held by the two sides a different number of times, with the counts."""
    types = {field.name: field.dataType for field in source.schema.fields}
    fitted = destination.select(*[F.col(name).cast(types[name]).alias(name) for name in source.columns])
    stacked = source.withColumn("_side", F.lit(1)).unionByName(fitted.withColumn("_side", F.lit(0)))
    counted = stacked.groupBy(*source.columns).agg(
        F.count_if(F.col("_side") == 1).alias("source_rows"), F.count_if(F.col("_side") == 0).alias("dest_rows")
    )
    return counted.where("source_rows <> dest_rows")


def in_sample(df: DataFrame, keys: Sequence[str], percent: int) -> Column:
    """Whether a key is in a repeatable sample; both sides draw the same keys."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.IntegralType):
        return draw(id_text(keys[0]), 0) % 100 < percent
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys])
    return F.crc32(text) % 100 < percent


def compare_sample(
    source: DataFrame, destination: DataFrame, keys: Sequence[str], columns: Sequence[str], percent: int = 10
) -> DataFrame:
    """On a sample of keys, per column: equal values, different values, NULL on one side
    only, and keys absent from one side."""
    left = source.select(*keys, *columns).where(in_sample(source, keys, percent))
    right = destination.select(*keys, *columns).where(in_sample(destination, keys, percent))
    both = _side_by_side(left, right, keys)
    found_s, found_d = F.col("_s_rows") > 0, F.col("_d_rows") > 0
    present = found_s & found_d
    measures = []
    for place, name in enumerate(columns):
        old, new = F.col("_s")[name], F.col("_d")[name]
        one_null = old.isNull() != new.isNull()
        measures += [
            F.count_if(present & old.eqNullSafe(new)).alias(f"equal_count_{place}"),
            F.count_if(present & ~old.eqNullSafe(new) & ~one_null).alias(f"different_count_{place}"),
            F.count_if(present & one_null).alias(f"null_mismatch_{place}"),
            F.count_if(found_s & ~found_d).alias(f"missing_count_{place}"),
            F.count_if(found_d & ~found_s).alias(f"extra_count_{place}"),
        ]
    prefixes = ["equal_count", "different_count", "null_mismatch", "missing_count", "extra_count"]
    return unpivot_columns(both.agg(*measures), columns, prefixes)


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def summary(checks: DataFrame, tables: Sequence[str] | None = None) -> DataFrame:
    """Totals over check results, for all tables or the given ones; one row."""
    chosen = checks if tables is None else checks.where(F.col("table_name").isin(list(tables)))
    total, passed = F.count(F.lit(1)), F.count_if(F.col("passed"))
    rate = F.when(total > 0, passed * F.lit(100).cast("double") / total).otherwise(F.lit(0.0))
    # One name per table with a failed check.
    issues = F.array_join(F.array_sort(F.collect_set(F.when(~F.col("passed"), F.col("table_name")))), ",")
    return chosen.agg(
        total.alias("total_checks"),
        passed.alias("passed_checks"),
        (total - passed).alias("failed_checks"),
        rate.alias("success_rate"),
        (total == passed).alias("overall_passed"),
        issues.alias("tables_with_issues"),
    )
