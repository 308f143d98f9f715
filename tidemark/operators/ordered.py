"""Ordered per-key windows that stay balanced when one key holds much of a table.

A window over a key puts all rows of the key into one task. `slice_hot_keys` finds such keys in a sample of the key
columns and cuts each into slices of about a row limit, at points of the window's order that the sample gives. The window
then runs per (key, slice), and what crosses a slice border is carried over from a small table with one row per slice.
Without a hot key the plan is the plain window.

Where the whole order of the window is given, rows equal in it are parted too: by a hash of the row and, where rows are
the same, by a number. A frame that is more than a scan is written once before, so that its source is evaluated once.
The tables of cuts and slices are broadcast while they have at most MAX_SLICES rows, and left to Spark beyond.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import materialize

ROWS_PER_GROUP = 4_000_000
DRAWS = 64  # sampled rows of a slice
MAX_SLICES = 250_000
SLICE = "_slice"
TIE = "_tie"
SEED = 17
_SCAN = ("Project", "Filter", "Relation", "LocalRelation", "LogicalRDD", "Range", "SubqueryAlias", "View")


def is_scan(df: DataFrame) -> bool:
    """Whether a frame only reads, filters and projects, so that reading it again is cheap."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return all(line.lstrip(" :+-").startswith(_SCAN) for line in lines)


def slice_hot_keys(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Add the slice number of rows of hot keys (NULL for other rows), if there is a hot key.

    `order` is the whole order of the windows to come, or only its first column; then rows equal in that
    share a slice.
    """
    if not is_scan(df):
        df = materialize(df)
    rate = min(1.0, DRAWS / rows_per_group)
    step = max(1, round(rate * rows_per_group))
    drawn = _sampled(df.select(*keys), rate).groupBy(*keys).agg(F.count(F.lit(1)).alias("_drawn"))
    largest = drawn.agg(F.max("_drawn")).first()[0]
    if not largest or largest <= step:
        return df

    tie = F.struct(F.xxhash64(*df.columns).alias("hash"), F.monotonically_increasing_id().alias("number"))
    df = materialize(df.withColumn(TIE, tie))
    point = F.struct(order) if isinstance(order, str) else F.struct(*order, TIE)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_point"))
    points = _sampled(df.select(*keys, point.alias("_point")), rate).withColumn("_place", place)
    # A key with less than a slice's share of the sample has no cut.
    points = materialize(points.where(F.col("_place") % step == 0), "cuts")
    slices = points.count()
    cuts = points.groupBy(*keys).agg(F.array_sort(F.collect_list("_point")).alias("_cuts"))
    # The cuts of a key go into about as many runs as a run has cuts, so that a row is
    # compared with the first cuts of the runs and with the cuts of one run.
    width = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    starts = F.sequence(F.lit(1), F.size("_cuts"), width)
    runs = cuts.select(
        *keys, width.alias("_width"), F.transform(starts, lambda start: F.slice("_cuts", start, width)).alias("_runs")
    ).withColumn("_firsts", F.transform("_runs", lambda run: run[0]))
    run = F.size(F.filter("_firsts", lambda cut: cut < point))
    within = F.size(F.filter(F.element_at("_runs", F.greatest(run, F.lit(1))), lambda cut: cut < point))
    number = F.when(run == 0, 0).otherwise((run - 1) * F.col("_width") + within)
    sliced = F.when(F.col("_runs").isNotNull(), number)
    # There are at most twice as many slices as cuts.
    return (
        join_on_keys(df, F.broadcast(runs) if slices <= MAX_SLICES else runs, keys, "left")
        .withColumn(SLICE, sliced.alias(SLICE, metadata={"slices": 2 * slices}))
        .drop("_width", "_runs", "_firsts")
    )


def _sampled(df: DataFrame, rate: float) -> DataFrame:
    return df.sample(rate, SEED) if rate < 1 else df


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join that matches NULL keys too and keeps the left key columns."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    matches = reduce(
        lambda one, other: one & other,
        [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys],
    )
    return left.join(renamed, matches, how).drop(*[f"_right_{key}" for key in keys])


def semi_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is (`left_semi`) or is not (`left_anti`) in the other frame; a NULL key matches a NULL key."""
    other = right.select(*[F.col(key).alias(f"_right_{key}") for key in keys]).distinct()
    matches = reduce(lambda one, two: one & two, [left[key].eqNullSafe(other[f"_right_{key}"]) for key in keys])
    return left.join(other, matches, how)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Column]
) -> DataFrame:
    """Add values of the row before, NULL in the first row of a key."""
    return _neighbour(df, keys, order, outputs, F.lag, F.max_by)


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Column]
) -> DataFrame:
    """Add values of the row after, NULL in the last row of a key."""
    return _neighbour(df, keys, order, outputs, F.lead, F.min_by)


def _neighbour(df, keys, order, outputs, shift, edge_of_slice):
    values = _pack(outputs)
    if SLICE not in df.columns:
        found = df.withColumn("_found", shift(values).over(_window(df, keys, order)))
    else:
        edges = _per_slice(df, keys, edge_of_slice(values, _pack_order(df, order)).alias("_edge"))
        carried = edges.select(*keys, SLICE, shift("_edge").over(_slices(keys)).alias("_carried"))
        local = shift(values).over(_window(df, keys, order))
        found = _carry(df.withColumn("_found", local), carried, keys).withColumn(
            "_found", F.coalesce("_found", "_carried")
        )
    return _unpack(found, outputs)


def with_last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column
) -> DataFrame:
    """Add the last non-NULL value up to and including each row."""
    upto = _window(df, keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = F.last(value, ignorenulls=True).over(upto)
    if SLICE not in df.columns:
        return df.withColumn(name, local)
    position = F.when(value.isNotNull(), _pack_order(df, order))
    edges = _per_slice(df, keys, F.max_by(value, position).alias("_edge"))
    carried = edges.select(
        *keys, SLICE, F.last("_edge", ignorenulls=True).over(_earlier(keys)).alias("_carried")
    )
    found = _carry(df.withColumn("_found", local), carried, keys)
    return found.withColumn(name, F.coalesce("_found", "_carried")).drop("_found", "_carried")


def with_running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column
) -> DataFrame:
    """Add the largest value of all rows before, NULL in the first row of a key."""
    before = _window(df, keys, order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.max(value).over(before)
    if SLICE not in df.columns:
        return df.withColumn(name, local)
    edges = _per_slice(df, keys, F.max(value).alias("_edge"))
    carried = edges.select(*keys, SLICE, F.max("_edge").over(_earlier(keys)).alias("_carried"))
    found = _carry(df.withColumn("_found", local), carried, keys)
    return found.withColumn(name, F.greatest("_found", "_carried")).drop("_found", "_carried")


def with_running_counts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Column]
) -> DataFrame:
    """Add how many rows up to and including each one meet a condition, one count per output."""
    upto = _window(df, keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumns({name: F.count_if(cond).over(upto) for name, cond in outputs.items()})
    if SLICE not in df.columns:
        return local
    edges = _per_slice(df, keys, *[F.count_if(cond).alias(name) for name, cond in outputs.items()])
    carried = edges.select(
        *keys, SLICE, *[F.sum(name).over(_earlier(keys)).alias(f"_before_{name}") for name in outputs]
    )
    return (
        _carry(local, carried, keys)
        .withColumns(
            {name: F.col(name) + F.coalesce(F.col(f"_before_{name}"), F.lit(0)) for name in outputs}
        )
        .drop(*[f"_before_{name}" for name in outputs])
    )


def _window(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    sliced = [SLICE] if SLICE in df.columns else []
    return Window.partitionBy(*keys, *sliced).orderBy(*_whole(df, order))


def _whole(df: DataFrame, order: Sequence[str]) -> list[str]:
    """The order with what parts ties, where slices went by it."""
    return [*order, TIE] if TIE in df.columns else list(order)


def _slices(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(SLICE)


def _earlier(keys: Sequence[str]) -> WindowSpec:
    return _slices(keys).rowsBetween(Window.unboundedPreceding, -1)


def _per_slice(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per slice of the hot keys; the aggregates combine before the shuffle."""
    return df.where(F.col(SLICE).isNotNull()).groupBy(*keys, SLICE).agg(*aggregates)


def _carry(df: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    few = df.schema[SLICE].metadata.get("slices", 0) <= MAX_SLICES
    return join_on_keys(df, F.broadcast(carried) if few else carried, [*keys, SLICE], "left")


def _pack(outputs: Mapping[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in outputs.items()])


def _pack_order(df: DataFrame, order: Sequence[str]) -> Column:
    return F.struct(*_whole(df, order))


def _unpack(df: DataFrame, outputs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({name: F.col(f"_found.{name}") for name in outputs}).drop("_found", "_carried")
