"""Integrity checks and statistics of type-2 history tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.watermarks import moment
from tidemark.operators.ordered import (
    ROWS_PER_GROUP,
    join_on_keys,
    slice_hot_keys,
    with_next,
    with_running_counts,
)
from tidemark.operators.scd2 import (
    CLOSE_OFFSET_SECONDS,
    COLUMNS,
    INSERTED,
    OPEN_END,
    UPDATED,
    VersionColumns,
)
from tidemark.session import materialize

PARTNER_BLOCK = 1_024  # partners that are joined as one


def several_current(dimension: DataFrame, keys: Sequence[str], cols: VersionColumns = COLUMNS) -> DataFrame:
    """Keys with more than one current version."""
    counts = dimension.where(F.col(cols.current)).groupBy(*keys).agg(F.count(F.lit(1)).alias("current_versions"))
    return counts.where("current_versions > 1")


def orphans(dimension: DataFrame, keys: Sequence[str], cols: VersionColumns = COLUMNS) -> DataFrame:
    """Keys with history but no current version."""
    counts = dimension.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("version_count"), F.count_if(F.col(cols.current)).alias("_current")
    )
    return counts.where("_current = 0").drop("_current")


def _sweep(
    dimension: DataFrame, keys: Sequence[str], version: str, rows_per_group: int, cols: VersionColumns
) -> DataFrame:
    """Per well-formed version: its rank by start, and how many versions of the key end by
    its start and begin before its end.

    Starts and ends of a key lie on one time line, ends first, and running counts along it
    answer both: linear in versions however many overlap. Open ends follow all starts.
    """
    end = F.coalesce(F.col(cols.end), moment(OPEN_END))
    formed = dimension.select(*keys, version, F.col(cols.start).alias("_from"), end.alias("_to")).where(
        (F.col("_from") < F.col("_to")) & (F.col("_from") < moment(OPEN_END))
    )
    points = formed.select(
        *keys,
        version,
        "_from",
        "_to",
        F.explode(
            F.array(
                F.struct(F.col("_to").alias("_time"), F.lit(0).alias("_starts")),
                F.struct(F.col("_from").alias("_time"), F.lit(1).alias("_starts")),
            )
        ).alias("_point"),
    ).select(*keys, version, "_from", "_to", "_point.*")
    order = ["_time", "_starts", version]
    points = slice_hot_keys(points, keys, order, rows_per_group)
    counted = with_running_counts(
        points,
        keys,
        order,
        {"_begun": F.col("_starts") == 1, "_ended": F.col("_starts") == 0},
    )
    at_start = F.col("_starts") == 1
    return counted.groupBy(*keys, version, "_from", "_to").agg(
        F.max(F.when(at_start, F.col("_begun"))).alias("_rank"),
        F.max(F.when(at_start, F.col("_ended"))).alias("_ended_before"),
        F.max(F.when(~at_start, F.col("_begun"))).alias("_begun_before"),
    )


def overlapping_versions(
    dimension: DataFrame, keys: Sequence[str], version: str, rows_per_group: int = ROWS_PER_GROUP,
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """Versions that overlap others of their key, with the exact number of those.

    `version` names a column unique within a key. Versions that end before they begin are
    reported by `inverted_versions` instead.
    """
    swept = _sweep(dimension, keys, version, rows_per_group, cols)
    partners = F.col("_begun_before") - F.col("_ended_before") - 1
    return swept.select(*keys, version, partners.alias("overlapping")).where("overlapping > 0")


def overlap_pairs(
    dimension: DataFrame, keys: Sequence[str], version: str, rows_per_group: int = ROWS_PER_GROUP,
    cols: VersionColumns = COLUMNS, block: int = PARTNER_BLOCK,
) -> DataFrame:
    """Pairs of overlapping versions of a key, each in both orders.

    Ranked by start, the later partners of a version are the ranks that follow its own, so
    join is on (key, rank): nothing is paired that does not overlap, and the ranks of a
    hot key spread over all tasks. Whole blocks of ranks are joined as such, so that a version
    lists its partners' blocks and the ranks at both edges, not all partners.
    """
    swept = _sweep(dimension, keys, version, rows_per_group, cols)
    ranked = materialize(swept.select(*keys, version, "_rank", "_begun_before"), "ranked")
    first, last = F.col("_rank") + 1, F.col("_begun_before")
    span = ranked.where("_begun_before > _rank").select(
        *keys,
        F.col(version).alias("_one"),
        first.alias("_first"),
        last.alias("_last"),
        F.ceil(first / block).alias("_from"),
        (F.floor((last + 1) / block) - 1).alias("_to"),
    )
    has_blocks = F.col("_to") >= F.col("_from")
    none = F.array().cast("array<bigint>")
    head = F.when(F.col("_first") < F.col("_from") * block, F.sequence("_first", F.col("_from") * block - 1)).otherwise(none)
    after = (F.col("_to") + 1) * block
    tail = F.when(after <= F.col("_last"), F.sequence(after, F.col("_last"))).otherwise(none)
    edges = F.when(has_blocks, F.concat(head, tail)).otherwise(F.sequence("_first", "_last"))
    by_rank = span.select(*keys, "_one", F.explode(edges).alias("_rank"))
    by_block = span.where(has_blocks).select(*keys, "_one", F.explode(F.sequence("_from", "_to")).alias("_block"))
    later = ranked.select(*keys, "_rank", F.floor(F.col("_rank") / block).alias("_block"), F.col(version).alias("_other"))
    pairs = join_on_keys(by_rank, later.drop("_block"), [*keys, "_rank"], "inner").drop("_rank")
    blocks = join_on_keys(by_block, later.drop("_rank"), [*keys, "_block"], "inner").drop("_block")
    pairs = pairs.unionByName(blocks)
    both = F.array(
        F.struct(F.col("_one").alias("version_1"), F.col("_other").alias("version_2")),
        F.struct(F.col("_other").alias("version_1"), F.col("_one").alias("version_2")),
    )
    return pairs.select(*keys, F.inline(both))


def inverted_versions(dimension: DataFrame, cols: VersionColumns = COLUMNS) -> DataFrame:
    """Versions that do not end after they begin."""
    return dimension.where(F.col(cols.end) <= F.col(cols.start))


def continuity(dimension: DataFrame, keys: Sequence[str], cols: VersionColumns = COLUMNS) -> DataFrame:
    """Per key: number of versions, first start, start of the current version."""
    return dimension.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("version_count"),
        F.min(cols.start).alias("earliest_version"),
        F.max(F.when(F.col(cols.current), F.col(cols.start))).alias("latest_version"),
    )


def gaps(
    dimension: DataFrame, keys: Sequence[str], close_offset: int = CLOSE_OFFSET_SECONDS,
    rows_per_group: int = ROWS_PER_GROUP, cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """Versions followed by a gap longer than the closing offset."""
    rows = slice_hot_keys(dimension.select(*keys, cols.start, cols.end), keys, [cols.start], rows_per_group)
    rows = with_next(rows, keys, [cols.start], {"next_from": F.col(cols.start)})
    allowed = F.col(cols.end) + F.expr(f"INTERVAL {int(close_offset)} SECONDS")
    return rows.where(F.col("next_from") > allowed).select(*keys, cols.start, cols.end, "next_from")


def archive_split(
    dimension: DataFrame, before: datetime | str, cols: VersionColumns = COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Versions closed before a date, and all others."""
    old = F.coalesce(F.col(cols.end) < F.lit(before).cast("timestamp_ntz"), F.lit(False))
    return dimension.where(old), dimension.where(~old)


def stats(dimension: DataFrame, keys: Sequence[str], cols: VersionColumns = COLUMNS) -> DataFrame:
    """Total rows, distinct keys, current and historical versions."""
    return dimension.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.struct(*keys)).alias("unique_keys"),
        F.count_if(F.col(cols.current)).alias("current_versions"),
        F.count_if(~F.col(cols.current)).alias("historical_versions"),
        F.format_number(F.count(F.lit(1)), 0).alias("formatted_total"),
    )


def daily_summary(dimension: DataFrame, keys: Sequence[str], cols: VersionColumns = COLUMNS) -> DataFrame:
    """Per batch: rows, distinct keys, inserts and updates."""
    return dimension.groupBy(cols.batch).agg(
        F.count(F.lit(1)).alias("records_loaded"),
        F.count_distinct(F.struct(*keys)).alias("keys_affected"),
        F.count_if(F.col(cols.change) == INSERTED).alias("new_keys"),
        F.count_if(F.col(cols.change) == UPDATED).alias("updated_keys"),
        F.format_number(F.count(F.lit(1)), 0).alias("formatted_count"),
    )


def change_mix(dimension: DataFrame, cols: VersionColumns = COLUMNS) -> DataFrame:
    """Rows per change type with their share in percent, the most frequent first."""
    total = dimension.agg(F.count(F.lit(1))).scalar()
    counts = dimension.groupBy(cols.change).agg(F.count(F.lit(1)).alias("record_count"))
    share = (F.col("record_count") * F.lit(100.0).cast("decimal(4,1)") / total).cast("decimal(5,2)")
    return counts.withColumn("percentage", share).orderBy(F.desc("record_count"), cols.change)


def sample_history(dimension: DataFrame, key: str, rows: int = 5, cols: VersionColumns = COLUMNS) -> DataFrame:
    """The first versions of the first key that has history."""
    first = dimension.where(~F.col(cols.current)).agg(F.min(key)).scalar()
    return dimension.where(F.col(key) == first).orderBy(cols.start).limit(rows)
