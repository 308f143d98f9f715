"""Changes that come late, cut into the history they belong to.

Only the keys with late changes are touched. Their versions are read as events, a state that begins or, where nothing
follows, an end; the late changes are put between them, and the versions are made anew from the line of events: a change in
the middle of a version splits it, and what became a repeat of the state before it goes.

A dimension holds no repeats, but a repeat after a late change is a change: after A, B comes late, and a second A that was
seen in between starts a version again. Loads therefore note the keys that they confirm (`repeats`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.watermarks import batch_key
from tidemark.operators.ordered import (
    ROWS_PER_GROUP,
    semi_on_keys,
    slice_hot_keys,
    with_last_known,
    with_next,
    with_previous,
)
from tidemark.operators.scd2 import (
    CLOSE_OFFSET_SECONDS,
    COLUMNS,
    INITIAL_AUTHOR,
    INITIAL_REASON,
    INSERTED,
    NEW_REASON,
    UPDATE_AUTHOR,
    UPDATED,
    VersionColumns,
    changed_reason,
)

GONE = "_gone"
# Of events of a key at one time the last kind counts.
_END, _REPEAT, _START, _LATE = range(4)


def repeated_changes(
    history: DataFrame, keys: Sequence[str], attributes: Sequence[str], changed_at: str, tie_breakers: Sequence[str] = (),
    rows_per_group: int = ROWS_PER_GROUP, cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """Keys and times of the changes that `build_versions` drops, as they repeat the state before them."""
    order = [changed_at, *tie_breakers]
    rows = slice_hot_keys(history.select(*dict.fromkeys([*keys, *attributes, *order])), keys, order, rows_per_group)
    state = F.struct(*attributes)
    rows = with_previous(rows, keys, order, {"_before": state})
    return rows.where(F.col("_before").eqNullSafe(state)).select(*keys, F.col(changed_at).cast("timestamp_ntz").alias(cols.start))


def with_late_changes(
    versions: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    repeats: DataFrame | None = None,
    close_offset: int = CLOSE_OFFSET_SECONDS,
    rows_per_group: int = ROWS_PER_GROUP,
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """All versions of the keys with late changes, made anew.

    `late` has the keys, all attributes and the time of each change under the name of the start column; a row
    whose column `_gone` is true, if there is one, ends what is valid then. `repeats` has keys and times at which a
    state was confirmed. Where a late change and a version begin at one time, the late change counts; of several late
    changes of a key at one time, the greatest by its attributes. Columns of a version besides the framework's are kept
    with the start they belong to.
    """
    start, end = F.col(cols.start), F.col(cols.end)
    state = F.struct(*attributes)
    row = F.struct(*versions.columns)
    nothing, no_row = (F.lit(None).cast(versions.select(one.alias("_t")).schema["_t"].dataType) for one in (state, row))
    mine = semi_on_keys(versions, late, keys)
    offset = F.expr(f"INTERVAL {int(close_offset)} SECONDS")

    def events(frame: DataFrame, at: Column, kind: int, value: Column, old: Column) -> DataFrame:
        return frame.select(
            *keys, at.cast("timestamp_ntz").alias("_at"), F.lit(kind).alias("_kind"), value.alias("_state"), old.alias("_old")
        )

    new_state = F.struct(*[F.col(name).cast(versions.schema[name].dataType).alias(name) for name in attributes])
    if GONE in late.columns:
        new_state = F.when(~F.coalesce(GONE, F.lit(False)), new_state)
    # An end that another version follows at once is no event of its own: that version's start counts.
    line = events(mine, start, _START, state, row).unionByName(
        events(mine.where(end.isNotNull()), end + offset, _END, nothing, no_row)
    )
    if repeats is not None:
        confirmed = events(semi_on_keys(repeats, late, keys), start, _REPEAT, nothing, no_row)
        known = slice_hot_keys(line.unionByName(confirmed), keys, ["_at", "_kind"], rows_per_group)
        held = F.when(F.col("_kind") != _REPEAT, F.struct(F.col("_state").alias("state")))
        known = with_last_known(known, keys, ["_at", "_kind"], "_valid", held)
        confirmed = known.where((F.col("_kind") == _REPEAT) & F.col("_valid.state").isNotNull())
        line = line.unionByName(events(confirmed, F.col("_at"), _REPEAT, F.col("_valid.state"), no_row))
    line = line.unionByName(events(late, start, _LATE, new_state, no_row))
    best = F.max(F.struct("_kind", F.col("_state").alias("state"), "_old")).alias("_best")
    line = line.groupBy(*keys, "_at").agg(best).select(*keys, "_at", "_best.state", "_best._old")
    line = slice_hot_keys(line, keys, ["_at"], rows_per_group)
    line = with_previous(line, keys, ["_at"], {"_before": F.struct(F.col("state").alias("state"))})
    line = line.where(F.col("_before").isNull() | ~F.col("_before.state").eqNullSafe(F.col("state")))
    line = with_next(line, keys, ["_at"], {"_until": F.col("_at")})
    first, again = F.col("_before").isNull(), F.col("_before.state").isNull()
    until = (F.col("_until") - offset).cast("timestamp_ntz")
    reason = changed_reason(
        [F.col(f"_before.state.{name}") for name in attributes], [F.col(f"state.{name}") for name in attributes], attributes
    )
    opened = F.coalesce(
        F.when(F.col(f"_old.{cols.change}") == INSERTED, F.col(f"_old.{cols.reason}")),
        F.when(first, F.lit(INITIAL_REASON)).otherwise(F.lit(NEW_REASON)),
    )
    made = {
        **{name: F.col(f"state.{name}") for name in attributes},
        cols.start: F.col("_at"),
        cols.end: until,
        cols.current: F.col("_until").isNull(),
        cols.batch: batch_key(F.col("_at")),
        cols.change: F.when(again, INSERTED).otherwise(UPDATED),
        cols.reason: F.when(again, opened).otherwise(reason),
        cols.author: F.when(first & F.col("_until").isNull(), INITIAL_AUTHOR).otherwise(UPDATE_AUTHOR),
    }
    # `_old` is the version that began with this event, unless a late change took its place.
    columns = [
        (F.col(name) if name in keys else made.get(name, F.col(f"_old.{name}"))).cast(field.dataType).alias(name)
        for name, field in zip(versions.columns, versions.schema.fields)
    ]
    return line.where("state IS NOT NULL").select(*columns)


def apply_late(
    versions: DataFrame, late: DataFrame, keys: Sequence[str], attributes: Sequence[str], repeats: DataFrame | None = None, **options
) -> DataFrame:
    """A whole dimension with the late changes in it; the versions of other keys are not shuffled by a small batch."""
    others = semi_on_keys(versions, late, keys, "left_anti")
    return others.unionByName(with_late_changes(versions, late, keys, attributes, repeats, **options))
