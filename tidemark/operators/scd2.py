"""Type-2 history: building versions, applying a batch of changes, reading versions back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.watermarks import batch_key, moment
from tidemark.operators.keys import latest_per_key, without_match
from tidemark.operators.ordered import (
    ROWS_PER_GROUP,
    is_scan,
    join_on_keys,
    slice_hot_keys,
    with_last_known,
    with_next,
    with_previous,
)
from tidemark.session import materialize

LOOKUP_VERSIONS = 2_000_000  # versions that are broadcast
# Fixed values.
OPEN_END = "9999-12-31"
CLOSE_OFFSET_SECONDS = 1
INSERTED = "INSERT"
UPDATED = "UPDATE"
INITIAL_AUTHOR = "SCD2_ETL_INITIAL"
UPDATE_AUTHOR = "SCD2_ETL_UPDATE"
NEW_AUTHOR = "SCD2_ETL_NEW"
INITIAL_REASON = "Initial client load"
NEW_REASON = "New client onboarding"


@dataclass(frozen=True)
class VersionColumns:
    """Names of the framework columns of a history table."""

    start: str = "effective_from"
    end: str = "effective_to"
    current: str = "is_latest"
    batch: str = "batch_key"
    change: str = "change_type"
    reason: str = "change_reason"
    author: str = "modified_by"

    def names(self) -> list[str]:
        return [self.start, self.end, self.current, self.batch, self.change, self.reason, self.author]


COLUMNS = VersionColumns()


def _seconds(count: int) -> Column:
    return F.expr(f"INTERVAL {int(count)} SECONDS")


def _version(
    keys: Sequence[str], attributes: Mapping[str, Column], start: Column, end: Column,
    change: Column, reason: Column, author: Column, cols: VersionColumns,
) -> list[Column]:
    """The columns of a version, in table order."""
    return [
        *[F.col(key) for key in keys],
        *[value.alias(name) for name, value in attributes.items()],
        start.alias(cols.start),
        end.alias(cols.end),
        end.isNull().alias(cols.current),
        batch_key(start).alias(cols.batch),
        change.alias(cols.change),
        reason.alias(cols.reason),
        author.alias(cols.author),
    ]


def initial_versions(
    entities: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    as_of: datetime | str | Column,
    order: Sequence[str] = (),
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """First version of every entity of the first batch, one per key."""
    one = latest_per_key(entities.select(*dict.fromkeys([*keys, *attributes, *order])), keys, order)
    nothing = F.lit(None).cast("timestamp_ntz")
    return one.select(
        *_version(
            keys, {name: F.col(name) for name in attributes}, moment(as_of), nothing,
            F.lit(INSERTED), F.lit(INITIAL_REASON), F.lit(INITIAL_AUTHOR), cols,
        )
    )


def build_versions(
    history: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    changed_at: str,
    tie_breakers: Sequence[str] = (),
    close_offset: int = CLOSE_OFFSET_SECONDS,
    rows_per_group: int = ROWS_PER_GROUP,
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """All versions at once from a change history: repeated states dropped, each version
    ended before the next begins."""
    order = [changed_at, *tie_breakers]
    rows = history.select(*dict.fromkeys([*keys, *attributes, *order]))
    rows = slice_hot_keys(rows, keys, order, rows_per_group)
    state = F.struct(*attributes)
    rows = with_previous(rows, keys, order, {"_before": state})
    rows = rows.where(~F.col("_before").eqNullSafe(state))
    rows = with_next(rows, keys, order, {"_until": F.col(changed_at)})
    first = F.col("_before").isNull()
    before = [F.col(f"_before.{name}") for name in attributes]
    reason = changed_reason(before, [F.col(name) for name in attributes], attributes)
    return rows.select(
        *_version(
            keys,
            {name: F.col(name) for name in attributes},
            moment(F.col(changed_at)),
            (F.col("_until") - _seconds(close_offset)).cast("timestamp_ntz"),
            F.when(first, INSERTED).otherwise(UPDATED),
            F.when(first, INITIAL_REASON).otherwise(reason),
            F.when(first & F.col("_until").isNull(), INITIAL_AUTHOR).otherwise(UPDATE_AUTHOR),
            cols,
        )
    )


def changed_names(before: Sequence[Column], after: Sequence[Column], names: Sequence[str]) -> Column:
    """Names of the attributes that differ, NULL being a value like any other."""
    flags = [F.when(~old.eqNullSafe(new), F.lit(name)) for old, new, name in zip(before, after, names)]
    return F.array_compact(F.array(*flags))


def changed_reason(before: Sequence[Column], after: Sequence[Column], names: Sequence[str]) -> Column:
    return F.concat(F.lit("Changed: "), F.array_join(changed_names(before, after, names), ", "))


@dataclass(frozen=True)
class Batch:
    """One batch of changes against a dimension.

    An attribute the changes lack keeps its old value; an explicit NULL is a change to NULL.
    `delete_flag` names a boolean column of the changes that only closes the current version.
    """

    dimension: DataFrame
    changes: DataFrame
    keys: Sequence[str]
    attributes: Sequence[str]
    as_of: datetime | str | Column
    order: Sequence[str] = ()
    close_offset: int = CLOSE_OFFSET_SECONDS
    delete_flag: str | None = None
    cols: VersionColumns = COLUMNS

    @property
    def at(self) -> Column:
        return moment(self.as_of)

    @property
    def given(self) -> list[str]:
        return [name for name in self.attributes if name in self.changes.columns]

    def current(self) -> DataFrame:
        return self.dimension.where(F.col(self.cols.end).isNull())

    def history(self) -> DataFrame:
        return self.dimension.where(F.col(self.cols.end).isNotNull())

    def latest(self) -> DataFrame:
        """The changes, one row per key."""
        flag = [self.delete_flag] if self.delete_flag else []
        names = dict.fromkeys([*self.keys, *self.given, *self.order, *flag])
        return latest_per_key(self.changes.select(*names), self.keys, self.order)

    def compared(self, how: str) -> DataFrame:
        """Current rows (`_old`) next to the change of their key (`_new`).

        A left or inner join, so that a small batch is broadcast and the dimension stays put.
        """
        flag = [self.delete_flag] if self.delete_flag else []
        incoming = self.latest().select(
            *self.keys, F.struct(*self.given, *flag).alias("_new"), F.lit(True).alias("_is_new")
        )
        current = self.current().select(*self.keys, F.struct(*self.dimension.columns).alias("_old"))
        return current.join(incoming, list(self.keys), how)

    def before(self) -> list[Column]:
        return [F.col("_old")[name] for name in self.attributes]

    def after(self) -> list[Column]:
        return [F.col("_new" if name in self.given else "_old")[name] for name in self.attributes]

    def gone(self) -> Column:
        flag = F.col("_new")[self.delete_flag] if self.delete_flag else F.lit(False)
        return F.coalesce(flag, F.lit(False))

    def touched(self) -> Column:
        differs = ~F.struct(*self.before()).eqNullSafe(F.struct(*self.after()))
        return F.col("_is_new").isNotNull() & (differs | self.gone())

    def in_time(self) -> Column:
        return self.at > F.col("_old")[self.cols.start]

    def old_row(self) -> Column:
        """The current row, closed when its key is touched."""
        closed = self.touched() & self.in_time()
        replaced = {
            self.cols.end: self.at - _seconds(self.close_offset),
            self.cols.current: F.lit(False),
            self.cols.author: F.lit(UPDATE_AUTHOR),
        }
        old = F.col("_old")
        return self._row(
            {
                name: F.when(closed, replaced[name]).otherwise(old[name]) if name in replaced else old[name]
                for name in self.dimension.columns
            }
        )

    def opened_row(self) -> Column:
        """The version that follows a closed one."""
        reason = changed_reason(self.before(), self.after(), self.attributes)
        return self._row(self._opened(self.after(), UPDATED, reason, UPDATE_AUTHOR))

    def added_rows(self) -> DataFrame:
        """First versions of keys without a current one."""
        unseen = without_match(self.latest(), self.current(), self.keys)
        if self.delete_flag:
            unseen = unseen.where(~F.coalesce(F.col(self.delete_flag), F.lit(False)))
        values = [F.col(name) if name in self.given else F.lit(None) for name in self.attributes]
        row = self._row(self._opened(values, INSERTED, F.lit(NEW_REASON), NEW_AUTHOR))
        return unseen.select(row.alias("_row")).select("_row.*")

    def _opened(self, values: Sequence[Column], change: str, reason: Column, author: str) -> dict[str, Column]:
        framework = {
            self.cols.start: self.at,
            self.cols.current: F.lit(True),
            self.cols.batch: batch_key(self.at),
            self.cols.change: F.lit(change),
            self.cols.reason: reason,
            self.cols.author: F.lit(author),
        }
        return {key: F.col(key) for key in self.keys} | dict(zip(self.attributes, values)) | framework

    def _row(self, values: Mapping[str, Column]) -> Column:
        """A row of the dimension; columns without a value are NULL."""
        return F.struct(
            *[
                values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
                for field in self.dimension.schema.fields
            ]
        )


def apply_changes(batch: Batch) -> DataFrame:
    """The dimension after one batch: touched versions closed and reopened, new keys added.

    Closed history is not shuffled. Applying the same batch again changes nothing. Changes
    not later than the current version are left to `late_changes`. Publish or materialize
    the result before the next batch.
    """
    reopened = batch.touched() & batch.in_time() & ~batch.gone()
    rows = F.array_compact(F.array(batch.old_row(), F.when(reopened, batch.opened_row())))
    seen = batch.compared("left").select(F.inline(rows))
    return batch.history().unionByName(seen).unionByName(batch.added_rows())


def closed_rows(batch: Batch) -> DataFrame:
    """The versions a batch closes."""
    touched = batch.compared("inner").where(batch.touched() & batch.in_time())
    return touched.select(batch.old_row().alias("_row")).select("_row.*")


def current_rows(batch: Batch) -> DataFrame:
    """The current versions after a batch."""
    closed = batch.touched() & batch.in_time()
    row = F.when(~closed, batch.old_row()).when(~batch.gone(), batch.opened_row())
    seen = batch.compared("left").select(row.alias("_row")).where("_row IS NOT NULL")
    return seen.select("_row.*").unionByName(batch.added_rows())


def close_versions(batch: Batch) -> DataFrame:
    """The dimension with the touched versions closed, before new ones open."""
    seen = batch.compared("left").select(batch.old_row().alias("_row")).select("_row.*")
    return batch.history().unionByName(seen)


def new_versions(batch: Batch) -> DataFrame:
    """The versions that changes of known keys open."""
    touched = batch.compared("inner").where(batch.touched() & batch.in_time() & ~batch.gone())
    return touched.select(batch.opened_row().alias("_row")).select("_row.*")


def new_entities(batch: Batch) -> DataFrame:
    """The first versions of keys without a current one."""
    return batch.added_rows()


def late_changes(batch: Batch) -> DataFrame:
    """Changes that are not later than the current version; rebuild their keys from history."""
    late = batch.compared("inner").where(batch.touched() & ~batch.in_time())
    return late.select(*batch.keys, *[value.alias(name) for name, value in zip(batch.attributes, batch.after())])


def detect_changes(batch: Batch) -> DataFrame:
    """Keys a batch adds or changes, with the names of the attributes that differ."""
    names = changed_names(batch.before(), batch.after(), batch.attributes)
    changed = batch.compared("inner").where(batch.touched() & batch.in_time() & ~batch.gone())
    changed = changed.select(
        *batch.keys, F.lit(UPDATED).alias("change_type"), F.array_join(names, ",").alias("changed_attributes")
    )
    added = batch.added_rows().select(
        *batch.keys, F.lit(INSERTED).alias("change_type"), F.lit("").alias("changed_attributes")
    )
    return changed.unionByName(added)


def current_versions(dimension: DataFrame, cols: VersionColumns = COLUMNS) -> DataFrame:
    return dimension.where(F.col(cols.current))


def timeline(dimension: DataFrame, key: str, value: Any, cols: VersionColumns = COLUMNS) -> DataFrame:
    """All versions of one key in order."""
    return dimension.where(F.col(key) == F.lit(value)).orderBy(cols.start)


def as_of(dimension: DataFrame, at: datetime | str, cols: VersionColumns = COLUMNS) -> DataFrame:
    """Versions valid at a point in time; the end is exclusive."""
    at = moment(at)
    return dimension.where((F.col(cols.start) <= at) & (F.col(cols.end).isNull() | (F.col(cols.end) > at)))


def effective_within(
    dimension: DataFrame, first: datetime | str, last: datetime | str, cols: VersionColumns = COLUMNS
) -> DataFrame:
    """Versions that begin in a range of dates and do not end after it, open ones included."""
    return dimension.where(
        (F.col(cols.start) >= moment(first)) & (F.col(cols.end).isNull() | (F.col(cols.end) <= moment(last)))
    )


def trend(
    dimension: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    where: Column | None = None,
    rows_per_group: int = ROWS_PER_GROUP,
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """Each version with the attributes of the version before it, among those selected."""
    rows = dimension if where is None else dimension.where(where)
    rows = slice_hot_keys(rows.select(*keys, cols.start, *attributes), keys, [cols.start], rows_per_group)
    previous = {f"previous_{name}": F.col(name) for name in attributes}
    found = with_previous(rows, keys, [cols.start], previous)
    return found.select(*keys, cols.start, *attributes, *previous)


def join_current(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], attributes: Sequence[str],
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """Facts with the attributes of the current version of their key.

    No broadcast is forced: Spark broadcasts the current versions while they are below its
    size limit, and splits a skewed fact key otherwise.
    """
    return facts.join(current_versions(dimension, cols).select(*keys, *attributes), list(keys))


def join_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    attributes: Sequence[str],
    how: str = "inner",
    coarse_times: bool = False,
    rows_per_group: int = ROWS_PER_GROUP,
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """Facts with the attributes of the version valid at their time.

    Versions and facts of a key are laid on one time line, and each fact takes the version
    last begun: one shuffle and one sort, linear in rows however many versions a key has.
    The versions of a key must not overlap (see the overlap check).

    Where many facts share a key and a time, as with times of whole days, `coarse_times`
    looks up each key and time once and joins the facts to the answers. A NULL key has no version.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join type {how!r}")
    dimension = dimension.dropna(subset=[*keys])
    if coarse_times:
        asked = facts.select(*keys, fact_time).distinct()
        answers = join_as_of(
            asked, dimension, keys, fact_time, attributes, "inner", False, rows_per_group, cols
        )
        return join_on_keys(facts, answers, [*keys, fact_time], how)
    opened = dimension.select(
        *keys,
        F.col(cols.start).alias("_time"),
        F.lit(0).alias("_kind"),
        F.struct(*attributes, F.col(cols.end).alias("_end")).alias("_version"),
        F.lit(None).cast(_struct_type(facts)).alias("_fact"),
    )
    happened = facts.select(
        *keys,
        F.col(fact_time).cast("timestamp_ntz").alias("_time"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(opened.schema["_version"].dataType).alias("_version"),
        F.struct(*facts.columns).alias("_fact"),
    )
    line = slice_hot_keys(opened.unionByName(happened), keys, ["_time", "_kind"], rows_per_group)
    known = with_last_known(line, keys, ["_time", "_kind"], "_valid", F.col("_version"))
    at_fact = known.where(F.col("_kind") == 1)
    end = F.coalesce(F.col("_valid._end"), F.lit(OPEN_END).cast("timestamp_ntz"))
    valid = F.col("_valid").isNotNull() & (F.col("_time") < end)
    if how == "inner":
        at_fact = at_fact.where(valid)
    return at_fact.select("_fact.*", *[F.when(valid, F.col(f"_valid.{name}")).alias(name) for name in attributes])


def join_as_of_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    attributes: Sequence[str],
    how: str = "inner",
    most_versions: int = LOOKUP_VERSIONS,
    cols: VersionColumns = COLUMNS,
) -> DataFrame:
    """The same as `join_as_of` for a dimension of few versions: facts stay where they are.

    The versions of a key become one sorted array, which is broadcast and searched by halving. The
    versions are counted first; with more than `most_versions` the time line of `join_as_of` is used.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join type {how!r}")
    known = dimension.dropna(subset=[*keys]).select(*keys, cols.start, cols.end, *attributes)
    if not is_scan(known):
        known = materialize(known, "versions")
    if known.count() > most_versions:
        return join_as_of(facts, known, keys, fact_time, attributes, how, cols=cols)
    version = F.struct(
        F.col(cols.start).alias("start"), F.coalesce(cols.end, F.lit(OPEN_END).cast("timestamp_ntz")).alias("end"),
        F.struct(*attributes).alias("values"),
    )
    lines = known.groupBy(*[F.col(key).alias(f"_key_{key}") for key in keys]).agg(
        F.array_sort(F.collect_list(version)).alias("_line")
    )
    matches = [facts[key] == lines[f"_key_{key}"] for key in keys]
    found = facts.join(F.broadcast(lines), reduce(lambda one, other: one & other, matches), how)
    at, line = F.col(fact_time).cast("timestamp_ntz"), F.col("_line")
    powers = F.array(*[F.lit(1 << place) for place in range(31)])
    steps = F.reverse(F.slice(powers, 1, F.length(F.bin(F.size(line)))))

    def go(place: Column, step: Column) -> Column:
        begun = (place + step <= F.size(line)) & (F.get(line, place + step - 1)["start"] <= at)
        return F.when(begun, place + step).otherwise(place)

    last = F.get(line, F.aggregate(steps, F.lit(0), go) - 1)
    found = found.withColumn("_last", F.when(line.isNotNull(), last))
    valid = F.col("_last").isNotNull() & (at < F.col("_last.end"))
    if how == "inner":
        found = found.where(valid)
    return found.select(
        *[facts[name] for name in facts.columns], *[F.when(valid, F.col(f"_last.values.{name}")).alias(name) for name in attributes]
    )


def _struct_type(df: DataFrame):
    return df.select(F.struct(*df.columns).alias("_row")).schema["_row"].dataType
