"""Loading type-2 history batch by batch.

A dimension is kept as two tables: the current versions, written anew by every batch, and
the closed ones, which a batch only adds to. A view over both is the dimension. So a batch
costs a pass over the current versions, however long the history is.

Changes that come late are kept in `<name>_late` until `apply_late_changes` cuts them into the
histories of their keys: the closed versions that this replaces are noted in `<name>_dropped`,
which the view leaves out, and those made anew are added, so that no closed version is rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.load import LOAD_ID, Dataset, merge_rows, quoted
from tidemark.operators.ordered import semi_on_keys
from tidemark.operators.scd2 import CLOSE_OFFSET_SECONDS, Batch, VersionColumns, closed_rows, current_rows
from tidemark.operators.scd2_late import GONE, with_late_changes
from tidemark.session import materialize

CURRENT, CLOSED, LATE, SEEN, DROPPED = "_current", "_closed", "_late", "_seen", "_dropped"
FIRST_LOAD = "initial"
APPLIED = "tidemark.applied"  # load id of the last late changes in the current versions
_LOADED_BY = "_loaded_by"  # load id of a dropped version


def start_dimension(
    dataset: Dataset, name: str, dimension: DataFrame, cols: VersionColumns = VersionColumns(),
    repeats: DataFrame | None = None,
) -> None:
    """Publish a dimension built as a whole, with the repeats that building it dropped (`repeated_changes`)."""
    open_ended = F.col(cols.end).isNull()
    dataset.append(name + CLOSED, dimension.where(~open_ended), load_id=FIRST_LOAD)
    dataset.replace(name + CURRENT, dimension.where(open_ended))
    if repeats is not None:
        dataset.append(name + SEEN, repeats, load_id=FIRST_LOAD)
    _publish(dataset, name, cols)


def _publish(dataset: Dataset, name: str, cols: VersionColumns, keys: Sequence[str] = (), pending: str | None = None) -> None:
    """The view over both tables, without dropped versions and without what a pending load has written so far."""
    columns = ", ".join(f"`{column}`" for column in current_table(dataset, name).columns)
    closed, without = f"{dataset.table(name + CLOSED)} c", ""
    if dataset.exists(name + DROPPED):
        same = " AND ".join(f"c.`{column}` <=> d.`{column}`" for column in [*keys, cols.start])
        closed += f" LEFT ANTI JOIN {dataset.table(name + DROPPED)} d ON {same} AND c.{LOAD_ID} = d.{_LOADED_BY}"
        if pending is not None:
            closed += f" AND d.{LOAD_ID} <> {quoted(pending)}"
    if pending is not None:
        without = f" WHERE c.{LOAD_ID} <> {quoted(pending)}"
    dataset.view(
        name, f"SELECT {columns} FROM {dataset.table(name + CURRENT)} UNION ALL SELECT {columns} FROM {closed}{without}"
    )


def load_batch(dataset: Dataset, name: str, load_id: str, batch: Batch, repeats: bool = True) -> None:
    """Apply one batch, whose dimension is the current table (`current_table`).

    The versions it closes are written first, under the load id, then the new current ones.
    A load that fails in between and runs again finds the current table as it was and closes
    the same versions, which replace those written before. Changes that come late, not after the
    start of the current version, change nothing here: they are kept in `<name>_late` under the
    load id, for `apply_late_changes`. With `repeats` the keys whose state the batch confirms
    are noted, which late changes need to come out as if they had come in time.
    """
    late = _late_rows(batch)
    if repeats and dataset.exists(name + SEEN):
        # A change before a state that was confirmed later is late too, whenever that state began.
        overtaken = (F.col(batch.cols.start) >= batch.at) & (F.col(LOAD_ID) != load_id)
        seen = dataset.read(name + SEEN).where(overtaken)
        if not seen.isEmpty():
            before = replace(batch, changes=semi_on_keys(batch.changes, seen, batch.keys))
            batch = replace(batch, changes=semi_on_keys(batch.changes, seen, batch.keys, "left_anti"))
            late = _late_rows(batch).unionByName(_changes_of(before.compared("inner"), before))
    _keep_late(dataset, name, load_id, late)
    if repeats:
        same = batch.compared("inner").where(~batch.touched() & batch.in_time())
        dataset.append(name + SEEN, same.select(*batch.keys, batch.at.alias(batch.cols.start)), load_id=load_id)
    before = dataset.read(name + CLOSED).where(F.col(LOAD_ID) == load_id)
    closed = merge_rows(
        before.select(*batch.dimension.columns), closed_rows(batch), [*batch.keys, batch.cols.start]
    )
    dataset.append(name + CLOSED, closed, load_id=load_id)
    dataset.replace(name + CURRENT, current_rows(batch))


def _late_rows(batch: Batch) -> DataFrame:
    """Changes not later than the current version, unless they are what began it."""
    begun = (batch.at == F.col("_old")[batch.cols.start]) & ~batch.touched()
    return _changes_of(batch.compared("inner").where(F.col("_is_new") & ~batch.in_time() & ~begun), batch)


def _changes_of(compared: DataFrame, batch: Batch) -> DataFrame:
    values = [value.alias(name) for name, value in zip(batch.attributes, batch.after())]
    return compared.select(*batch.keys, *values, batch.at.alias(batch.cols.start), batch.gone().alias(GONE))


def keep_late(
    dataset: Dataset, name: str, load_id: str, changes: DataFrame, keys: Sequence[str], attributes: Sequence[str],
    changed_at: str, cols: VersionColumns = VersionColumns(),
) -> None:
    """Keep changes that are known to be late, each with a time of its own, for `apply_late_changes`."""
    at = F.col(changed_at).cast("timestamp_ntz").alias(cols.start)
    _keep_late(dataset, name, load_id, changes.select(*keys, *attributes, at, F.lit(False).alias(GONE)))


def _keep_late(dataset: Dataset, name: str, load_id: str, late: DataFrame) -> None:
    if dataset.exists(name + LATE) or not late.isEmpty():
        dataset.append(name + LATE, late, load_id=load_id)


def apply_late_changes(
    dataset: Dataset, name: str, load_id: str, keys: Sequence[str], attributes: Sequence[str],
    close_offset: int = CLOSE_OFFSET_SECONDS, cols: VersionColumns = VersionColumns(),
) -> None:
    """Cut all late changes kept so far into the dimension and empty `<name>_late`.

    What it writes stays out of the view until the current versions are replaced, which marks it as done.
    A run that fails before that finds everything as it was; one that fails after it goes on from there.
    """
    if not dataset.exists(name + LATE):
        return
    if dataset.properties(name + CURRENT).get(APPLIED) != load_id:
        late = dataset.read(name + LATE).drop(LOAD_ID)
        if late.isEmpty():
            return
        _publish(dataset, name, cols, keys, pending=load_id)
        current = current_table(dataset, name)
        closed = _closed_before(dataset, name, load_id, keys, cols)
        versions = current.unionByName(closed.select(*current.columns))
        seen = dataset.read(name + SEEN).drop(LOAD_ID) if dataset.exists(name + SEEN) else None
        made = materialize(
            with_late_changes(versions, late, keys, attributes, seen, close_offset, cols=cols), "late"
        )
        dropped = semi_on_keys(closed, late, keys).select(*keys, cols.start, F.col(LOAD_ID).alias(_LOADED_BY))
        dataset.append(name + DROPPED, dropped, load_id=load_id)
        dataset.append(name + CLOSED, made.where(F.col(cols.end).isNotNull()), load_id=load_id)
        others = semi_on_keys(current, late, keys, "left_anti")
        dataset.replace(
            name + CURRENT, others.unionByName(made.where(F.col(cols.end).isNull())), properties={APPLIED: load_id}
        )
    dataset.replace(name + LATE, dataset.read(name + LATE).limit(0), [LOAD_ID])
    _publish(dataset, name, cols, keys)


def _closed_before(dataset: Dataset, name: str, load_id: str, keys: Sequence[str], cols: VersionColumns) -> DataFrame:
    """Closed versions as they were before a load."""
    closed = dataset.read(name + CLOSED).where(F.col(LOAD_ID) != load_id)
    if not dataset.exists(name + DROPPED):
        return closed
    dropped = dataset.read(name + DROPPED).where(F.col(LOAD_ID) != load_id)
    dropped = dropped.select(*keys, cols.start, F.col(_LOADED_BY).alias(LOAD_ID))
    return semi_on_keys(closed, dropped, [*keys, cols.start, LOAD_ID], "left_anti")


def compact_closed(dataset: Dataset, name: str, keys: Sequence[str], cols: VersionColumns = VersionColumns()) -> None:
    """Write the closed versions anew without the dropped ones; the dimension stays the same."""
    if dataset.exists(name + DROPPED):
        dataset.replace(name + CLOSED, _closed_before(dataset, name, "", keys, cols), [LOAD_ID])
        dataset.replace(name + DROPPED, dataset.read(name + DROPPED).limit(0), [LOAD_ID])


def current_table(dataset: Dataset, name: str) -> DataFrame:
    rows = dataset.read(name + CURRENT)
    return rows.drop(LOAD_ID)
