"""Incremental loads: bounds, watermarks, new batches and whole runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.watermarks import bound_literal, convert_bound
from tidemark.operators.coerce import coerce, map_columns, rename_by_convention
from tidemark.operators.delta import changed_rows, merge_delta
from tidemark.operators.keys import without_match
from tidemark.operators.load import LOAD_ID, LOAD_SOURCE, Dataset, stamp
from tidemark.operators.state import LoadState, States, figures, holding, later, repaired, written_loads
from tidemark.session import materialize
from tidemark.sources.scan import scan
from tidemark.spec import Incremental, TableSpec


def since(df: DataFrame, incremental: Incremental, last: Any = None, lookback: str | None = None) -> DataFrame:
    """Rows at or past the bound, which is the last value loaded or else the initial one.

    A timestamp bound is inclusive, others are exclusive. The bound is a literal of the
    column's type, so the filter reaches the scan. Rows without a watermark never match.
    `lookback` (an interval such as `2 days`) reads late rows again.
    """
    value = incremental.initial if last is None else last
    column = F.col(incremental.column)
    if not isinstance(value, Column):
        value = convert_bound(value, incremental.strategy)
    bound = _earlier(_bound(df, incremental.column, value), lookback)
    return df.where(column >= bound if incremental.strategy == "timestamp" else column > bound)


def _earlier(bound: Column, lookback: str | None) -> Column:
    return bound - F.expr(f"INTERVAL {lookback}") if lookback else bound


def _bound(df: DataFrame, column: str, value: Any) -> Column:
    return value if isinstance(value, Column) else bound_literal(value, df.schema[column].dataType.simpleString())


def advance(loaded: DataFrame, column: str, previous: Column) -> DataFrame:
    """The new watermark: the greatest value loaded, or the previous one if nothing was."""
    return loaded.agg(F.coalesce(F.max(column), previous).alias("watermark"))


def loaded_before(dataset: Dataset, table: str, load_id: str, source: str | None = None) -> DataFrame:
    """The destination without what an earlier attempt of this load has written.

    Where the table keeps the source of its rows, only those of the given source.
    """
    rows = dataset.stored(table)
    if source is not None and LOAD_SOURCE in rows.columns:
        rows = rows.where(F.col(LOAD_SOURCE) == source)
    rows = rows.drop(LOAD_SOURCE)
    return rows.where(F.col(LOAD_ID) != load_id) if LOAD_ID in rows.columns else rows


def last_loaded(loaded: DataFrame, column: str) -> Any:
    """Watermark kept in the destination itself; None when it is empty."""
    highest = F.max(column)
    if loaded.schema[column].dataType.simpleString() == "timestamp":
        highest = highest.cast("timestamp_ntz")
    return loaded.agg(highest).first()[0]


def drop_loaded_boundary(
    rows: DataFrame, target: DataFrame, column: str, bound: Any, keys: Sequence[str], lookback: str | None = None
) -> DataFrame:
    """Without the rows from the bound on that the target already holds: those of the same key, or
    without keys the same rows, as many as it holds of them, so that true repeats stay.

    Rows at the inclusive bound are read again, with `lookback` those of that interval too; only
    these target rows are read.
    """
    limit = _earlier(_bound(target, column, bound), lookback)
    held = target.where((F.col(column) >= limit) & (F.col(column) <= _bound(target, column, bound)))
    if keys:
        return without_match(rows, held, keys)
    again = F.col(column) <= _bound(rows, column, bound)
    same = held.select(*[F.col(field.name).cast(field.dataType) for field in rows.schema.fields])
    return rows.where(~again | F.col(column).isNull()).unionByName(rows.where(again).exceptAll(same))


def new_batches(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Batch keys the source has and the target lacks."""
    return source.select(key).distinct().join(target.select(key).distinct(), key, "left_anti")


def next_batch(source: DataFrame, target: DataFrame, key: str, first_batches: int = 3) -> DataFrame:
    """Source rows to load next: the first batches into an empty target, else the calendar
    day after its latest. `key` is a yyyymmdd number. Both bounds are literals and reach the scan."""
    latest = target.agg(F.max(key)).first()[0]
    if latest is None:
        initial = source.select(key).where(F.col(key) > 0).distinct().orderBy(key).limit(first_batches)
        upto = initial.agg(F.max(key)).first()[0]
    else:
        following = datetime.strptime(str(latest), "%Y%m%d") + timedelta(days=1)
        upto = int(following.strftime("%Y%m%d"))
    return source.where((F.col(key) > F.lit(latest or 0)) & (F.col(key) <= F.lit(upto)))


def prepare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Coerce types, then rename by mapping and convention."""
    typed = coerce(df, spec.source_types, spec.hints)
    return rename_by_convention(map_columns(typed, spec.rename), spec.naming)


def run_load(
    dataset: Dataset,
    spec: TableSpec,
    load_id: str,
    loaded_at: datetime | str,
    lookback: str | None = None,
    **frames: DataFrame,
) -> Any:
    """One load of one table: scan, bound, coerce, stamp, write; returns the new watermark.

    The load begins where the state of the last one says (see `state`), for each source that appends to
    a table on its own; what a load has written is read back from its own files. Rows read again at an
    inclusive bound, or within `lookback`, are dropped if they are loaded already (append) or replaced
    (merge). `replace` loads the whole source: a watermark has no say in it. A load under the id of the
    last one takes up that load from where it began and replaces what it had written.
    """
    source = scan(dataset.spark, spec, **frames)
    names = _new_names(spec, source)
    keys = [names[key.lower()] for key in spec.primary_key]
    order = [names[column.lower()] for column in spec.order_by]
    watermark = names[spec.incremental.column.lower()] if spec.incremental else None
    appending, replacing = spec.disposition == "append", spec.disposition == "replace"
    if not watermark or replacing:
        rows = stamp(prepare(source if replacing else _since(source, spec, None, lookback), spec), load_id, loaded_at)
        _write(dataset, spec, rows, load_id, keys, order)
        return last_loaded(_rows_of(dataset, spec), watermark) if watermark else None

    states = States(dataset, spec.target, spec.source)
    loads = _earlier_loads(dataset, spec, states, load_id, watermark) if dataset.exists(spec.target) else []
    last = loads[-1].bound if loads else None
    rows = prepare(_since(source, spec, last, lookback), spec)
    if appending and last is not None and (spec.incremental.strategy == "timestamp" or lookback):
        loaded = _loaded_from(dataset, spec, loads, load_id, watermark, last, lookback)
        rows = drop_loaded_boundary(rows, loaded, watermark, last, keys, lookback)
    rows = stamp(rows, load_id, loaded_at)
    if not appending and not spec.merge_on_read:
        rows = materialize(rows, "batch")  # the merge needs it twice
    _write(dataset, spec, rows, load_id, keys, order or [watermark])
    if appending:
        written = _load_rows(dataset, spec, load_id)
    else:
        written = changed_rows(dataset, spec.target, load_id) if spec.merge_on_read else rows
    highest, count = figures(written, watermark)
    number = loads[-1].number + 1 if loads else 1
    states.put([*loads, LoadState(number, load_id, last, later(last, highest), highest, count, "")])
    return later(last, highest)


def _since(source: DataFrame, spec: TableSpec, last: Any, lookback: str | None) -> DataFrame:
    return since(source, spec.incremental, last, lookback) if spec.incremental else source


def _write(
    dataset: Dataset, spec: TableSpec, rows: DataFrame, load_id: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    if spec.disposition == "replace":
        dataset.replace(spec.target, rows)
    elif spec.disposition == "append":
        dataset.append(spec.target, rows, load_id, evolve=spec.evolve, source=spec.source)
    elif spec.merge_on_read:
        merge_delta(dataset, spec.target, rows, keys, order, load_id, evolve=spec.evolve)
    else:
        dataset.merge(spec.target, rows, keys, order, evolve=spec.evolve)


def _earlier_loads(
    dataset: Dataset, spec: TableSpec, states: States, load_id: str, watermark: str
) -> list[LoadState]:
    """The loads before this one, whether noted or not.

    A table without states is read once. A load that was written but not noted is read back from its own
    files; the given one is taken up again, if it is the last.
    """
    loads = states.all()
    if not loads:
        loaded = loaded_before(dataset, spec.target, load_id, spec.source) if spec.disposition == "append" else dataset.read(spec.target)
        last = last_loaded(loaded, watermark)
        if spec.disposition == "append":
            _require_latest(_rows_of(dataset, spec), watermark, load_id, last)
        if last is None:
            return []
        # Ids used before, of which no more is known, and all their rows as one.
        before = sorted((written_loads(dataset, spec.target, spec.source) or set()) - {load_id})
        return [*(LoadState(0, one, None, last, None, None, "") for one in before), LoadState(0, None, None, last, last, None, "")]
    if spec.disposition == "append":
        noted = {load.load_id for load in loads}
        found = written_loads(dataset, spec.target, spec.source) or set()
        loads = repaired(loads, list(found - noted - {load_id}), lambda one: _load_rows(dataset, spec, one), watermark)
    if loads[-1].load_id == load_id:
        return loads[:-1]
    if any(load.load_id == load_id and load.rows != 0 for load in loads) and spec.disposition == "append":
        raise ValueError(f"load id {load_id!r} was used by an earlier load")
    return [load for load in loads if load.load_id != load_id]


def _loaded_from(
    dataset: Dataset, spec: TableSpec, loads: Sequence[LoadState], load_id: str, watermark: str, last: Any, lookback: str | None
) -> DataFrame:
    """The rows of earlier loads, of those only that reach the bound."""
    loaded = loaded_before(dataset, spec.target, load_id, spec.source)
    kind = loaded.schema[watermark].dataType.simpleString()
    limit = _earlier(bound_literal(last, kind), lookback)
    ids = holding(loads, limit, kind, dataset) if LOAD_ID in loaded.columns else None
    return loaded if ids is None else loaded.where(F.col(LOAD_ID).isin(ids))


def _load_rows(dataset: Dataset, spec: TableSpec, load_id: str) -> DataFrame:
    """What one load has written; it is not packed yet."""
    rows = dataset.recent(spec.target)
    rows = rows.where(F.col(LOAD_SOURCE) == spec.source) if LOAD_SOURCE in rows.columns else rows
    return rows.where(F.col(LOAD_ID) == load_id) if LOAD_ID in rows.columns else rows


def _rows_of(dataset: Dataset, spec: TableSpec) -> DataFrame:
    """Rows of the destination that this spec's source has loaded, as far as that is kept."""
    rows = dataset.stored(spec.target)
    return rows.where(F.col(LOAD_SOURCE) == spec.source) if LOAD_SOURCE in rows.columns else rows


def _require_latest(target: DataFrame, column: str, load_id: str, last: Any) -> None:
    """A load id may be used again for the latest load only: its rows are written anew."""
    if LOAD_ID not in target.columns:
        return
    began = target.where(F.col(LOAD_ID) == load_id).agg(F.min(column) < _bound(target, column, last)).first()[0]
    if began:
        raise ValueError(f"load id {load_id!r} was used by an earlier load")


def _new_names(spec: TableSpec, source: DataFrame) -> dict[str, str]:
    """Destination name of each source column, the latter in lower case."""
    renamed = rename_by_convention(map_columns(source.limit(0), spec.rename), spec.naming)
    return {old.lower(): new for old, new in zip(source.columns, renamed.columns)}
