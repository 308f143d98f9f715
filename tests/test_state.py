"""State of loads, merges that write their own rows only, and their compaction."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import delta, incremental, layout, profile, state
from tidemark.operators.delta import change_share, changed_rows, compact, merge_delta
from tidemark.operators.incremental import run_load
from tidemark.operators.load import Dataset
from tidemark.spec import Incremental, TableSpec
from tidemark.streaming.incremental import file_stream, stream_merge_delta

NUMBERS = TableSpec("t", disposition="append", incremental=Incremental("id", -1, "sequence"))


def scanned(df):
    """Files that the plan of a frame reads."""
    return {path.rsplit("/", 2)[-2] for path in df.inputFiles()}


def watch_reads(monkeypatch, dataset, name):
    """Frames of the stored table that a load aggregates."""
    seen = []
    plain = state.figures

    def figures(rows, column):
        seen.append(rows)
        return plain(rows, column)

    monkeypatch.setattr(state, "figures", figures)
    monkeypatch.setattr(incremental, "figures", figures)
    monkeypatch.setattr(incremental, "last_loaded", lambda *_: pytest.fail("the destination was read for its bound"))
    return seen


def test_the_second_load_reads_no_more_than_its_own_files(spark, monkeypatch):
    dataset = Dataset(spark)
    run_load(dataset, NUMBERS, "run-1", "2024-01-01", t=spark.range(10))
    seen = watch_reads(monkeypatch, dataset, "t")
    assert run_load(dataset, NUMBERS, "run-2", "2024-01-02", t=spark.range(25)) == 24
    assert run_load(dataset, NUMBERS, "run-3", "2024-01-03", t=spark.range(25)) == 24
    assert [scanned(rows) for rows in seen] == [{"_load_id=run-2"}, set()]
    noted = state.load_states(dataset).orderBy("number").collect()
    assert [(row.load_id, row.began, row.bound, row.rows) for row in noted] == [
        ("run-1", None, "9", 10), ("run-2", "9", "24", 15), ("run-3", "24", "24", 0),
    ]


def test_a_load_that_was_written_but_not_noted(spark, monkeypatch):
    dataset = Dataset(spark)
    run_load(dataset, NUMBERS, "run-1", "2024-01-01", t=spark.range(10))
    with monkeypatch.context() as broken:
        broken.setattr(state.States, "put", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            run_load(dataset, NUMBERS, "run-2", "2024-01-02", t=spark.range(20))
    seen = watch_reads(monkeypatch, dataset, "t")
    # Another load finds what was written; the same load would take it up again.
    assert run_load(dataset, NUMBERS, "run-3", "2024-01-03", t=spark.range(30)) == 29
    assert scanned(seen[0]) == {"_load_id=run-2"}
    assert dataset.read("t").groupBy("id").count().where("count > 1").isEmpty() and dataset.read("t").count() == 30
    assert [row.load_id for row in state.load_states(dataset).orderBy("number").collect()] == ["run-1", "run-2", "run-3"]


def test_a_crashed_load_run_again(spark, monkeypatch):
    dataset = Dataset(spark)
    run_load(dataset, NUMBERS, "run-1", "2024-01-01", t=spark.range(10))
    with monkeypatch.context() as broken:
        broken.setattr(state.States, "put", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            run_load(dataset, NUMBERS, "run-2", "2024-01-02", t=spark.range(20))
    assert run_load(dataset, NUMBERS, "run-2", "2024-01-02", t=spark.range(22)) == 21
    assert dataset.read("t").count() == 22 and dataset.read("t").where("_load_id = 'run-2'").count() == 12


def test_state_does_not_outlive_its_table(spark):
    dataset = Dataset(spark)
    run_load(dataset, NUMBERS, "run-1", "2024-01-01", t=spark.range(10))
    dataset.replace("t", dataset.stored("t").where("id < 5"), ["_load_source", "_load_id"])
    run_load(dataset, NUMBERS, "run-2", "2024-01-02", t=spark.range(10))
    assert dataset.read("t").count() == 10
    with pytest.raises(ValueError, match="earlier load"):
        run_load(dataset, NUMBERS, "run-1", "2024-01-02", t=spark.range(10))


def test_only_loads_that_reach_the_bound_are_read_for_it(spark, rows, monkeypatch):
    start = datetime(2024, 1, 1)
    days = spark.createDataFrame([(start + timedelta(days=i // 3), i % 2) for i in range(30)], "at timestamp_ntz, kind int")
    spec = TableSpec("v", disposition="append", incremental=Incremental("at", "2024-01-01T00:00:00"))
    dataset, seen = Dataset(spark), []
    plain = incremental.drop_loaded_boundary
    monkeypatch.setattr(incremental, "drop_loaded_boundary", lambda new, held, *rest: (seen.append(held), plain(new, held, *rest))[1])
    for number, upto in enumerate([3, 5, 5, 9]):
        run_load(dataset, spec, f"run-{number}", "2024-02-01", v=days.where(F.col("at") <= start + timedelta(days=upto)))
    assert scanned(seen[-1]) == {"_load_id=run-1"}
    run_load(dataset, spec, "run-9", "2024-02-01", lookback="4 days", v=days)
    assert scanned(seen[-1]) == {"_load_id=run-1", "_load_id=run-3"}
    assert rows(dataset.read("v").select("at", "kind")) == rows(days)


@pytest.mark.parametrize(
    "value", [3, 2.5, Decimal("12.340"), "a'b", datetime(2024, 1, 2, 3, 4, 5, 678), datetime(2024, 1, 2).date(), None]
)
def test_bounds_survive_as_text(value):
    assert state.bound_value(state.bound_text(value), state.bound_kind(value)) == value


def upserts(seed):
    draw = random.Random(seed)
    return [[(draw.randrange(12), draw.randrange(9), f"{i}-{j}") for j in range(draw.randrange(1, 8))] for i in range(6)]


@pytest.mark.parametrize("partition_by", [[], ["k"]])
def test_merges_on_read_equal_merges_in_place(spark, rows, partition_by):
    one, other = Dataset(spark), Dataset(spark)
    for number, batch in enumerate(upserts(3)):
        frame = spark.createDataFrame(batch, "k int, w int, v string")
        one.merge("t", frame, ["k"], ["w"])
        for _ in range(2 if number % 2 else 1):  # a retry
            merge_delta(other, "t", frame, ["k"], ["w"], f"load-{number}", partition_by=partition_by)
        assert rows(other.read("t").select("k", "w", "v")) == rows(one.read("t"))
        if number == 3:
            assert change_share(other, "t") > 0
            compact(other, "t")
            compact(other, "t")
            assert change_share(other, "t") == 0
            assert rows(other.read("t").select("k", "w", "v")) == rows(one.read("t"))


def test_the_greatest_row_counts_whenever_it_comes(spark, rows):
    dataset, known = Dataset(spark), {}
    for number, batch in enumerate(upserts(5)):
        merge_delta(dataset, "t", spark.createDataFrame(batch, "k int, w int, v string"), ["k"], ["w"], f"{number}", by_order=True)
        for k, w, v in batch:
            known[k] = max(known.get(k, (-1, "")), (w, v))
        assert rows(dataset.read("t")) == sorted([(k, w, v) for k, (w, v) in known.items()], key=repr)
        if number == 2:
            compact(dataset, "t")


def test_a_merge_writes_its_own_rows_only(spark, monkeypatch):
    dataset = Dataset(spark)
    merge_delta(dataset, "t", spark.range(1000).selectExpr("id AS k", "0 AS w"), ["k"])
    base = set(dataset.stored("t").inputFiles())
    merge_delta(dataset, "t", spark.range(5).selectExpr("id AS k", "1 AS w"), ["k"], load_id="a/b=c")
    assert set(dataset.stored("t").inputFiles()) == base
    assert changed_rows(dataset, "t", "a/b=c").count() == 5
    assert dataset.read("t").where("w = 1").count() == 5 and dataset.read("t").count() == 1000
    plan = dataset.read("t")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(delta, "BROADCAST_ROWS", 5)
    merge_delta(dataset, "t", spark.range(5).selectExpr("id AS k", "2 AS w"), ["k"], load_id="more")
    assert "SortMergeJoin" in dataset.read("t")._jdf.queryExecution().executedPlan().toString()
    assert dataset.read("t").where("w = 2").count() == 5 and dataset.read("t").count() == 1000


def test_null_keys_and_extra_columns_are_refused(spark):
    dataset = Dataset(spark)
    merge_delta(dataset, "t", spark.sql("SELECT 1 AS k, 2 AS w"), ["k"])
    with pytest.raises(Exception, match="holds NULL"):
        merge_delta(dataset, "t", spark.sql("SELECT CAST(NULL AS INT) AS k, 2 AS w"), ["k"])
    with pytest.raises(ValueError, match="'x'"):
        merge_delta(dataset, "t", spark.sql("SELECT 1 AS k, 2 AS w, 3 AS x"), ["k"])
    with pytest.raises(ValueError, match="merge_on_read"):
        TableSpec("t", merge_on_read=True)


@pytest.mark.parametrize("on_read", [False, True])
def test_merging_runs(spark, rows, on_read):
    spec = TableSpec(
        "t", disposition="merge", primary_key=("k",), incremental=Incremental("w", -1, "sequence"), merge_on_read=on_read
    )
    dataset, source = Dataset(spark), spark.range(60).selectExpr("id % 7 AS k", "id AS w")
    for number, upto in enumerate([10, 30, 30, 60]):
        bound = run_load(dataset, spec, f"run-{number}", "2024-01-01", t=source.where(F.col("w") < upto))
        assert bound == upto - 1
        if on_read and number == 2:
            compact(dataset, "t")
    # A load run again begins where it began.
    assert run_load(dataset, spec, "run-3", "2024-01-01", t=source) == 59
    assert rows(dataset.read("t").select("k", "w")) == rows(source.groupBy("k").agg(F.max("w").alias("w")))
    noted = state.load_states(dataset).orderBy("number").collect()
    assert [(row.began, row.bound, row.rows) for row in noted] == [(None, "9", 7 if on_read else 10), ("9", "29", 7 if on_read else 20), ("29", "29", 0), ("29", "59", 7 if on_read else 30)]


def test_stream_of_upserts(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    for number, batch in enumerate(upserts(8)):
        spark.createDataFrame(batch, "k int, w int, v string").coalesce(1).write.mode("append").parquet(source)
    dataset = Dataset(spark)
    stream = file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    for _ in range(2):
        stream_merge_delta(stream, dataset, "t", ["k"], ["w"], str(tmp_path / "checkpoint"), compact_every=4)
    best = spark.read.parquet(source).groupBy("k").agg(F.max(F.struct("w", "v")).alias("b")).select("k", "b.w", "b.v")
    assert rows(dataset.read("t")) == rows(best)


def evolving(spark, dataset, spec, frames):
    for number, frame in enumerate(frames):
        run_load(dataset, spec, f"run-{number}", "2024-01-01", t=frame)
    return dataset.read("t")


@pytest.mark.parametrize("options", [{"disposition": "append"}, {"disposition": "merge"}, {"disposition": "merge", "merge_on_read": True}])
def test_wider_types_and_new_columns_are_taken_over(spark, rows, options):
    spec = TableSpec("t", primary_key=("id",), incremental=Incremental("id", -1, "sequence"), evolve=True, **options)
    frames = [
        spark.sql("SELECT CAST(id AS INT) AS id, CAST(1.5 AS FLOAT) AS f, CAST(2.25 AS DECIMAL(5,2)) AS d FROM range(3)"),
        spark.sql("SELECT id, CAST(0.1 AS DOUBLE) AS f, CAST(3.3333 AS DECIMAL(19,4)) AS d, 'x' AS note FROM range(3, 5)"),
        spark.sql("SELECT CAST(id AS SMALLINT) AS id, CAST(4.5 AS FLOAT) AS f, 'y' AS note FROM range(5, 6)"),
    ]
    dataset = Dataset(spark)
    found = evolving(spark, dataset, spec, frames).select("id", "f", F.col("d").cast("string"), "note")
    assert [kind for _, kind in found.dtypes] == ["bigint", "double", "string", "string"]
    expected = [(0, 1.5, "2.2500", None), (1, 1.5, "2.2500", None), (2, 1.5, "2.2500", None), (3, 0.1, "3.3333", "x"), (4, 0.1, "3.3333", "x"), (5, 4.5, None, "y")]
    assert rows(found) == expected
    # The last load run again replaces its own rows, whichever version wrote them.
    run_load(dataset, spec, "run-2", "2024-01-01", t=frames[2])
    assert rows(dataset.read("t").select("id")) == [(n,) for n in range(6)]
    for _ in range(3):
        dataset.replace("t", dataset.read("t"))
    assert dataset.read("t").count() == 6 and len(dataset._versions("t")) == 2


def test_narrowing_and_evolution_without_leave_are_refused(spark):
    wide = spark.sql("SELECT id, 'x' AS v FROM range(3)")
    for frame in (spark.sql("SELECT id, 1 AS v FROM range(9)"), spark.sql("SELECT CAST(id AS STRING) AS id, 'y' AS v FROM range(9)")):
        dataset = Dataset(spark)
        dataset.append("t", wide, load_id="a")
        if frame.schema["id"].dataType.simpleString() == "string":
            with pytest.raises(ValueError, match="does not fit"):
                dataset.append("t", frame, load_id="b", evolve=True)
    dataset = Dataset(spark)
    dataset.append("t", spark.sql("SELECT CAST(id AS INT) AS id FROM range(3)"), load_id="a")
    with pytest.raises(ValueError, match="does not fit"):
        dataset.append("t", spark.range(5), load_id="b")
    dataset.append("t", spark.range(5), load_id="b", evolve=True)
    assert dataset.read("t").count() == 8 and dataset.read("t").dtypes[0] == ("id", "bigint")
    dataset.append("t", spark.range(7), load_id="b")
    assert dataset.read("t").count() == 10


def test_sketches_of_loads_merge(spark):
    dataset = Dataset(spark)
    frame = spark.sql(
        "SELECT id, CAST(id % 50 AS STRING) AS s, IF(id % 5 = 0, NULL, id * 1.5D) AS x, DATE'2024-01-01' + CAST(id % 9 AS INT) AS day, "
        "CAST(NULL AS STRING) AS nothing FROM range(3000)"
    )
    for number in (0, 1, 2, 2):
        profile.keep_sketches(dataset, "t", frame.where(f"id % 3 = {number}"), f"load-{number}")
    found = {row.column_name: row for row in profile.kept_profile(dataset, "t").collect()}
    exact = {row.column_name: row for row in profile.column_profile(frame, "t").collect()}
    for name, row in exact.items():
        assert (found[name].row_count, found[name].null_count) == (row.row_count, row.null_count)
        assert abs(found[name].distinct_estimate - row.distinct_count) <= row.distinct_count * profile.SKETCH_ERROR
    assert (found["id"].lowest, found["id"].highest) == ("0", "2999") and found["x"].highest == "4498.5"
    assert (found["s"].lowest, found["s"].highest) == ("0", "9") and found["day"].highest == "2024-01-09"
    assert found["nothing"].lowest is None and found["nothing"].distinct_estimate == 0


def loaded_days(spark, dataset, pack_at=(), source="v"):
    """Six loads of two days each; returns all rows."""
    rows_ = spark.range(60).selectExpr("id", "CAST(id DIV 5 AS INT) AS day")
    spec = TableSpec(source, "t", "append", incremental=Incremental("day", -1, "sequence"))
    for number in range(6):
        run_load(dataset, spec, f"it's {number}", "2024-01-01", **{source: rows_.where(f"day < {2 * number + 2}")})
        if number in pack_at:
            layout.pack_loads(dataset, "t", ["day"])
    return rows_


def test_packed_loads_stay_as_they_are(spark, rows):
    dataset, plain = Dataset(spark), Dataset(spark)
    loaded_days(spark, plain)
    source = loaded_days(spark, dataset, pack_at=(2, 5))
    assert rows(dataset.read("t")) == rows(plain.read("t"))
    assert dataset.recent("t").select("_load_id").distinct().collect() == [("it's 5",)]
    # A filter on the batch key reads packed partitions of that key only.
    found = dataset.read("t").where("day = 3").inputFiles()
    assert {path for path in found if "__a" in path and "day=3" not in path} == set()
    spec = TableSpec("v", "t", "append", incremental=Incremental("day", -1, "sequence"))
    run_load(dataset, spec, "it's 5", "2024-01-01", v=source)
    assert rows(dataset.read("t").select("id", "day")) == rows(source)
    with pytest.raises(ValueError, match="earlier load"):
        run_load(dataset, spec, "it's 1", "2024-01-01", v=source)
    assert layout.pack_loads(dataset, "t", ["day"]) == []
    dataset.append("t", spark.sql("SELECT 99L AS id, 50L AS day, 'n' AS note"), load_id="late", evolve=True, source="v")
    assert dataset.read("t").dtypes[1] == ("day", "bigint") and dataset.read("t").where("note IS NULL").count() == 60
    with pytest.raises(ValueError, match="other columns"):
        layout.pack_loads(dataset, "t", ["day"], ["late"])
    dataset.replace("t", dataset.read("t").where("id < 30"))
    assert dataset.read("t").count() == 30


@pytest.mark.parametrize("after", [0, 1, 2])
def test_packing_survives_a_crash(spark, rows, monkeypatch, after):
    dataset = Dataset(spark)
    source = loaded_days(spark, dataset, pack_at=(1,))
    calls, plain = [], Dataset._show

    def show(self, *args, **options):
        calls.append(1)
        if len(calls) > after:
            raise RuntimeError("crash")
        return plain(self, *args, **options)

    with monkeypatch.context() as broken:
        broken.setattr(Dataset, "_show", show)
        try:
            layout.pack_loads(dataset, "t", ["day"])
        except RuntimeError:
            pass
    assert rows(dataset.read("t").select("id", "day")) == rows(source)
    layout.pack_loads(dataset, "t", ["day"])
    assert rows(dataset.read("t").select("id", "day")) == rows(source)
    assert dataset.recent("t").select("_load_id").distinct().count() == 1


def test_only_tables_of_loads_are_packed(spark):
    dataset = Dataset(spark)
    dataset.replace("t", spark.range(3))
    with pytest.raises(ValueError, match="partitioned by load"):
        layout.pack_loads(dataset, "t")
