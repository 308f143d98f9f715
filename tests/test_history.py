"""Type-2 history: properties, replays, late changes, hot keys, against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import ordered, scd2, scd2_late, scd2_load
from tidemark.operators import scd2_checks as check
from tidemark.operators.load import Dataset
from tidemark.operators.scd2_load import (
    CLOSED,
    apply_late_changes,
    compact_closed,
    current_table,
    keep_late,
    load_batch,
    start_dimension,
)
from tidemark.session import materialize

START = datetime(2024, 1, 1)
SCHEMA = "k string, a string, b int, ts timestamp_ntz, seq int"
CORE = ["k", "a", "b", "effective_from", "effective_to", "is_latest", "change_type"]


def changes_frame(spark, entries):
    return spark.createDataFrame([(k, a, b, START + timedelta(hours=h), n) for n, (k, a, b, h) in enumerate(entries)], SCHEMA)


def build(df, **options):
    return scd2.build_versions(df, ["k"], ["a", "b"], "ts", ["seq"], **options)


def test_build_drops_repeats_and_closes(spark):
    df = changes_frame(spark, [("x", "p", 1, 0), ("x", "p", 1, 5), ("x", None, 1, 10), ("x", None, 1, 11), ("x", "p", 1, 12)])
    made = [tuple(row) for row in build(df).select("a", "effective_from", "effective_to", "is_latest", "change_type").orderBy("effective_from").collect()]
    at = lambda h: START + timedelta(hours=h)
    second = timedelta(seconds=1)
    assert made == [
        ("p", at(0), at(10) - second, False, "INSERT"),
        (None, at(10), at(12) - second, False, "UPDATE"),
        ("p", at(12), None, True, "UPDATE"),
    ]
    gapless = build(df, close_offset=0).where("effective_from = timestamp_ntz'2024-01-01'").first()
    assert gapless.effective_to == at(10)


def test_apply_day_by_day_equals_build(spark, rows):
    random.seed(5)
    entries = [
        (f"k{random.randrange(20)}", random.choice(["p", "q", None]), random.choice([1, 2, None]), day * 24)
        for day in range(6)
        for _ in range(25)
    ]
    history = changes_frame(spark, entries).dropDuplicates(["k", "ts"])
    history = materialize(history)
    dimension = build(history.where("ts < timestamp_ntz'2024-01-02'"))
    for day in range(1, 6):
        moment = START + timedelta(days=day)
        batch = scd2.Batch(dimension, history.where(F.col("ts") == F.lit(str(moment)).cast("timestamp_ntz")), ["k"], ["a", "b"], moment)
        dimension = materialize(scd2.apply_changes(batch))
        split = scd2.closed_rows(batch).unionByName(scd2.current_rows(batch)).unionByName(batch.history())
        assert rows(split) == rows(dimension)
        again = scd2.Batch(dimension, batch.changes, ["k"], ["a", "b"], moment)
        assert rows(scd2.apply_changes(again)) == rows(dimension)
    assert rows(dimension.select(*CORE)) == rows(build(history).select(*CORE))
    assert check.several_current(dimension, ["k"]).count() == 0
    assert check.orphans(dimension, ["k"]).count() == 0
    assert check.gaps(dimension, ["k"]).count() == 0
    numbered = dimension.withColumn("v", F.monotonically_increasing_id())
    assert check.overlapping_versions(materialize(numbered), ["k"], "v").count() == 0


def small_dimension(spark):
    return build(changes_frame(spark, [("x", "p", 1, 0), ("y", "q", None, 0), ("z", "r", 3, 48)]))


def test_missing_attribute_keeps_and_null_changes(spark):
    dimension = small_dimension(spark)
    changes = spark.createDataFrame([("x", None)], "k string, a string")
    after = scd2.apply_changes(scd2.Batch(dimension, changes, ["k"], ["a", "b"], "2024-01-02"))
    now = after.where("k = 'x' AND is_latest").first()
    assert (now.a, now.b, now.change_reason, now.batch_key) == (None, 1, "Changed: a", 20240102)


def test_late_changes_are_set_aside(spark, rows):
    dimension = small_dimension(spark)
    changes = spark.createDataFrame([("z", "new", 3), ("x", "p", 1)], "k string, a string, b int")
    batch = scd2.Batch(dimension, changes, ["k"], ["a", "b"], "2024-01-02")
    assert rows(scd2.late_changes(batch)) == [("z", "new", 3)]
    assert rows(scd2.apply_changes(batch)) == rows(dimension)


def test_deletes_only_close_and_keys_come_back(spark):
    dimension = small_dimension(spark)
    gone = spark.createDataFrame([("x", "p", 1, True), ("new", "n", 1, True)], "k string, a string, b int, deleted boolean")
    batch = scd2.Batch(dimension, gone, ["k"], ["a", "b"], "2024-01-05", delete_flag="deleted")
    after = materialize(scd2.apply_changes(batch))
    assert scd2.closed_rows(batch).count() == 1 and scd2.current_rows(batch).count() == 2
    assert after.where("k = 'x'").select("is_latest").collect() == [(False,)]
    assert after.where("k = 'new'").count() == 0
    back = spark.createDataFrame([("x", "p", 1)], "k string, a string, b int")
    again = scd2.apply_changes(scd2.Batch(after, back, ["k"], ["a", "b"], "2024-01-07"))
    assert again.where("k = 'x' AND is_latest").first().change_type == "INSERT"
    assert again.where("k = 'x'").count() == 2


def test_several_changes_of_a_key_in_a_batch(spark):
    changes = spark.createDataFrame([("x", "s", 1, 1), ("x", "t", 1, 2)], "k string, a string, b int, n int")
    after = scd2.apply_changes(scd2.Batch(small_dimension(spark), changes, ["k"], ["a", "b"], "2024-01-05", order=["n"]))
    assert after.where("k = 'x' AND is_latest").first().a == "t"


def test_other_columns_of_a_dimension_survive(spark):
    dimension = small_dimension(spark).withColumn("version_key", F.lit(7).cast("bigint"))
    changes = spark.createDataFrame([("x", "s", 1)], "k string, a string, b int")
    after = scd2.apply_changes(scd2.Batch(dimension, changes, ["k"], ["a", "b"], "2024-01-05"))
    assert after.columns == dimension.columns
    assert after.where("k = 'x'").select("is_latest", "version_key").orderBy("is_latest").collect() == [(False, 7), (True, None)]


def test_own_column_names(spark):
    names = scd2.VersionColumns("EffectiveFromDate", "EffectiveToDate", "IsLatest", "SystemCalendarID", "ChangeType", "ChangeReason", "ModifiedBy")
    made = build(changes_frame(spark, [("x", "p", 1, 0)]), cols=names)
    assert made.columns == ["k", "a", "b", *names.names()]
    assert scd2.as_of(made, "2024-01-03", names).count() == 1


def test_a_failed_batch_load_runs_again(spark, rows):
    """The first attempt dies after the closed versions are written."""
    dataset = Dataset(spark)
    start_dimension(dataset, "dim", small_dimension(spark))
    changes = spark.createDataFrame([("x", "s", 1), ("y", "q", 5)], "k string, a string, b int")

    def batch(of=changes):
        return scd2.Batch(current_table(dataset, "dim"), of, ["k"], ["a", "b"], "2024-01-05")

    expected = rows(scd2.apply_changes(scd2.Batch(dataset.read("dim"), changes, ["k"], ["a", "b"], "2024-01-05")))
    closed = scd2.apply_changes(batch()).where("effective_to IS NOT NULL")
    dataset.append("dim" + CLOSED, closed, load_id="day-5")
    load_batch(dataset, "dim", "day-5", batch())
    assert rows(dataset.read("dim")) == expected
    # The same load with one more change keeps what it has closed.
    more = changes.unionByName(spark.createDataFrame([("z", "zz", 3)], "k string, a string, b int"))
    load_batch(dataset, "dim", "day-5", batch(more))
    assert dataset.read("dim").count() == 6 and dataset.read("dim").where("NOT is_latest").count() == 3


def brute_as_of(facts, versions):
    found = []
    for key, at in facts:
        for k, f, t, a in versions:
            if k is not None and k == key and f <= at < (t or datetime(9999, 12, 31)):
                found.append((key, at, a))
    return sorted(found, key=repr)


@pytest.mark.parametrize("limit", [10, 50, 10_000])
def test_as_of_join_with_a_hot_key(spark, rows, limit):
    random.seed(limit)
    entries = [("hot" if random.random() < 0.4 else f"k{random.randrange(30)}", random.choice("pqr"), 1, random.randrange(2000)) for _ in range(600)]
    entries += [(None, "n", 1, 3), (None, "m", 1, 70)]
    history = materialize(changes_frame(spark, entries).dropDuplicates(["k", "ts"]))
    dimension = materialize(build(history, rows_per_group=limit))
    assert rows(dimension) == rows(build(history))
    facts = [(e[0], START + timedelta(hours=random.randrange(-10, 2100), minutes=random.choice([0, 0, 59]))) for e in entries]
    frame = spark.createDataFrame(facts, "k string, at timestamp_ntz")
    joined = scd2.join_as_of(frame, dimension, ["k"], "at", ["a"], rows_per_group=limit)
    versions = [(r.k, r.effective_from, r.effective_to, r.a) for r in dimension.collect()]
    assert rows(joined) == brute_as_of(facts, versions)
    left = scd2.join_as_of(frame, dimension, ["k"], "at", ["a"], how="left", rows_per_group=limit)
    assert left.count() == len(facts)
    coarse = scd2.join_as_of(frame, dimension, ["k"], "at", ["a"], how="left", coarse_times=True, rows_per_group=limit)
    assert rows(coarse) == rows(left)
    with pytest.raises(ValueError):
        scd2.join_as_of(frame, dimension, ["k"], "at", ["a"], how="right")


intervals = st.lists(
    st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 30), st.one_of(st.none(), st.integers(1, 15))), min_size=1, max_size=40
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(intervals, st.sampled_from([5, 1000]))
def test_overlaps_equal_brute_force(spark, made, limit):
    versions = [
        (k, n, START + timedelta(hours=f), None if length is None else START + timedelta(hours=f + length)) for n, (k, f, length) in enumerate(made)
    ]
    frame = spark.createDataFrame(versions, "k string, v int, effective_from timestamp_ntz, effective_to timestamp_ntz")
    end = lambda t: t or datetime(9999, 12, 31)
    pairs = sorted(
        (a[0], a[1], b[1]) for a in versions for b in versions if a[0] == b[0] and a[1] != b[1] and a[2] < end(b[3]) and end(a[3]) > b[2]
    )
    found = sorted(tuple(row) for row in check.overlap_pairs(frame, ["k"], "v", rows_per_group=limit).collect())
    assert found == pairs
    counted = {(row.k, row.v): row.overlapping for row in check.overlapping_versions(frame, ["k"], "v", rows_per_group=limit).collect()}
    expected = {}
    for k, one, _ in pairs:
        expected[k, one] = expected.get((k, one), 0) + 1
    assert counted == expected


def test_inverted_versions_are_reported_apart(spark):
    frame = spark.createDataFrame(
        [("x", 1, START, START - timedelta(seconds=1)), ("x", 2, START, None)],
        "k string, v int, effective_from timestamp_ntz, effective_to timestamp_ntz",
    )
    assert check.inverted_versions(frame).count() == 1
    assert check.overlapping_versions(frame, ["k"], "v").count() == 0


@pytest.mark.parametrize("limit", [7, 100, 10**6])
def test_windows_over_a_hot_key_equal_brute_force(spark, limit):
    random.seed(limit)
    data = [(random.choice(["hot", "hot", "a", "b", None]), random.randrange(50), n, random.choice([None, n])) for n in range(400)]
    frame = spark.createDataFrame(data, "k string, t int, n int, v int")
    df = ordered.slice_hot_keys(frame, ["k"], "t", limit)
    assert (ordered.SLICE in df.columns) is (limit < 10**6)
    keys, order = ["k"], ["t", "n"]
    df = ordered.with_previous(df, keys, order, {"before": F.col("n")})
    df = ordered.with_next(df, keys, order, {"after": F.col("n")})
    df = ordered.with_last_known(df, keys, order, "known", F.col("v"))
    df = ordered.with_running_max(df, keys, order, "highest", F.col("n"))
    df = ordered.with_running_counts(df, keys, order, {"place": F.lit(True), "filled": F.col("v").isNotNull()})
    found = {row.n: (row.before, row.after, row.known, row.highest, row.place, row.filled) for row in df.collect()}
    for key in {row[0] for row in data}:
        line = sorted((t, n, v) for k, t, n, v in data if k == key) if key is None else sorted(
            ((t, n, v) for k, t, n, v in data if k == key), key=lambda e: e[:2]
        )
        line.sort(key=lambda e: e[:2])
        known = highest = None
        filled = 0
        for place, (_, n, v) in enumerate(line):
            known = v if v is not None else known
            filled += v is not None
            before = line[place - 1][1] if place else None
            after = line[place + 1][1] if place + 1 < len(line) else None
            assert found[n] == (before, after, known, highest, place + 1, filled)
            highest = n if highest is None else max(highest, n)


def test_slices_of_a_hot_key_are_even(spark):
    frame = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    sliced = ordered.slice_hot_keys(frame, ["k"], "t", 1000)
    sizes = [row["count"] for row in sliced.where("_slice IS NOT NULL").groupBy("k", "_slice").count().collect()]
    assert sum(sizes) == 30_000 and len(sizes) >= 25 and max(sizes) < 2500


def test_a_hot_key_of_open_versions_is_sliced(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit(START.isoformat(" ")).cast("timestamp_ntz")).alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
    )
    found = check.overlapping_versions(frame, ["k"], "v", rows_per_group=100)
    assert found.select("k", "overlapping").distinct().collect() == [(-1, 999)] and found.count() == 1000


def late_entries(seed):
    """Changes of few keys at times of their own, and which of them come late."""
    draw = random.Random(seed)
    times = draw.sample(range(200), 60)
    return [(draw.choice(["x", "y", "z", None]), draw.choice(["p", "q"]), draw.choice([1, None]), time) for time in times]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", [5, 10_000])
def test_late_changes_come_out_as_if_in_time(spark, rows, seed, limit):
    entries = late_entries(seed)
    draw = random.Random(seed + 100)
    frame = materialize(changes_frame(spark, entries))
    chosen = draw.sample(range(60), 25)
    in_time, late = frame.where(~F.col("seq").isin(chosen)), frame.where(F.col("seq").isin(chosen))
    names = (["k"], ["a", "b"], "ts", ["seq"])
    versions = materialize(scd2.build_versions(in_time, *names))
    repeats = scd2_late.repeated_changes(in_time, *names)
    changes = late.select("k", "a", "b", F.col("ts").alias("effective_from"))
    found = scd2_late.apply_late(versions, changes, ["k"], ["a", "b"], repeats, rows_per_group=limit)
    assert rows(found) == rows(scd2.build_versions(frame, *names))


def brute_late(versions, late):
    """States by second of a short time line, cut by each late change in the order of their times."""
    line = {}
    for a, start, end in versions:
        for second in range(start, 60 if end is None else end):
            line[second] = a
    starts = sorted({start for _, start, _ in versions} | {end for _, _, end in versions if end is not None})
    for a, at in sorted(late, key=lambda one: one[1]):
        later = [one for one in starts + [time for _, time in late] if one > at]
        for second in range(at, min(later, default=60)):
            line[second] = a
    found, before = [], None
    for second in range(60):
        now = line.get(second)
        if now != before and now is not None:
            found.append([now, second, None])
        elif now != before:
            found[-1][2] = second
        if now is not None and found and now != before and len(found) > 1 and found[-2][2] is None:
            found[-2][2] = second
        before = now
    return [tuple(one) for one in found]


@pytest.mark.parametrize("seed", range(6))
def test_late_changes_keep_the_ends_of_deleted_keys(spark, seed):
    draw = random.Random(seed)
    cuts = sorted(draw.sample(range(1, 55), 6))
    versions = [("p", cuts[0], cuts[1]), ("q", cuts[1], cuts[2]), ("p", cuts[4], draw.choice([cuts[5], None]))]
    late = [(draw.choice("pqr"), at) for at in draw.sample(range(60), 4)]

    def moment(second):
        return None if second is None else START + timedelta(seconds=second)

    rows_ = [("k", a, moment(s), moment(e), e is None, 1, "INSERT", "r", "m", n) for n, (a, s, e) in enumerate(versions)]
    schema = (
        "k string, a string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_latest boolean, batch_key int, "
        "change_type string, change_reason string, modified_by string, version_key int"
    )
    frame = spark.createDataFrame(rows_, schema)
    changes = spark.createDataFrame([("k", a, moment(at)) for a, at in late], "k string, a string, effective_from timestamp_ntz")
    made = scd2_late.apply_late(frame, changes, ["k"], ["a"], close_offset=0).orderBy("effective_from").collect()

    def second(value):
        return None if value is None else int((value - START).total_seconds())

    assert [(row.a, second(row.effective_from), second(row.effective_to)) for row in made] == brute_late(versions, late)
    starts = {s: n for n, (a, s, _) in enumerate(versions) if s not in {at for _, at in late}}
    assert all(row.version_key == starts.get(second(row.effective_from)) for row in made)


def test_a_late_deletion_ends_a_version(spark):
    versions = build(changes_frame(spark, [("x", "p", 1, 0), ("x", "q", 1, 48)]))
    late = spark.createDataFrame([("x", None, None, START + timedelta(hours=24), True)], "k string, a string, b int, effective_from timestamp_ntz, _gone boolean")
    made = scd2_late.apply_late(versions, late, ["k"], ["a", "b"]).orderBy("effective_from").collect()
    assert [(row.a, row.effective_to, row.change_type) for row in made] == [
        ("p", START + timedelta(hours=24) - timedelta(seconds=1), "INSERT"), ("q", None, "INSERT")
    ]


def late_load(spark):
    """Batches by day, some rows of which come days later."""
    entries = [(k, random.Random(f"{k}{day}").choice(["p", "q", "r"]), 1, day * 24) for k in ("x", "y", "z") for day in range(8)]
    frame = materialize(changes_frame(spark, entries))
    dataset = Dataset(spark)
    names = (["k"], ["a", "b"], "ts", ["seq"])
    first = frame.where("ts < timestamp_ntz'2024-01-02'")
    start_dimension(dataset, "dim", scd2.build_versions(first, *names))
    order = [1, 4, 2, 6, 3, 5, 7]
    for day in order:
        moment = START + timedelta(days=day)
        changes = frame.where(F.col("ts") == F.lit(str(moment)).cast("timestamp_ntz"))
        load_batch(dataset, "dim", f"day-{day}", scd2.Batch(current_table(dataset, "dim"), changes, ["k"], ["a", "b"], moment))
        if day in (2, 5):
            apply_late_changes(dataset, "dim", f"late'{day}", ["k"], ["a", "b"])
    apply_late_changes(dataset, "dim", "late-end", ["k"], ["a", "b"])
    return dataset, scd2.build_versions(frame, *names)


def test_batches_out_of_order_equal_a_build(spark, rows):
    dataset, expected = late_load(spark)
    assert rows(dataset.read("dim").select(*CORE)) == rows(expected.select(*CORE))
    assert dataset.read("dim_late").isEmpty() and not dataset.read("dim_dropped").isEmpty()
    compact_closed(dataset, "dim", ["k"])
    assert rows(dataset.read("dim").select(*CORE)) == rows(expected.select(*CORE))
    assert dataset.read("dim_dropped").isEmpty()
    assert dataset.read("dim_closed").count() + dataset.read("dim_current").count() == dataset.read("dim").count()


@pytest.mark.parametrize("step", ["append", "replace", "_publish"])
@pytest.mark.parametrize("after", [0, 1, 2])
def test_late_changes_survive_a_crash(spark, rows, monkeypatch, step, after):
    names = (["k"], ["a", "b"], "ts", ["seq"])
    frame = materialize(changes_frame(spark, [("x", "p", 1, 0), ("x", "q", 1, 48), ("y", "p", 1, 0), ("x", "p", 1, 72)]))
    dataset = Dataset(spark)
    start_dimension(dataset, "dim", scd2.build_versions(frame, *names))
    late = changes_frame(spark, [("x", "r", 1, 24), ("x", "s", 1, 96)])
    keep_late(dataset, "dim", "d", late, ["k"], ["a", "b"], "ts")
    before = rows(dataset.read("dim"))
    owner = scd2_load if step == "_publish" else Dataset
    plain, calls = getattr(owner, step), []

    def failing(*args, **options):
        calls.append(1)
        if len(calls) > after:
            raise RuntimeError("crash")
        return plain(*args, **options)

    with monkeypatch.context() as broken:
        broken.setattr(owner, step, failing)
        try:
            apply_late_changes(dataset, "dim", "fix", ["k"], ["a", "b"])
        except RuntimeError:
            pass
    expected = rows(scd2.build_versions(frame.unionByName(late), *names))
    assert rows(dataset.read("dim")) in (before, expected) or step != "append"
    apply_late_changes(dataset, "dim", "fix", ["k"], ["a", "b"])
    assert rows(dataset.read("dim")) == expected
    assert dataset.read("dim_late").isEmpty()


@pytest.mark.parametrize("limit", [1, 3, 40, 10_000])
def test_ties_and_equal_rows_are_parted(spark, rows, limit):
    draw = random.Random(limit)
    data = [("hot" if draw.random() < 0.7 else draw.choice("ab"), 1, draw.randrange(5)) for _ in range(300)]
    frame = spark.createDataFrame(data, "k string, t int, n int").repartition(4)
    df = ordered.slice_hot_keys(frame, ["k"], ["t", "n"], limit)
    if limit < 100:
        sizes = [row["count"] for row in df.where("_slice IS NOT NULL").groupBy("k", "_slice").count().collect()]
        assert max(sizes) <= 3 * limit + 2
    df = ordered.with_running_counts(df, ["k"], ["t", "n"], {"place": F.lit(True)})
    df = ordered.with_previous(df, ["k"], ["t", "n"], {"before": F.col("n")})
    found = df.collect()
    for key in ("a", "b", "hot"):
        places = sorted((row.place, row.n, -1 if row.before is None else row.before) for row in found if row.k == key)
        expected = sorted(n for k, _, n in data if k == key)
        assert [place for place, _, _ in places] == list(range(1, len(expected) + 1))
        assert [n for _, n, _ in places] == expected and [b for _, _, b in places] == [-1, *expected[:-1]]


def test_upstream_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)
    base = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = base.mapInArrow(count, "k bigint, t bigint")
    sliced = ordered.slice_hot_keys(counted, ["k"], ["t"], 20)
    ordered.with_previous(sliced, ["k"], ["t"], {"before": F.col("t")}).count()
    assert seen.value == 500


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [0, 10_000])
def test_lookup_equals_the_time_line(spark, rows, how, most):
    draw = random.Random(3)
    entries = [(draw.choice(["x", "y", "z", None]), draw.choice("pqr"), 1, draw.randrange(300)) for _ in range(80)]
    history = materialize(changes_frame(spark, entries).dropDuplicates(["k", "ts"]))
    dimension = build(history).where("NOT (k = 'x' AND a = 'p')")  # with gaps
    facts = [(draw.choice(["x", "y", "none", None]), START + timedelta(hours=draw.randrange(-9, 320), seconds=draw.choice([0, 3599]))) for _ in range(200)]
    frame = spark.createDataFrame(facts, "k string, at timestamp_ntz")
    found = scd2.join_as_of_lookup(frame, dimension, ["k"], "at", ["a"], how, most_versions=most)
    assert rows(found) == rows(scd2.join_as_of(frame, dimension, ["k"], "at", ["a"], how))
    if most:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert scd2.join_as_of_lookup(frame, dimension.limit(0), ["k"], "at", ["a"], "left").count() == 200


@pytest.mark.parametrize("block", [1, 2, 7, 1024])
def test_partners_listed_by_blocks(spark, rows, block):
    draw = random.Random(block)
    spans = [(draw.choice("ab"), n, draw.randrange(40), draw.choice([None, 1, 5, 60])) for n in range(50)]
    frame = spark.createDataFrame(
        [(k, n, START + timedelta(hours=s), None if w is None else START + timedelta(hours=s + w)) for k, n, s, w in spans],
        "k string, v int, effective_from timestamp_ntz, effective_to timestamp_ntz",
    )
    found = check.overlap_pairs(frame, ["k"], "v", block=block)
    expected = [
        (k, n, m) for k, n, s, w in spans for l, m, t, x in spans
        if k == l and n != m and s < (10**6 if x is None else t + x) and t < (10**6 if w is None else s + w)
    ]
    assert rows(found) == sorted(expected, key=repr)
