"""Verification, coercion audits, profiles, generators and streams."""

import random
from collections import Counter
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import coerce, generate, profile, verify
from tidemark.operators.load import Dataset
from tidemark.session import fresh_path
from tidemark.streaming.incremental import file_stream, stream_append, stream_merge


def test_row_count_tolerance(spark):
    ten, seven = spark.range(10), spark.range(7)
    result = lambda tolerance: verify.row_count("t", ten, seven, tolerance).first()
    assert (result(0).passed, result(0).difference) == (False, 3)
    assert result(3).passed and result(5).passed
    with pytest.raises(ValueError, match="cannot be negative"):
        verify.row_count("t", ten, seven, -1)


def test_primary_key_counts_nulls_as_values(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (1, 2)], "a int, b int")
    found = verify.primary_key("t", df, ["a", "b"]).first()
    assert (found.passed, found.source_value, found.dest_value, found.difference) == (False, 4, 3, 1)
    assert verify.duplicate_keys(df, ["a", "b"]).collect() == [(1, None, 2)]
    empty = verify.primary_key("t", df.limit(0), ["a", "b"]).first()
    assert (empty.passed, empty.source_value, empty.dest_value) == (True, 0, 0)


@pytest.mark.parametrize(
    ("text", "passed", "violations"),
    [
        ("SELECT COUNT(*) FROM {t} WHERE id < 0", True, 0),
        ("SELECT COUNT(*) FROM {t} WHERE id < 3", False, 3),
        ("SELECT id FROM {t} GROUP BY id HAVING COUNT(*) > 1", True, 0),
        ("SELECT id FROM {t} WHERE id > 6", False, 3),
        ("SELECT id, id FROM {t} WHERE id = 0", False, 1),
        ("SELECT MAX(id) FROM {t} WHERE id < 0", False, None),
    ],
)
def test_custom_checks(spark, text, passed, violations):
    found = verify.custom_check(spark, "c", text, t=spark.range(10)).first()
    assert (found.passed or False, found.dest_value) == (passed, violations)


def test_a_check_that_breaks_fails_with_its_message(spark):
    missing = verify.custom_check(spark, "c", "SELECT COUNT(*) FROM no_such_table").first()
    assert missing.passed is False and "no_such_table" in missing.error
    raised = verify.custom_check(spark, "c", "SELECT CAST(concat('boom', id) AS INT) FROM {t}", t=spark.range(1)).first()
    assert raised.passed is False and "boom" in raised.error


def test_summary(spark):
    checks = verify.row_count("a", spark.range(3), spark.range(3)).unionByName(verify.row_count("b", spark.range(3), spark.range(1)))
    total = verify.summary(checks).first()
    assert (total.total_checks, total.passed_checks, total.success_rate, total.overall_passed, total.tables_with_issues) == (2, 1, 50.0, False, "b")
    assert verify.summary(checks, ["a"]).first().overall_passed is True
    none = verify.summary(checks.limit(0)).first()
    assert (none.total_checks, none.success_rate, none.overall_passed) == (0, 0.0, True)


def test_compare_values_with_hot_duplicates(spark, rows):
    """A key held many times on both sides must not multiply."""
    copies = spark.range(20_000).select(F.lit(1).alias("k"), F.lit("v").alias("v"))
    source = copies.unionByName(spark.createDataFrame([(2, "a"), (3, None), (4, "x")], "k int, v string"))
    destination = copies.unionByName(spark.createDataFrame([(2, "b"), (3, None), (5, "y")], "k int, v string"))
    found = rows(verify.compare_values(source, destination, ["k"]))
    assert found == [(1, "duplicate", 20000, 20000), (2, "changed", 1, 1), (3, "same", 1, 1), (4, "missing", 1, 0), (5, "extra", 0, 1)]
    assert rows(verify.compare_rows(source, destination)) == [(2, "a", 1, 0), (2, "b", 0, 1), (4, "x", 1, 0), (5, "y", 0, 1)]


def test_sample_by_text_keys_draws_the_same_keys(spark):
    names = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("k"), F.col("id").alias("v"))
    found = verify.compare_sample(names, names.where("v <> 17"), ["k"], ["v"], percent=20).first()
    assert 800 < found.equal_count < 1200 and found.different_count == 0 and found.missing_count <= 1 and found.extra_count == 0


def test_align_schema(spark):
    target = spark.createDataFrame([], "id bigint, amount decimal(19,4), note string").schema
    batch = spark.createDataFrame([(Decimal("1.5000"), 7, "x")], "Amount decimal(10,4), ID int, extra string")
    fitted, extra = coerce.align_schema(batch, target)
    assert extra == ["extra"] and fitted.schema == target and fitted.collect() == [(7, Decimal("1.5000"), None)]
    assert coerce.align_schema(batch, target, evolve=True)[0].columns == ["id", "amount", "note", "extra"]
    narrow = spark.createDataFrame([], "id bigint, amount decimal(10,4), note string").schema
    wide = spark.createDataFrame([(1, Decimal("1.5"))], "id bigint, amount decimal(19,4)")
    with pytest.raises(ValueError, match=r"amount: decimal\(19,4\) does not fit decimal\(10,4\)"):
        coerce.align_schema(wide, narrow)
    target["note"].nullable = False
    with pytest.raises(ValueError, match="note is missing"):
        coerce.align_schema(batch, target)


def test_money_rounds_half_up_and_overflow_fails(spark):
    df = spark.createDataFrame([(0.00005,), (-1.23455,)], "v double")
    assert coerce.coerce(df, {"v": "money"}).collect() == [(Decimal("0.0001"),), (Decimal("-1.2346"),)]
    big = spark.createDataFrame([(1e16,)], "v double")
    with pytest.raises(PySparkException):
        coerce.coerce(big, {"v": "money"}).collect()
    audit = coerce.audit_casts(big.unionByName(df), {"v": "decimal(19,4)"}).first()
    assert (audit.row_count, audit.lost_count, audit.changed_count) == (3, 1, 2)


def test_precision_audit_of_zero_and_small_values(spark):
    df = spark.createDataFrame([(Decimal("0"),), (Decimal("0.000000000000000001"),), (Decimal("-12.5"),)], "v decimal(38,18)")
    found = coerce.audit_precision(df, ["v"]).first()
    assert (found.integer_digits, found.fraction_digits, found.beyond_expected, found.as_expected) == (2, 18, 1, False)
    with pytest.raises(ValueError, match="not a decimal"):
        coerce.audit_precision(spark.range(1), ["id"])


def test_mapping_of_missing_columns_is_an_error(spark):
    with pytest.raises(ValueError, match="do not exist"):
        coerce.map_columns(spark.range(1), {"nope": "x"})


@pytest.mark.parametrize("partitions", [1, 7])
def test_surrogate_keys_have_no_gaps(spark, partitions):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id")).repartition(partitions)
    keyed = coerce.assign_surrogate_key(df, "key", ["id"], 100)
    assert [row[0] for row in keyed.select(F.col("key") - F.col("id")).distinct().collect()] == [101]
    copies = coerce.assign_surrogate_key(spark.range(9000).select(F.lit(1).alias("same")).repartition(partitions), "key", ["same"])
    assert copies.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first()[:] == (1, 9000, 9000)
    assert coerce.assign_surrogate_key(df.limit(0), "key", ["id"]).count() == 0


def test_profile_of_declared_types(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "n int, s string")
    found = {row.column_name: row for row in profile.column_profile(df, "t", {"s": "varchar(20)"}).collect()}
    assert (found["n"].data_type, found["n"].distinct_count, found["s"].null_count, found["s"].max_length) == ("int", 1, 1, 20)
    near = profile.column_profile(spark.range(1000), "t", approximate=True).first()
    assert abs(near.distinct_count - 1000) < 100
    assert profile.data_state(df.limit(0), "n").first()[:] == (0, 0, 0, 0)
    none = profile.load_outcomes(df.limit(0), [], F.lit(False), F.lit(1).cast("decimal(19,4)")).first()
    assert (none.loads, none.mean_duration, none.success_rate) == (0, 0.0, 0.0)


def test_batches_are_complete_and_repeatable(spark, rows):
    ids = spark.range(3000)
    one = generate.generate_batch(ids, "id", 1, "2024-01-01")
    assert len(one.columns) == 118 and one.count() == 3000
    again = generate.generate_batch(ids.repartition(13), "id", 1, "2024-01-01")
    assert rows(one) == rows(again)
    shares = one.agg(F.avg(F.col("IsActive").cast("int")), F.avg(F.col("IsInternalAccount").cast("int")), F.avg(F.col("ParentClientID").isNull().cast("int"))).first()
    assert 0.8 < shares[0] < 0.9 and shares[1] < 0.03 and 0.25 < shares[2] < 0.35
    two = generate.generate_batch(ids, "id", 2, "2024-01-02")
    growth = two.agg(F.sum("Revenue")).first()[0] / one.agg(F.sum("Revenue")).first()[0]
    assert abs(float(growth) - 1.10 / 1.05) < 1e-4
    assert generate.generate_batch(ids, "id", 4, "2024-01-04").first().AccountNumber.startswith("NEXT-")


def test_business_keys_stay_apart(spark):
    keys = spark.createDataFrame([(7,), (9999,), (12345,), (22345,)], "id int").select(generate.business_key(F.col("id")))
    assert [row[0] for row in keys.collect()] == ["CLIENT_0007", "CLIENT_9999", "CLIENT_12345", "CLIENT_22345"]


def test_changes_take_a_share(spark):
    clients = generate.generate_entities(spark.range(8000), "id", "2024-01-01").withColumn("id", F.split_part("ClientBusinessKey", F.lit("_"), F.lit(2)).cast("bigint"))
    changed = generate.generate_changes(clients, "id", day=2)
    assert 1800 < changed.count() < 2200
    assert 0.15 < changed.agg(F.avg((F.col("ContactName") == "Jane Smith").cast("int"))).first()[0] < 0.25


def test_append_stream_takes_new_files_only(spark):
    folder, checkpoint, dataset = fresh_path(spark, "in"), fresh_path(spark, "stream"), Dataset(spark)
    schema = spark.range(1).schema
    for upto in (10, 10, 25):
        if upto == 25:
            spark.range(10, 25).write.mode("append").parquet(folder)
        elif not dataset.exists("t"):
            spark.range(10).write.parquet(folder)
        stream_append(file_stream(spark, folder, schema), dataset, "t", checkpoint)
        assert dataset.read("t").count() == upto
    assert dataset.read("t").select("_load_id").distinct().count() == 2


def test_merge_stream_keeps_the_latest_whatever_comes_late(spark, rows):
    folder, checkpoint, dataset = fresh_path(spark, "in"), fresh_path(spark, "stream"), Dataset(spark)
    schema = "k int, at timestamp_ntz, v string"

    def arrive(*entries):
        made = spark.createDataFrame([(k, at, v) for k, at, v in entries], "k int, at string, v string")
        made.withColumn("at", F.col("at").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
        stream_merge(stream, dataset, "t", ["k"], ["at"], checkpoint)

    arrive((1, "2024-01-02", "new"), (2, "2024-01-01", "a"))
    arrive((1, "2024-01-01", "late"), (2, "2024-01-03", "b"), (3, "2024-01-01", "c"))
    assert rows(dataset.read("t").select("k", "v")) == [(1, "new"), (2, "b"), (3, "c")]


def sides(spark, seed, text_key):
    draw = random.Random(seed)
    left = [(n if draw.random() < 0.98 else None, draw.choice([None, "a", "b"]), draw.choice([None, 1.5])) for n in range(400)]
    right = [row for row in left if draw.random() < 0.98] + [(900, "x", None), (3, "again", 1.0)]
    right = [(k, None, 1.5) if v == "a" and draw.random() < 0.05 else (k, v, w) for k, v, w in right]
    kind = "string" if text_key else "bigint"
    frames = [spark.createDataFrame([(k if k is None or not text_key else f"k{k}", v, w) for k, v, w in side], f"k {kind}, v string, w double") for side in (left, right)]
    return [frame.repartition(3) for frame in frames]


@pytest.mark.parametrize("text_key", [False, True])
@pytest.mark.parametrize("ranges", [1, 7, 1024])
def test_checksums_find_what_values_find(spark, rows, text_key, ranges):
    source, destination = sides(spark, ranges, text_key)
    found = verify.compare_by_checksum(source, destination, ["k"], ranges, ranges)
    held = [Counter((row.k, row.v, row.w) for row in side.collect()) for side in (source, destination)]
    wrong = {row[0] for row in (held[0] - held[1]) + (held[1] - held[0])}
    expected = verify.compare_values(source, destination, ["k"]).collect()
    assert rows(found) == sorted([tuple(row) for row in expected if row.k in wrong], key=repr)
    assert verify.compare_by_checksum(source, source.repartition(2), ["k"], ranges).isEmpty()
    assert verify.compare_by_checksum(source.limit(0), destination.limit(0), ["k"]).isEmpty()
    assert verify.compare_by_checksum(source, destination.limit(0), ["k"]).count() == source.select("k").distinct().count()


def test_checksums_tell_nulls_and_swapped_values_apart(spark):
    one = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS STRING), 'a'), (2, 'a', 'b') t(k, v, w)")
    other = spark.sql("SELECT * FROM VALUES (1, 'a', CAST(NULL AS STRING)), (2, 'b', 'a') t(k, v, w)")
    assert verify.compare_by_checksum(one, other, ["k"]).count() == 2


def test_equal_tables_shuffle_only_checksums(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    found = verify.compare_by_checksum(orders, orders, ["o_orderkey"])
    sums = verify._differing(orders, orders, {"part": F.col("o_orderkey") % 5})
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert found.isEmpty() and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_profile_counts_exactly_without_copies_of_rows(spark):
    frame = spark.sql(
        "SELECT id, id % 3 AS few, IF(id % 4 = 0, NULL, CAST(id AS STRING)) AS text, CAST(NULL AS INT) AS nothing, "
        "IF(id % 2 = 0, 0.0D, -0.0D) AS zero, IF(id < 5, CAST('NaN' AS DOUBLE), id) AS real, "
        "DATE'2024-01-01' + CAST(id % 7 AS INT) AS day, CAST(id AS DECIMAL(20,2)) AS money FROM range(100)"
    )
    made = profile.column_profile(frame, "t")
    found = {row.column_name: (row.row_count, row.null_count, row.distinct_count) for row in made.collect()}
    expected = frame.agg(*[F.count_distinct(name).alias(name) for name in frame.columns]).first()
    nulls = {"text": 25, "nothing": 100}
    assert found == {name: (100, nulls.get(name, 0), expected[name]) for name in frame.columns}
    assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    near = {row.column_name: (row.row_count, row.null_count) for row in profile.column_profile(frame, "t", approximate=True).collect()}
    assert near == {name: values[:2] for name, values in found.items()}
    empty = profile.column_profile(frame.limit(0), "t").collect()
    assert [(row.row_count, row.null_count, row.distinct_count) for row in empty] == [(0, 0, 0)] * len(frame.columns)
    assert [row.position for row in sorted(empty, key=lambda row: row.position)] == list(range(1, 9))


@pytest.mark.parametrize("target", ["decimal(10,2)", "double", "int"])
def test_changed_digits_of_texts(spark, target):
    texts = ["1", "+1", "-0", "0.00", " 12.50 ", "12.505", "007", ".5", "5.", "-.50", "1e2", "1.5e1", "99.999", "x", "", None, "-12.5", "0.1"]
    found = {
        text: coerce.audit_casts(spark.createDataFrame([(text,)], "v string"), {"v": target}).first().changed_count
        for text in texts
    }
    whole, fraction = {"decimal(10,2)": (False, 2), "double": (False, 99), "int": (True, 0)}[target]

    def changed(text):
        try:
            number = Decimal(text.strip())
        except (InvalidOperation, AttributeError):
            return 0
        lost = number != number.quantize(Decimal(1).scaleb(-min(fraction, 9)))
        return int(lost)

    fitted = {
        text: spark.createDataFrame([(text,)], "v string").select(coerce.try_fit(F.col("v"), T.StringType(), target).alias("f")).first().f
        for text in texts
    }
    assert found == {text: changed(text) if fitted[text] is not None else 0 for text in texts}


def test_wide_rows_are_made_by_many_tasks_from_few_files(spark):
    ids = spark.range(0, 1000, 1, 1).withColumn("other", F.lit("x"))
    made = generate.generate_batch(ids, "id", 1, "2024-01-01").select("RecordID", F.spark_partition_id().alias("task"))
    sizes = [row["count"] for row in made.groupBy("task").count().collect()]
    assert len(sizes) == 2 * spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)
    assert made.agg(F.sum("RecordID")).first()[0] == 999 * 1000 // 2
