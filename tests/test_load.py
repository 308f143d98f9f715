"""Dispositions, retries, merges and runs over several tables."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.incremental import run_load, since
from tidemark.operators.load import Dataset, LoadError, load_selected, merge_into, merge_rows
from tidemark.operators.keys import latest_per_key
from tidemark.spec import Incremental, TableSpec

USERS = [
    (1, "TestUser1", datetime(2023, 1, 1, 10), 100),
    (2, "TestUser2", datetime(2023, 1, 2, 11), 200),
    (3, "TestUser3", datetime(2023, 1, 3, 12), 300),
]
USER_SCHEMA = "Id int, DisplayName string, CreationDate timestamp_ntz, Reputation int"


@pytest.fixture
def users(spark):
    return spark.createDataFrame(USERS, USER_SCHEMA)


def test_replace_then_append_doubles(spark, users):
    dataset = Dataset(spark)
    dataset.replace("users", users)
    assert dataset.read("users").count() == 3
    dataset.append("users", users)
    assert dataset.read("users").count() == 6
    dataset.replace("users", users)
    assert dataset.read("users").count() == 3


def test_replace_from_itself_and_readers_of_the_old_version(spark, users, rows):
    dataset = Dataset(spark)
    dataset.replace("users", users)
    planned = dataset.read("users")
    dataset.replace("users", dataset.read("users").where("Id > 1"))
    assert dataset.read("users").count() == 2
    assert planned.count() == 3
    for _ in range(3):
        dataset.replace("users", dataset.read("users").where("Id > 1"))
    assert len(dataset._versions("users")) == 2


def test_a_failed_replace_keeps_the_old_rows(spark, users):
    dataset = Dataset(spark)
    dataset.replace("users", users)
    broken = users.withColumn("Reputation", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(PySparkException):
        dataset.replace("users", broken)
    assert dataset.read("users").count() == 3
    dataset.replace("users", users.limit(1))
    assert dataset.read("users").count() == 1


def test_snake_case_load_keeps_values(spark, users, rows):
    dataset = Dataset(spark)
    spec = TableSpec("dbo.Users", naming="snake_case")
    run_load(dataset, spec, "l1", "2023-02-01", **{"dbo.Users": users})
    loaded = dataset.read("users")
    assert loaded.columns == ["id", "display_name", "creation_date", "reputation", "_load_id", "_loaded_at"]
    assert rows(loaded.select("id", "display_name", "reputation")) == [(1, "TestUser1", 100), (2, "TestUser2", 200), (3, "TestUser3", 300)]


def test_filtered_load(spark, users):
    dataset = Dataset(spark)
    run_load(dataset, TableSpec("users", where="Id <= 2"), "l1", "2023-02-01", users=users)
    assert dataset.read("users").count() == 2


def test_append_under_a_load_id_is_not_doubled_by_a_retry(spark, users):
    dataset = Dataset(spark)
    dataset.append("users", users.where("Id = 1"), load_id="a")
    for _ in range(2):
        dataset.append("users", users.where("Id > 1"), load_id="b")
    assert dataset.read("users").count() == 3
    dataset.append("users", users.limit(0), load_id="b")
    assert dataset.read("users").count() == 3


def test_append_with_load_id_to_a_table_without_loads(spark, users):
    """The table is not partitioned by load, so nothing of it may be overwritten."""
    dataset = Dataset(spark)
    dataset.replace("users", users.withColumn("_load_id", F.lit("old")))
    dataset.append("users", users, load_id="new")
    assert dataset.read("users").count() == 6


def test_merge_replaces_keeps_and_adds(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], "k int, v string, w int")
    updates = spark.createDataFrame([(2, "old", 2), (2, None, 3), (4, "d", 2)], "k int, v string, w int")
    merged = merge_rows(target, updates, ["k"], ["w"])
    expected = [(1, "a", 1), (2, None, 3), (3, None, 1), (4, "d", 2)]
    assert rows(merged) == sorted(expected, key=repr)
    assert rows(merge_rows(merged, updates, ["k"], ["w"])) == sorted(expected, key=repr)


def test_merge_refuses_null_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    updates = spark.createDataFrame([(None, "b")], "k int, v string")
    with pytest.raises(PySparkException, match="key column k holds NULL"):
        merge_rows(target, updates, ["k"]).collect()


def test_merge_with_a_composite_key(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, l int, v string")
    updates = spark.createDataFrame([(1, 2, "c"), (2, 1, "d")], "k int, l int, v string")
    assert rows(merge_rows(target, updates, ["k", "l"])) == [(1, 1, "a"), (1, 2, "c"), (2, 1, "d")]


def test_partitioned_merge_leaves_other_partitions_alone(spark, rows):
    dataset = Dataset(spark)
    table = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "day int, k int, v string")
    dataset.merge("t", table, ["day", "k"], partition_by=["day"])
    files = set(dataset.read("t").where("day = 1").inputFiles())
    updates = spark.createDataFrame([(2, 1, "x"), (3, 9, "y")], "day int, k int, v string")
    for _ in range(2):
        dataset.merge("t", updates, ["day", "k"], partition_by=["day"])
    assert rows(dataset.read("t").select("day", "k", "v")) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "x"), (3, 9, "y")]
    assert set(dataset.read("t").where("day = 1").inputFiles()) == files
    with pytest.raises(ValueError, match="must be key columns"):
        dataset.merge("t", updates, ["k"], partition_by=["day"])
    dataset.replace("u", table)
    with pytest.raises(ValueError, match="is partitioned by"):
        dataset.merge("u", updates, ["day", "k"], partition_by=["day"])


def test_merge_into_needs_a_catalog_that_can(spark, users):
    dataset = Dataset(spark)
    dataset.replace("users", users)
    with pytest.raises(PySparkException):
        merge_into(f"{dataset.name}.users__v1", users, ["Id"])


def test_latest_per_key_with_a_third_of_all_rows_in_one_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"), F.lit(None).cast("string").alias("v")
    )
    latest = latest_per_key(df, ["k"], ["w"])
    assert latest.count() == 20_001
    assert latest.where("k = -1").first()["w"] == 29_997


def test_incremental_in_batches_equals_a_full_load(spark, rows):
    source = spark.range(1000).select(
        F.col("id"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, cast(id div 3 as int))").alias("at")
    )
    spec = TableSpec("t", disposition="append", primary_key=("id",), incremental=Incremental("at", "2024-01-01T00:00:00"))
    dataset = Dataset(spark)
    for number, upto in enumerate([100, 101, 500, 999, 999, 1000]):
        run_load(dataset, spec, f"run-{number}", "2024-02-01", t=source.where(F.col("id") < upto))
    assert rows(dataset.read("t").select("id")) == rows(source.select("id"))


def test_a_retried_run_takes_up_the_same_load(spark):
    dataset = Dataset(spark)
    spec = TableSpec("t", disposition="append", incremental=Incremental("id", -1, "sequence"))
    run_load(dataset, spec, "run-1", "2024-01-01", t=spark.range(10))
    run_load(dataset, spec, "run-2", "2024-01-02", t=spark.range(20))
    # The source has grown since the first attempt.
    assert run_load(dataset, spec, "run-2", "2024-01-02", t=spark.range(25)) == 24
    assert dataset.read("t").count() == 25
    assert dataset.read("t").where("_load_id = 'run-2'").count() == 15
    with pytest.raises(ValueError, match="earlier load"):
        run_load(dataset, spec, "run-1", "2024-01-03", t=spark.range(30))


def test_bounds_are_inclusive_for_times_only(spark):
    numbers = spark.createDataFrame([(None,), (1,), (2,), (3,)], "n int")
    assert since(numbers, Incremental("n", 2, "sequence")).count() == 1
    assert since(numbers, Incremental("n", 0, "sequence")).count() == 3
    times = numbers.select(F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, n)").alias("t"))
    assert since(times, Incremental("t", "2024-01-03T00:00:00")).count() == 2
    assert since(times, Incremental("t", "2024-01-03T00:00:00"), lookback="1 day").count() == 3
    words = spark.createDataFrame([("a",), ("b",)], "w string")
    assert since(words, Incremental("w", "a", "custom")).count() == 1


def test_bound_reaches_the_scan(spark, capsys):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    since(events, Incremental("ts", "2024-01-15T00:00:00Z")).explain()
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in capsys.readouterr().out


def test_selection_of_tables(spark, users):
    dataset = Dataset(spark)

    def load_one(spec):
        if spec.target == "broken":
            raise RuntimeError("no such source")
        dataset.replace(spec.target, users)
        return dataset.read(spec.target).count()

    specs = {
        "Users": TableSpec("dbo.Users"),
        "Posts": TableSpec("dbo.Posts", enabled=False),
        "Broken": TableSpec("dbo.Broken"),
        "Comments": TableSpec("dbo.Comments"),
    }
    only = load_selected(spark, specs, load_one, ["Users"])
    assert [tuple(row) for row in only.select("table_name", "row_count").collect()] == [("users", 3)]
    for unknown in (["Votes"], ["Posts"]):
        with pytest.raises(ValueError, match="not configured or not enabled"):
            load_selected(spark, specs, load_one, unknown)
    with pytest.raises(ValueError, match="no tables"):
        load_selected(spark, {}, load_one)
    with pytest.raises(LoadError, match="broken") as failure:
        load_selected(spark, specs, load_one)
    outcome = {row.table_name: (row.status, row.row_count, row.error) for row in failure.value.results.collect()}
    assert outcome["users"] == ("success", 3, None) and outcome["comments"] == ("success", 3, None)
    assert outcome["broken"] == ("failed", None, "no such source")


def test_appended_rows_are_fitted_to_the_table(spark, rows):
    dataset = Dataset(spark)
    dataset.append("t", spark.sql("SELECT 1L AS id, CAST(1.5 AS DECIMAL(19,4)) AS amount"), load_id="a")
    dataset.append("t", spark.sql("SELECT CAST(2.5 AS DECIMAL(10,4)) AS Amount, 2 AS ID"), load_id="b")
    with pytest.raises(ValueError, match="does not fit"):
        dataset.append("t", spark.sql("SELECT 3L AS id, CAST(1.5 AS DECIMAL(38,18)) AS amount"), load_id="c")
    more = spark.sql("SELECT 4L AS id, 'x' AS note")
    with pytest.raises(ValueError, match="'note'"):
        dataset.append("t", more, load_id="d")
    dataset.append("t", more, load_id="d", evolve=True)
    found = dataset.read("t").select("id", F.col("amount").cast("string"), "note", "_load_id")
    assert rows(found) == [(1, "1.5000", None, "a"), (2, "2.5000", None, "b"), (4, None, "x", "d")]
    with pytest.raises(ValueError, match="'note2'"):
        dataset.merge("t", spark.sql("SELECT 4L AS id, 'x' AS note2"), ["id"])


def test_named_datasets_lie_where_told(spark, tmp_path):
    dataset = Dataset(spark, "reporting_test", str(tmp_path / "reporting"))
    dataset.replace("t", spark.range(3))
    assert (tmp_path / "reporting" / "t__v1").exists()
    assert Dataset(spark, "reporting_test").read("t").count() == 3
    with pytest.raises(ValueError, match="not a database name"):
        Dataset(spark, "a; drop")
