"""Whole runs over small tables: dispositions, selection, failures, verification, audit."""

from datetime import datetime

import pytest

from tidemark.operators import verify
from tidemark.operators.load import Dataset, LoadError
from tidemark.operators.run import audit_report, run_all, verify_all
from tidemark.spec import Incremental, TableSpec

DAY = datetime(2023, 1, 1, 10)


@pytest.fixture
def sources(spark):
    users = [(n, f"TestUser{n}", datetime(2023, 1, n, 9 + n), 100 * n) for n in (1, 2, 3)]
    posts = [(n, 1, n, datetime(2023, 1, n, 12), f"Post {n}") for n in (1, 2, 3)]
    comments = [(n, n, 4 - n, datetime(2023, 1, n, 13), f"Comment {n}") for n in (1, 2, 3)]
    stamp = "CreationDate timestamp_ntz"
    return {
        "dbo.Users": spark.createDataFrame(users, f"Id int, DisplayName string, {stamp}, Reputation int"),
        "dbo.Posts": spark.createDataFrame(posts, f"Id int, PostTypeId int, OwnerUserId int, {stamp}, Title string"),
        "dbo.Comments": spark.createDataFrame(comments, f"Id int, PostId int, UserId int, {stamp}, Text string"),
    }


SPECS = {
    "Users": TableSpec("dbo.Users", primary_key=("Id",), naming="snake_case"),
    "Posts": TableSpec(
        "dbo.Posts", disposition="merge", primary_key=("Id",), incremental=Incremental("CreationDate", "2023-01-01T00:00:00"),
        rename={"Title": "Headline"},
    ),
    "Comments": TableSpec("dbo.Comments", disposition="append"),
    "Votes": TableSpec("dbo.Votes", enabled=False),
}


def test_run_and_verify(spark, sources):
    dataset = Dataset(spark)
    counts = {row.table_name: row.row_count for row in run_all(dataset, SPECS, "l1", "2023-02-01", **sources).collect()}
    assert counts == {"users": 3, "posts": 3, "comments": 3}
    again = {row.table_name: row.row_count for row in run_all(dataset, SPECS, "l2", "2023-02-02", **sources).collect()}
    assert again == {"users": 3, "posts": 3, "comments": 6}
    assert dataset.read("posts").columns[:5] == ["Id", "PostTypeId", "OwnerUserId", "CreationDate", "Headline"]

    checks = verify_all(
        dataset,
        SPECS,
        custom_checks={
            "no_bad_ids": "SELECT COUNT(*) FROM {users} WHERE id <= 0",
            "no_empty_names": "SELECT COUNT(*) FROM {users} WHERE display_name = '' OR display_name IS NULL",
            "broken": "SELECT COUNT(*) FROM {users} WHERE nope = 1",
        },
        **sources,
    )
    found = {(row.table_name, row.check_name): row.passed for row in checks.collect()}
    assert found == {
        ("Users", "row_count"): True,
        ("Users", "table_existence"): True,
        ("Users", "primary_key_integrity"): True,
        ("Posts", "row_count"): True,
        ("Posts", "table_existence"): True,
        ("Posts", "primary_key_integrity"): True,
        ("Comments", "row_count"): False,
        ("Comments", "table_existence"): True,
        ("custom", "no_bad_ids"): True,
        ("custom", "no_empty_names"): True,
        ("custom", "broken"): False,
    }
    total = verify.summary(checks).first()
    assert (total.total_checks, total.failed_checks, total.tables_with_issues) == (11, 2, "Comments,custom")
    tolerant = verify_all(dataset, SPECS, tables=["Comments"], tolerance=3, **sources)
    assert all(row.passed for row in tolerant.collect())

    report = {row.table_name: (row.loads, row.failures, row.success_rate) for row in audit_report(dataset).collect()}
    assert report == {"users": (2, 0, 100.0), "posts": (2, 0, 100.0), "comments": (2, 0, 100.0)}
    assert audit_report(dataset, by_table=False).first().loads == 6


def test_only_requested_tables_are_loaded(spark, sources):
    dataset = Dataset(spark)
    run_all(dataset, SPECS, "l1", "2023-02-01", ["Users"], **sources)
    assert dataset.exists("users") and not dataset.exists("posts")
    with pytest.raises(ValueError, match="Badges"):
        run_all(dataset, SPECS, "l1", "2023-02-01", ["Badges"], **sources)


def test_a_failing_table_fails_the_run_but_not_the_others(spark, sources):
    dataset = Dataset(spark)
    specs = SPECS | {"Tags": TableSpec("no_such_schema.Tags")}
    with pytest.raises(LoadError, match="tags"):
        run_all(dataset, specs, "l1", "2023-02-01", **sources)
    assert dataset.read("users").count() == 3
    report = {row.table_name: row.success_rate for row in audit_report(dataset).collect()}
    assert report["tags"] == 0.0 and report["users"] == 100.0


def test_verification_of_what_is_not_there(spark, sources):
    dataset = Dataset(spark)
    run_all(dataset, SPECS, "l1", "2023-02-01", ["Users"], **sources)
    rows = verify_all(dataset, SPECS, tables=["Users", "Posts", "Unknown"], **sources).collect()
    errors = {(row.table_name, row.check_name): row.error for row in rows if not row.passed}
    assert set(errors) == {("Posts", "row_count"), ("Posts", "table_existence"), ("Unknown", "configuration_check")}
    assert all(errors.values())
