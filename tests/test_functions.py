"""Type rules, names, watermark values and specs."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import naming, types, watermarks
from tidemark.functions.draws import draw
from tidemark.sources.scan import jdbc_partitions, scan
from tidemark.spec import Incremental, TableSpec, split_name


@pytest.mark.parametrize(
    ("declared", "target"),
    [
        ("money", "decimal(19,4)"),
        ("SMALLMONEY", "decimal(10,4)"),
        ("decimal(38,18)", "decimal(38,18)"),
        ("numeric(29, 2)", "decimal(29,2)"),
        ("decimal(28,4)", None),
        ("decimal(10,4)", None),
        ("float", "double"),
        ("real", "double"),
        ("varchar(max)", "string"),
        ("nvarchar(-1)", "string"),
        ("varchar(8001)", "string"),
        ("varchar(8000)", None),
        ("varchar(255)", None),
        ("text", "string"),
        ("ntext", "string"),
        ("char(10)", None),
        ("uniqueidentifier", "string"),
        ("datetime2", "timestamp_ntz"),
        ("bigint", "bigint"),
        ("int", None),
        ("bit", "boolean"),
    ],
)
def test_target_of_a_declared_type(declared, target):
    assert types.SourceType.parse(declared).target == target


def test_problematic_types():
    names = ["money", "smallmoney", "uniqueidentifier", "text", "ntext", "float", "real"]
    assert all(types.SourceType.parse(name).problematic for name in names)
    assert not types.SourceType.parse("decimal(38,18)").problematic


def test_type_text_must_parse():
    with pytest.raises(ValueError, match="not a column type"):
        types.SourceType.parse("decimal(10")


def test_overrides_win_and_names_match_without_case(spark):
    df = spark.range(1).select(F.lit(1.0).alias("Amount"), F.lit("x").alias("Note"))
    assert types.target_types(df, {"AMOUNT": "money"}) == {"Amount": "decimal(19,4)", "Note": "string"}
    assert types.target_types(df, {"amount": "money"}, {"aMOUNT": "decimal(9,1)"})["Amount"] == "decimal(9,1)"
    with pytest.raises(ValueError, match="do not exist"):
        types.target_types(df, {"amuont": "money"})
    assert types.problematic_columns(df, {"amount": "money", "note": "varchar(20)"}) == ["Amount"]


@pytest.mark.parametrize(
    ("old", "new", "fits"),
    [
        ("decimal(10,4)", "decimal(19,4)", True),
        ("decimal(19,4)", "decimal(10,4)", False),
        ("decimal(19,4)", "decimal(19,2)", False),
        ("decimal(10,2)", "decimal(10,4)", False),
        ("int", "bigint", True),
        ("bigint", "int", False),
        ("int", "decimal(14,4)", True),
        ("int", "decimal(13,4)", False),
        ("float", "double", True),
        ("double", "float", False),
        ("bigint", "string", True),
        ("array<int>", "string", False),
    ],
)
def test_widening(old, new, fits):
    assert types.widens(T.DataType.fromDDL(old), T.DataType.fromDDL(new)) is fits


EDGES = {
    "double": [None, 0.0, -0.0, 99.994, 99.995, 99.999, 100.0, -99.999, 1e22, 1e300, float("nan"), float("inf"), 127.9, 128.0, -128.9, -129.0],
    "bigint": [None, 0, 99, 100, -100, 127, 128, -128, -129, 2**31 - 1, 2**31, -(2**31) - 1, 2**63 - 1, -(2**63)],
    "string": [None, "", " 12 ", "12", "+7", "-99.99", "99.995", "100", "1e1", "1E-3", ".5", "5.", "abc", "12abc", "NaN", "127", "128", "\t3\n", "1.5f", "1d"],
    "decimal(12,4)": [None, Decimal("99.9949"), Decimal("99.9950"), Decimal("100"), Decimal("-100"), Decimal("12345678.9")],
}


@pytest.mark.parametrize("source", EDGES)
@pytest.mark.parametrize("target", ["decimal(4,2)", "decimal(38,18)", "tinyint", "int", "double", "string"])
def test_try_fit_equals_try_cast(spark, rows, source, target):
    df = spark.createDataFrame([(value,) for value in EDGES[source]], f"v {source}")
    found = rows(df.select("v", types.try_fit(F.col("v"), df.schema["v"].dataType, target).cast("string")))
    assert found == rows(df.select("v", F.col("v").try_cast(target).cast("string"))) or source == "double"
    if source == "double":
        assert [row[1:] for row in found] == [row[1:] for row in rows(df.select("v", F.col("v").try_cast(target).cast("string")))]


@pytest.mark.parametrize(
    ("name", "converted"),
    [
        ("SystemCalendarID", "system_calendar_id"),
        ("ClientID", "client_id"),
        ("AccountNumber", "account_number"),
        ("ClientCode", "client_code"),
        ("HasAPIAccess", "has_api_access"),
        ("Address2", "address2"),
        ("already_snake", "already_snake"),
        ("Odd Name-1", "odd_name_1"),
    ],
)
def test_snake_case(name, converted):
    assert naming.snake_case(name) == converted


def test_conventions():
    names = ["ClientID", "Größe", "Net Amount", "1st"]
    assert naming.convert_names(names, "direct") == names
    assert naming.convert_names(names, "duck_case") == names
    assert naming.convert_names(names, "sql_cs_v1") == ["ClientID", "Gr__e", "Net_Amount", "_1st"]
    assert naming.convert_names(names, "sql_ci_v1") == ["clientid", "gr__e", "net_amount", "_1st"]
    with pytest.raises(ValueError, match="unknown naming"):
        naming.convert_names(names, "kebab")


def test_names_that_meet_are_refused():
    with pytest.raises(ValueError, match="'UserID' and 'user_id'"):
        naming.convert_names(["UserID", "user_id"], "snake_case")
    with pytest.raises(ValueError, match="'A' and 'a'"):
        naming.convert_names(["A", "a"], "direct")


def test_bounds_by_strategy():
    convert = watermarks.convert_bound
    assert isinstance(convert("2023-01-01T00:00:00Z", "timestamp"), datetime)
    assert convert("Jan 1, 2023", "timestamp") == datetime(2023, 1, 1)
    assert convert(datetime(2023, 5, 1), "timestamp") == datetime(2023, 5, 1)
    assert convert(date(2023, 5, 1), "timestamp") == datetime(2023, 5, 1)
    assert convert("123", "sequence") == 123 and isinstance(convert("123", "sequence"), int)
    assert convert("123.45", "sequence") == 123.45 and isinstance(convert("123.45", "sequence"), float)
    assert convert(0, "sequence") == 0
    custom = {"custom": "data"}
    assert convert(custom, "custom") is custom
    assert all(convert(None, strategy) is None for strategy in ("timestamp", "sequence", "custom"))


@pytest.mark.parametrize(
    ("value", "strategy", "message"),
    [
        (123, "timestamp", "Invalid timestamp initial value"),
        ("soon", "timestamp", "Invalid timestamp initial value"),
        ("not_a_number", "sequence", "Invalid sequence initial value"),
        ([], "sequence", "Invalid sequence initial value"),
        ("nan", "sequence", "Invalid sequence initial value"),
        (True, "sequence", "Invalid sequence initial value"),
    ],
)
def test_wrong_bounds(value, strategy, message):
    with pytest.raises(ValueError, match=message):
        watermarks.convert_bound(value, strategy)


def test_texts_parse_by_column(spark):
    texts = ["2023-01-01T00:00:00Z", "2023-01-01T02:00:00+02:00", "Jan 1, 2023", "01/31/2023", "20230131", "123", "123.45", "soon", None]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    value = F.col("t")
    found = df.select(watermarks.parse_timestamp(value), watermarks.parse_integer(value), watermarks.parse_number(value)).collect()
    new_year, later = datetime(2023, 1, 1), datetime(2023, 1, 31)
    assert [row[0] for row in found] == [new_year, new_year, new_year, later, later, None, None, None, None]
    assert [row[1] for row in found] == [None, None, None, None, 20230131, 123, None, None, None]
    assert [row[2] for row in found] == [None, None, None, None, 20230131.0, 123.0, 123.45, None, None]


def test_zoned_bounds_mean_utc(spark):
    zoned = datetime.fromisoformat("2023-01-01T02:00:00+02:00")
    plain = spark.range(1).select(watermarks.bound_literal(zoned, "timestamp_ntz")).first()[0]
    assert plain == datetime(2023, 1, 1)


def test_specs_are_checked():
    assert TableSpec("dbo.Posts").target == "posts"
    assert TableSpec("/data/sf1/orders.parquet").target == "orders"
    assert TableSpec("dbo.Posts", destination="Beiträge").target == "Beiträge"
    assert split_name("dbo.Posts") == ("dbo", "Posts") and split_name("Posts") == ("dbo", "Posts")
    for wrong in (
        lambda: TableSpec(""),
        lambda: TableSpec("t", disposition="upsert"),
        lambda: TableSpec("t", disposition="merge"),
        lambda: TableSpec("t", chunk_rows=0),
        lambda: Incremental("", 0),
        lambda: Incremental("c", None),
        lambda: Incremental("c", 0, "magic"),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_jdbc_read_is_cut_into_chunks():
    options = jdbc_partitions("id", 1, 100_000, rows=95_000, chunk_rows=10_000)
    assert options["numPartitions"] == "10" and options["upperBound"] == "100001" and options["fetchsize"] == "10000"
    assert jdbc_partitions("id", 0, 0, rows=0, chunk_rows=10)["numPartitions"] == "1"
    with pytest.raises(ValueError):
        jdbc_partitions("id", 0, 1, 1, 0)


def test_scan_filters_and_prunes_at_the_source(spark, capsys):
    spec = TableSpec("/root/testdata/sf0.001/orders.parquet", where="o_orderkey > 10", columns=("o_orderkey", "o_custkey"))
    scan(spark, spec).explain()
    plan = capsys.readouterr().out
    assert "GreaterThan(o_orderkey,10)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_scan_of_catalog_table_and_query(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert scan(spark, TableSpec("five", where="id < 2")).count() == 2
    assert scan(spark, TableSpec("q", query="SELECT id FROM {t} WHERE id > 2"), t=spark.range(5)).count() == 2


def test_draws_are_even_and_independent(spark):
    pair = spark.range(100_000).select((draw("id", 1) % 10).alias("a"), (draw("id", 2) % 10).alias("b"))
    cells = {tuple(row[:2]): row[2] for row in pair.groupBy("a", "b").count().collect()}
    assert len(cells) == 100 and max(cells.values()) < 1300 and min(cells.values()) > 700
    top = spark.sql("SELECT 9223372036854775807 AS id").select(draw("id", 3)).first()[0]
    assert 0 <= top < 2**31
