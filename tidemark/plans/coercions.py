"""Types, schemas, names, defaults and surrogate keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import coerce as op
from tidemark.operators.generate import uuid_text
from tidemark.plans.registry import Tables, query


@query(
    "coerce_money",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice
    FROM lineitem
    """,
)
def coerce_money(tables: Tables) -> DataFrame:
    rows = tables["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return op.coerce(rows, {"l_extendedprice": "money"})


@query("coerce_smallmoney", "SELECT p_partkey, CAST(p_retailprice AS DECIMAL(10,4)) AS p_retailprice FROM part")
def coerce_smallmoney(tables: Tables) -> DataFrame:
    return op.coerce(tables["part"].select("p_partkey", "p_retailprice"), {"p_retailprice": "smallmoney"})


@query(
    "coerce_high_precision",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DECIMAL(38,18)) AS net_amount
    FROM lineitem
    """,
)
def coerce_high_precision(tables: Tables) -> DataFrame:
    exact = F.col("l_extendedprice").cast("decimal(19,4)").alias("net_amount")
    rows = tables["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", exact)
    return op.coerce(rows, {"net_amount": "decimal(38,18)"})


@query("coerce_double", "SELECT c_custkey, CAST(CAST(c_acctbal AS REAL) AS DOUBLE) AS c_acctbal FROM customer")
def coerce_double(tables: Tables) -> DataFrame:
    rows = tables["customer"].select("c_custkey", F.col("c_acctbal").cast("float").alias("c_acctbal"))
    return op.coerce(rows, {"c_acctbal": "real"})


@query(
    "coerce_text",
    """
    SELECT CAST(CAST(md5(c_name) AS UUID) AS VARCHAR) AS row_guid, CAST(c_custkey AS VARCHAR) AS c_custkey,
           CAST(c_name AS VARCHAR) AS c_name
    FROM customer
    """,
)
def coerce_text(tables: Tables) -> DataFrame:
    rows = tables["customer"].select(uuid_text(F.col("c_name")).alias("row_guid"), "c_custkey", "c_name")
    return op.coerce(rows, {"row_guid": "uniqueidentifier", "c_custkey": "text", "c_name": "varchar(max)"})


@query(
    "coerce_timestamp",
    "SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CAST(strftime(ts, '%Y%m%d') AS INT) AS batch_key FROM events",
)
def coerce_timestamp(tables: Tables) -> DataFrame:
    text = F.col("ts").cast("string").alias("ts")
    rows = op.coerce(tables["events"].select("event_id", text), {"ts": "datetime2"})
    return rows.withColumn("batch_key", F.date_format("ts", "yyyyMMdd").cast("int"))


@query(
    "coerce_bool",
    """
    SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BOOLEAN) AS is_finished
    FROM orders
    """,
)
def coerce_bool(tables: Tables) -> DataFrame:
    bit = (F.col("o_orderstatus") == "F").cast("int").alias("is_finished")
    return op.coerce(tables["orders"].select("o_orderkey", bit), {"is_finished": "bit"})


@query(
    "coerce_bigint",
    "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem",
)
def coerce_bigint(tables: Tables) -> DataFrame:
    rows = tables["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return op.coerce(rows, {"l_linenumber": "bigint"})


LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "float",
    "l_extendedprice": "money",
    "l_discount": "smallmoney",
    "l_tax": "smallmoney",
    "l_returnflag": "char(1)",
    "l_linestatus": "varchar(max)",
    "l_shipdate": "datetime2",
}


@query(
    "coerce_auto",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
           CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice, CAST(l_discount AS DECIMAL(10,4)) AS l_discount,
           CAST(l_tax AS DECIMAL(10,4)) AS l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate
    FROM lineitem
    """,
)
def coerce_auto(tables: Tables) -> DataFrame:
    return op.coerce(op.declare(tables["lineitem"], LINEITEM_TYPES))


@query(
    "coerce_override",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DECIMAL(10,2)) AS l_quantity,
           CAST(l_extendedprice AS DECIMAL(28,8)) AS l_extendedprice, CAST(l_discount AS DECIMAL(10,4)) AS l_discount,
           CAST(l_tax AS DECIMAL(19,4)) AS l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate
    FROM lineitem
    """,
)
def coerce_override(tables: Tables) -> DataFrame:
    hints = {"L_EXTENDEDPRICE": "decimal(28,8)", "l_quantity": "decimal(10,2)", "l_tax": "decimal(19,4)"}
    return op.coerce(tables["lineitem"], LINEITEM_TYPES, hints)


AUDITED = {
    "l_extendedprice": "decimal(6,2)",
    "l_quantity": "decimal(10,4)",
    "l_discount": "decimal(4,1)",
    "l_partkey": "smallint",
    "l_returnflag": "int",
}


@query(
    "coercion_audit",
    " UNION ALL ".join(
        f"""
        SELECT '{name}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({name}) AS null_count,
               COUNT(*) FILTER (WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {target}) IS NULL) AS lost_count,
               {"0::BIGINT" if name == "l_returnflag" else
                f"COUNT(*) FILTER (WHERE CAST(TRY_CAST({name} AS {target}) AS DOUBLE) <> {name})"} AS changed_count
        FROM lineitem
        """
        for name, target in AUDITED.items()
    ),
)
def coercion_audit(tables: Tables) -> DataFrame:
    return op.audit_casts(tables["lineitem"], AUDITED)


# Numbers that a double or a narrower decimal cannot hold, and how many of them a cast changes.
EXACT = {"big": "double", "wide": "decimal(38,0)", "long_text": "decimal(19,4)"}
EXACT_CHANGED = {"big": "o_orderkey % 2 = 1", "wide": "o_orderkey % 100 <> 0", "long_text": "o_orderkey % 3 <> 0"}


@query(
    "coercion_audit_exact",
    " UNION ALL ".join(
        f"""
        SELECT '{name}' AS column_name, COUNT(*) AS row_count, 0::BIGINT AS null_count, 0::BIGINT AS lost_count,
               COUNT(*) FILTER (WHERE {changed}) AS changed_count
        FROM orders
        """
        for name, changed in EXACT_CHANGED.items()
    ),
)
def coercion_audit_exact(tables: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    cents = (key % 100).cast("decimal(38,2)") / F.lit(100)
    rows = tables["orders"].select(
        (F.lit(9007199254740992) + key).alias("big"),
        (F.lit("100000000000000000000000").cast("decimal(30,2)") + cents.cast("decimal(5,2)")).cast("decimal(38,2)").alias("wide"),
        F.concat(key.cast("string"), F.when(key % 3 == 0, ".2500").otherwise(".23456789")).alias("long_text"),
    )
    return op.audit_casts(rows, EXACT)


# Decimal columns: how each is made, in SQL both engines read, and its declared type.
PRECISE = {
    "amount": ("CAST(o_totalprice AS DECIMAL(19,4))", 19, 4),
    "exact_amount": ("CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DECIMAL(38,18))", 38, 18),
    "unit_amount": ("CAST(CAST(o_totalprice / 7 AS DECIMAL(19,6)) AS DECIMAL(38,6))", 38, 6),
}
PRECISE_SQL = ", ".join(f"{made} AS {name}" for name, (made, _, _) in PRECISE.items())


def _digits_sql(name: str) -> tuple[str, str]:
    text = f"CAST(abs({name}) AS VARCHAR)"
    return f"length(ltrim(split_part({text}, '.', 1), '0'))", f"length(rtrim(split_part({text}, '.', 2), '0'))"


def _precision_sql(name: str, precision: int, scale: int) -> str:
    whole, fraction = _digits_sql(name)
    return f"""
        SELECT '{name}' AS column_name, {precision} AS declared_precision, {scale} AS declared_scale,
               {(precision, scale) == (19, 4)} AS as_expected, CAST(MAX({whole}) AS INT) AS integer_digits,
               CAST(MAX({fraction}) AS INT) AS fraction_digits,
               COUNT(*) FILTER (WHERE {whole} > 15 OR {fraction} > 4) AS beyond_expected
        FROM src
    """


@query(
    "precision_audit",
    f"WITH src AS (SELECT {PRECISE_SQL} FROM orders)"
    + " UNION ALL ".join(_precision_sql(name, *declared) for name, (_, *declared) in PRECISE.items()),
)
def precision_audit(tables: Tables) -> DataFrame:
    rows = tables["orders"].select(*[F.expr(made).alias(name) for name, (made, _, _) in PRECISE.items()])
    return op.audit_precision(rows, list(PRECISE))


@query(
    "align_schema",
    """
    SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(19,4)) AS c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(10,4)) AS DECIMAL(19,4)), NULL FROM supplier
    """,
)
def align_schema(tables: Tables) -> DataFrame:
    target = op.coerce(tables["customer"], {"c_acctbal": "money"})
    batch = op.coerce(tables["supplier"], {"s_acctbal": "smallmoney"})
    names = {"s_suppkey": "C_CustKey", "s_name": "c_name", "s_nationkey": "c_nationkey", "s_acctbal": "c_acctbal"}
    batch = op.map_columns(batch, names).withColumn("source_note", F.lit("supplier"))
    fitted, _ = op.align_schema(batch, target.schema)
    return target.unionByName(fitted)


ORIGINAL_NAMES = {
    "o_orderkey": "RecordID",
    "o_custkey": "ClientID",
    "o_orderstatus": "StatusCode",
    "o_totalprice": "YearToDateAmount",
    "o_orderdate": "LastPurchaseDate",
    "o_orderpriority": "HasAPIAccess",
}


@query(
    "rename_convention",
    """
    SELECT o_orderkey AS record_id, o_custkey AS client_id, o_orderstatus AS status_code,
           o_totalprice AS year_to_date_amount, o_orderdate AS last_purchase_date, o_orderpriority AS has_api_access
    FROM orders
    """,
)
def rename_convention(tables: Tables) -> DataFrame:
    return op.rename_by_convention(op.map_columns(tables["orders"], ORIGINAL_NAMES), "snake_case")


@query(
    "rename_convention_sql_safe",
    """
    SELECT o_orderkey AS record_id, o_custkey AS clientid, o_orderstatus AS "status_code_", o_totalprice AS _2_amount,
           o_orderdate, o_orderpriority
    FROM orders
    """,
)
def rename_convention_sql_safe(tables: Tables) -> DataFrame:
    odd = {
        "o_orderkey": "Record ID",
        "o_custkey": "ClientID",
        "o_orderstatus": "Status-Code%",
        "o_totalprice": "2 Amount",
    }
    return op.rename_by_convention(op.map_columns(tables["orders"], odd), "sql_ci_v1")


@query(
    "column_mapping",
    "SELECT c_custkey AS client_id, c_name AS client_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def column_mapping(tables: Tables) -> DataFrame:
    return op.map_columns(tables["customer"], {"c_custkey": "client_id", "c_name": "client_name"})


@query(
    "restored_name_view",
    """
    SELECT o_orderkey AS "RecordID", o_custkey AS "ClientID", o_totalprice AS "YearToDateAmount" FROM orders
    WHERE o_totalprice > 250000
    """,
)
def restored_name_view(tables: Tables) -> DataFrame:
    loaded = rename_convention(tables)
    names = {"record_id": "RecordID", "client_id": "ClientID", "year_to_date_amount": "YearToDateAmount"}
    op.original_names(loaded, names, view="reporting_orders")
    return tables.spark.sql("SELECT * FROM reporting_orders WHERE YearToDateAmount > 250000")


@query(
    "apply_defaults",
    """
    SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'NEW') AS o_orderstatus,
           coalesce(nullif(o_orderpriority, '5-LOW'), '0-NONE') AS o_orderpriority,
           coalesce(CASE WHEN o_totalprice < 200000 THEN NULL ELSE o_totalprice END, 0) AS o_totalprice,
           TRUE AS is_active, 'ETL_PROCESS' AS created_by, TIMESTAMP '2024-01-01 00:00:00' AS load_date_time
    FROM orders
    """,
)
def apply_defaults(tables: Tables) -> DataFrame:
    rows = tables["orders"].select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_totalprice") >= 200000, F.col("o_totalprice")).alias("o_totalprice"),
    )
    defaults = {
        "o_orderstatus": "NEW",
        "o_orderpriority": "0-NONE",
        "o_totalprice": 0,
        "is_active": True,
        "created_by": "ETL_PROCESS",
        "load_date_time": F.lit("2024-01-01").cast("timestamp_ntz"),
    }
    return op.apply_defaults(rows, defaults)


@query(
    "assign_surrogate_key",
    """
    SELECT *, (SELECT MAX(c_custkey) FROM customer)
              + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS record_id
    FROM orders
    """,
)
def assign_surrogate_key(tables: Tables) -> DataFrame:
    highest = tables["customer"].agg(F.max("c_custkey")).scalar()
    return op.assign_surrogate_key(tables["orders"], "record_id", ["o_orderdate", "o_orderkey"], highest)
