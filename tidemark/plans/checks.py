"""Verification of loads, on a copy of orders with faults of every kind."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.draws import draw_sql
from tidemark.operators import verify as op
from tidemark.operators.profile import column_profile
from tidemark.plans.registry import Tables, query
from tidemark.plans.scans import ORDER_TYPES, profile_sql

# The copy lacks the oldest orders, has some prices and states changed, and holds extra rows.
COPY_SQL = """
    copy AS (
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END
                   AS o_orderstatus,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END
                   AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01'
        UNION ALL
        SELECT s_suppkey + 1 + (SELECT MAX(o_orderkey) FROM orders), s_suppkey, 'O', 0.0, TIMESTAMP '2024-01-01', '3-MEDIUM'
        FROM supplier
    )
"""


def faulty_copy(tables: Tables) -> DataFrame:
    state, urgency = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice")
    kept = (
        tables["orders"]
        .where("o_orderdate >= TIMESTAMP_NTZ '1995-03-01'")
        .withColumns(
            {
                "o_orderstatus": F.when((urgency == "5-LOW") & (state == "P"), None).otherwise(state),
                "o_totalprice": F.when((urgency == "1-URGENT") & (state == "O"), price + 1).otherwise(price),
            }
        )
    )
    highest = tables["orders"].agg(F.max("o_orderkey")).scalar()
    extra = tables["supplier"].select(
        (F.col("s_suppkey") + 1 + highest).alias("o_orderkey"),
        F.col("s_suppkey").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit(0.0).alias("o_totalprice"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("3-MEDIUM").alias("o_orderpriority"),
    )
    return kept.unionByName(extra)


def result_sql(**values: str) -> str:
    """A check result; values not given are NULL."""
    types = {"string": "VARCHAR", "boolean": "BOOLEAN", "bigint": "BIGINT"}
    return ", ".join(
        f"CAST({values.get(name, 'NULL')} AS {types[spark_type]}) AS {name}" for name, spark_type in op.RESULT_TYPES.items()
    )


ROW_COUNT_SQL = f"""
    SELECT {result_sql(table_name="'orders'", check_name="'row_count'", passed="abs(s - d) <= 5", source_value="s",
                       dest_value="d", difference="abs(s - d)", tolerance="5")}
    FROM (SELECT (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'F') AS s,
                 (SELECT COUNT(*) FROM copy WHERE o_orderstatus <> 'F') AS d)
"""


@query("verify_row_count", f"WITH {COPY_SQL} {ROW_COUNT_SQL}")
def verify_row_count(tables: Tables) -> DataFrame:
    loaded = "o_orderstatus <> 'F'"
    return op.row_count("orders", tables["orders"].where(loaded), faulty_copy(tables).where(loaded), tolerance=5)


RANGE_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
}
RANGES_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(MIN({key}) AS BIGINT) AS min_key, "
    f"CAST(MAX({key}) AS BIGINT) AS max_key FROM {name}"
    for name, key in RANGE_KEYS.items()
)


def ranges(tables: Tables) -> DataFrame:
    return op.table_ranges({name: (tables[name], key) for name, key in RANGE_KEYS.items()})


@query("table_range_summary", RANGES_SQL)
def table_range_summary(tables: Tables) -> DataFrame:
    return ranges(tables)


EXPECTED = [*RANGE_KEYS, "badges", "empty_orders"]
LOADED_SQL = f"""
    SELECT {result_sql(table_name="e.name", check_name="'table_existence'", passed="coalesce(r.row_count, 0) > 0",
                       dest_value="coalesce(r.row_count, 0)")}
    FROM (SELECT unnest({EXPECTED}) AS name) e LEFT JOIN (
        {RANGES_SQL} UNION ALL SELECT 'empty_orders', COUNT(*), NULL, NULL FROM orders WHERE o_orderkey < 0
    ) r ON r.table_name = e.name
"""


@query("verify_tables_loaded", LOADED_SQL)
def verify_tables_loaded(tables: Tables) -> DataFrame:
    empty = op.table_ranges({"empty_orders": (tables["orders"].where("o_orderkey < 0"), "o_orderkey")})
    return op.tables_loaded(tables.spark, EXPECTED, ranges(tables).unionByName(empty))


def key_sql(table: str, keys: str) -> str:
    return f"""
        SELECT {result_sql(table_name=f"'{table}'", check_name="'primary_key_integrity'", passed="t = d",
                           source_value="t", dest_value="d", difference="t - d")}
        FROM (SELECT COUNT(*) AS t, COUNT(DISTINCT ({keys})) AS d FROM {table})
    """


KEYS_SQL = f"{key_sql('lineitem', 'l_orderkey, l_linenumber')} UNION ALL {key_sql('orders', 'o_orderkey')}"


@query("verify_primary_key", KEYS_SQL)
def verify_primary_key(tables: Tables) -> DataFrame:
    lines = op.primary_key("lineitem", tables["lineitem"], ["l_orderkey", "l_linenumber"])
    return lines.unionByName(op.primary_key("orders", tables["orders"], ["o_orderkey"]))


@query(
    "verify_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def verify_duplicate_keys(tables: Tables) -> DataFrame:
    return op.duplicate_keys(tables["lineitem"], ["l_orderkey", "l_linenumber"])


CUSTOM_CHECKS = {
    "no_negative_keys": "SELECT COUNT(*) FROM {orders} WHERE o_orderkey < 0",
    "no_missing_status": "SELECT COUNT(*) FROM {orders} WHERE o_orderstatus IS NULL",
    "key_is_unique": "SELECT o_orderkey FROM {orders} GROUP BY o_orderkey HAVING COUNT(*) > 1",
    "one_order_a_customer": "SELECT COUNT(*) FROM {orders} GROUP BY o_custkey HAVING COUNT(*) > 12",
}


@query(
    "verify_custom_check",
    f"WITH {COPY_SQL}"
    + " UNION ALL ".join(
        f"""
        SELECT {result_sql(table_name="'custom'", check_name=f"'{name}'", passed="v = 0", dest_value="v",
                           difference="v", tolerance="0")}
        FROM (SELECT CASE WHEN COUNT(*) = 1 THEN MAX(n) ELSE COUNT(*) END AS v
              FROM ({text.format(orders="copy")}) t(n))
        """
        for name, text in CUSTOM_CHECKS.items()
    ),
)
def verify_custom_check(tables: Tables) -> DataFrame:
    copy = faulty_copy(tables)
    return op.union_checks([op.custom_check(tables.spark, name, text, orders=copy) for name, text in CUSTOM_CHECKS.items()])


RULES = {
    "null_key": "c_custkey IS NULL",
    "non_positive_key": "c_custkey <= 0",
    "negative_balance": "c_acctbal < 0",
    "malformed_name": "c_name NOT LIKE 'Customer#%'",
    "empty_segment": "c_mktsegment IS NULL OR c_mktsegment = ''",
}
RULES_SQL = " UNION ALL ".join(
    f"""
    SELECT {result_sql(table_name="'customer'", check_name=f"'{name}'", passed="n = 0", dest_value="n",
                       difference="n", tolerance="0")}
    FROM (SELECT COUNT(*) FILTER (WHERE {broken}) AS n FROM customer)
    """
    for name, broken in RULES.items()
)


@query("verify_rules", RULES_SQL)
def verify_rules(tables: Tables) -> DataFrame:
    return op.rules("customer", tables["customer"], {name: F.expr(broken) for name, broken in RULES.items()})


@query(
    "reconcile_batches",
    f"""
    WITH {COPY_SQL},
    s AS (SELECT o_orderdate, COUNT(*) AS n FROM orders GROUP BY 1),
    d AS (SELECT o_orderdate, COUNT(*) AS n FROM copy
          WHERE NOT (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1999-06-01') GROUP BY 1)
    SELECT o_orderdate, coalesce(s.n, 0) AS source_count, coalesce(d.n, 0) AS dest_count,
           coalesce(s.n, 0) - coalesce(d.n, 0) AS difference,
           CASE WHEN d.n IS NULL THEN 'missing_in_destination' WHEN s.n IS NULL THEN 'missing_in_source'
                WHEN s.n = d.n THEN 'match' ELSE 'differs' END AS status
    FROM s FULL JOIN d USING (o_orderdate)
    """,
)
def reconcile_batches(tables: Tables) -> DataFrame:
    copy = faulty_copy(tables).where("NOT (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ '1999-06-01')")
    return op.reconcile_batches(tables["orders"], copy, "o_orderdate")


_FACTS = ["data_type", "nullable", "row_count", "null_count", "distinct_count"]
_COPY_TYPES = {name: text for name, text in ORDER_TYPES.items() if name != "o_orderpriority"} | {"o_totalprice": "float"}


@query(
    "compare_profiles",
    f"""
    WITH {COPY_SQL}, s AS ({profile_sql("orders", ORDER_TYPES, {}, {})}),
    d AS ({profile_sql("copy", _COPY_TYPES, {}, {})})
    SELECT column_name, {", ".join(f"{side[0]}.{fact} AS {side}_{fact}" for fact in _FACTS for side in ("source", "dest"))},
           CASE WHEN d.data_type IS NULL THEN 'missing_in_destination' WHEN s.data_type IS NULL THEN 'missing_in_source'
                ELSE concat_ws(',', {", ".join(f"CASE WHEN s.{fact} IS DISTINCT FROM d.{fact} THEN '{fact}' END" for fact in _FACTS)})
           END AS differences
    FROM s FULL JOIN d USING (column_name)
    """,
)
def compare_profiles(tables: Tables) -> DataFrame:
    source = column_profile(tables["orders"], "orders", ORDER_TYPES)
    # Literals are never NULL to Spark; a loaded table would read them back as nullable.
    copy = faulty_copy(tables).drop("o_orderpriority")
    loaded = copy.select(*[F.nullif(F.col(name), F.lit(None)).alias(name) for name in copy.columns])
    return op.compare_profiles(source, column_profile(loaded, "copy", _COPY_TYPES))


_SAMPLED = ["o_orderstatus", "o_totalprice", "o_orderdate"]


@query(
    "compare_sample",
    f"""
    WITH {COPY_SQL},
    s AS (SELECT * FROM orders WHERE {draw_sql("o_orderkey", 0)} % 100 < 30),
    d AS (SELECT * FROM copy WHERE {draw_sql("o_orderkey", 0)} % 100 < 30)
    """
    + " UNION ALL ".join(
        f"""
        SELECT '{name}' AS column_name,
               COUNT(*) FILTER (WHERE s.o_orderkey IS NOT NULL AND d.o_orderkey IS NOT NULL
                                AND s.{name} IS NOT DISTINCT FROM d.{name}) AS equal_count,
               COUNT(*) FILTER (WHERE s.{name} <> d.{name}) AS different_count,
               COUNT(*) FILTER (WHERE s.o_orderkey IS NOT NULL AND d.o_orderkey IS NOT NULL
                                AND (s.{name} IS NULL) <> (d.{name} IS NULL)) AS null_mismatch,
               COUNT(*) FILTER (WHERE d.o_orderkey IS NULL) AS missing_count,
               COUNT(*) FILTER (WHERE s.o_orderkey IS NULL) AS extra_count
        FROM s FULL JOIN d ON s.o_orderkey = d.o_orderkey
        """
        for name in _SAMPLED
    ),
)
def compare_sample(tables: Tables) -> DataFrame:
    return op.compare_sample(tables["orders"], faulty_copy(tables), ["o_orderkey"], _SAMPLED, percent=30)


@query(
    "compare_values",
    f"""
    WITH {COPY_SQL}
    SELECT coalesce(s.o_orderkey, d.o_orderkey) AS o_orderkey,
           CASE WHEN d.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
                WHEN s.o_custkey IS NOT DISTINCT FROM d.o_custkey AND s.o_orderstatus IS NOT DISTINCT FROM d.o_orderstatus
                 AND s.o_totalprice IS NOT DISTINCT FROM d.o_totalprice AND s.o_orderdate IS NOT DISTINCT FROM d.o_orderdate
                 AND s.o_orderpriority IS NOT DISTINCT FROM d.o_orderpriority THEN 'same' ELSE 'changed' END AS status,
           CASE WHEN s.o_orderkey IS NULL THEN 0::BIGINT ELSE 1::BIGINT END AS source_rows,
           CASE WHEN d.o_orderkey IS NULL THEN 0::BIGINT ELSE 1::BIGINT END AS dest_rows
    FROM orders s FULL JOIN copy d ON s.o_orderkey = d.o_orderkey
    """,
)
def compare_values(tables: Tables) -> DataFrame:
    return op.compare_values(tables["orders"], faulty_copy(tables), ["o_orderkey"])


@query(
    "compare_by_checksum",
    f"""
    WITH {COPY_SQL}
    SELECT coalesce(s.o_orderkey, d.o_orderkey) AS o_orderkey,
           CASE WHEN d.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS status,
           CASE WHEN s.o_orderkey IS NULL THEN 0::BIGINT ELSE 1::BIGINT END AS source_rows,
           CASE WHEN d.o_orderkey IS NULL THEN 0::BIGINT ELSE 1::BIGINT END AS dest_rows
    FROM orders s FULL JOIN copy d ON s.o_orderkey = d.o_orderkey
    WHERE s.o_orderkey IS NULL OR d.o_orderkey IS NULL
       OR s.o_custkey IS DISTINCT FROM d.o_custkey OR s.o_orderstatus IS DISTINCT FROM d.o_orderstatus
       OR s.o_totalprice IS DISTINCT FROM d.o_totalprice OR s.o_orderdate IS DISTINCT FROM d.o_orderdate
       OR s.o_orderpriority IS DISTINCT FROM d.o_orderpriority
    """,
)
def compare_by_checksum(tables: Tables) -> DataFrame:
    return op.compare_by_checksum(tables["orders"], faulty_copy(tables), ["o_orderkey"])


@query(
    "compare_rows",
    """
    WITH s AS (SELECT *, COUNT(*) AS n FROM lineitem GROUP BY ALL)
    SELECT * EXCLUDE (n), n AS source_rows, CASE WHEN l_returnflag = 'R' THEN 0::BIGINT ELSE n END AS dest_rows
    FROM s WHERE l_returnflag = 'R'
    """,
)
def compare_rows(tables: Tables) -> DataFrame:
    """Whole rows without a key, against a copy that lacks the returned ones."""
    rows = tables["lineitem"]
    return op.compare_rows(rows, rows.where("l_returnflag <> 'R'"))


@query(
    "verify_summary",
    f"""
    WITH {COPY_SQL}, r AS ({ROW_COUNT_SQL} UNION ALL {LOADED_SQL} UNION ALL {KEYS_SQL} UNION ALL {RULES_SQL})
    SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed_checks,
           COUNT(*) FILTER (WHERE NOT passed) AS failed_checks,
           COUNT(*) FILTER (WHERE passed) * CAST(100 AS DOUBLE) / COUNT(*) AS success_rate,
           bool_and(passed) AS overall_passed,
           (SELECT string_agg(t, ',' ORDER BY t) FROM (SELECT DISTINCT table_name AS t FROM r WHERE NOT passed))
               AS tables_with_issues
    FROM r
    """,
)
def verify_summary(tables: Tables) -> DataFrame:
    checks = [verify_row_count, verify_tables_loaded, verify_primary_key, verify_rules]
    return op.summary(op.union_checks([check(tables) for check in checks]))
