"""Reading tables."""

from pyspark.sql import DataFrame

from tidemark.operators.profile import column_profile
from tidemark.plans.registry import Tables, query
from tidemark.sources.scan import scan, scan_chunked, scan_projection
from tidemark.spec import TableSpec


@query("scan_table", "SELECT * FROM lineitem")
def scan_table(tables: Tables) -> DataFrame:
    return scan(tables.spark, TableSpec(f"{tables.folder}/lineitem.parquet"))


QUERY_TEXT = """
    SELECT o.o_orderkey, o.o_orderdate, c.c_name, c.c_mktsegment
    FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
    WHERE o.o_orderstatus <> 'F'
"""


@query("scan_query", QUERY_TEXT.format(orders="orders", customer="customer"))
def scan_query(tables: Tables) -> DataFrame:
    spec = TableSpec("open_orders", query=QUERY_TEXT)
    return scan(tables.spark, spec, orders=tables["orders"], customer=tables["customer"])


@query("scan_where", "SELECT * FROM orders WHERE o_orderstatus = 'O' OR o_orderstatus IS NULL")
def scan_where(tables: Tables) -> DataFrame:
    spec = TableSpec(f"{tables.folder}/orders.parquet", where="o_orderstatus = 'O' OR o_orderstatus IS NULL")
    return scan(tables.spark, spec)


@query(
    "scan_partitioned",
    """
    SELECT *, CAST((o_orderkey - (SELECT MIN(o_orderkey) FROM orders)) // 10000 AS BIGINT) AS chunk
    FROM orders
    """,
)
def scan_partitioned(tables: Tables) -> DataFrame:
    return scan_chunked(tables["orders"], "o_orderkey", 10_000)


# Declared types of the orders columns.
ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "int",
    "o_orderstatus": "varchar(50)",
    "o_totalprice": "money",
    "o_orderdate": "datetime2",
    "o_orderpriority": "varchar(max)",
}


def profile_sql(table: str, types: dict[str, str], problematic: dict[str, bool], lengths: dict[str, int]) -> str:
    """The profile as SQL, one branch per column."""
    return " UNION ALL ".join(
        f"""
        SELECT '{table}' AS table_name, '{name}' AS column_name, CAST({place} AS INT) AS position,
               '{types[name].split("(")[0]}' AS data_type, CAST({lengths.get(name, "NULL")} AS INT) AS max_length,
               CAST(NULL AS INT) AS numeric_precision, CAST(NULL AS INT) AS numeric_scale, TRUE AS nullable,
               {problematic.get(name, False)} AS problematic, COUNT(*) AS row_count,
               COUNT(*) - COUNT({name}) AS null_count, COUNT(DISTINCT {name}) AS distinct_count
        FROM {table}
        """
        for place, name in enumerate(types, start=1)
    )


ORDER_PROFILE_SQL = profile_sql(
    "orders", ORDER_TYPES, {"o_totalprice": True}, {"o_orderstatus": 50, "o_orderpriority": -1}
)


@query("column_profile", ORDER_PROFILE_SQL)
def orders_profile(tables: Tables) -> DataFrame:
    return column_profile(tables["orders"], "orders", ORDER_TYPES)


@query("scan_projection", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'")
def customer_projection(tables: Tables) -> DataFrame:
    return scan_projection(tables["customer"], ["c_custkey", "c_name"], "c_acctbal > 0 AND c_mktsegment = 'BUILDING'")
