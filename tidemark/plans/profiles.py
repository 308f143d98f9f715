"""Profiles and load reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import profile as op
from tidemark.operators.load import Dataset
from tidemark.plans.incrementals import EVENT_DAYS_SQL, event_days
from tidemark.plans.registry import Tables, query
from tidemark.plans.scans import ORDER_PROFILE_SQL, ORDER_TYPES, profile_sql

CUSTOMER_TYPES = {
    "c_custkey": "bigint",
    "c_name": "varchar(255)",
    "c_nationkey": "int",
    "c_acctbal": "money",
    "c_mktsegment": "varchar(50)",
}
CUSTOMER_PROFILE_SQL = profile_sql(
    "customer", CUSTOMER_TYPES, {"c_acctbal": True}, {"c_name": 255, "c_mktsegment": 50}
)


def profiles(tables: Tables) -> DataFrame:
    orders = op.column_profile(tables["orders"], "orders", ORDER_TYPES)
    return orders.unionByName(op.column_profile(tables["customer"], "customer", CUSTOMER_TYPES))


_SKETCHED = ("event_id", "user_id", "event_type")


@query(
    "profile_incremental",
    " UNION ALL ".join(
        f"""
        SELECT '{name}' AS column_name, COUNT(*) AS row_count, CAST(COUNT(*) - COUNT({name}) AS BIGINT) AS null_count,
               CAST(MIN({name}) AS VARCHAR) AS lowest, CAST(MAX({name}) AS VARCHAR) AS highest,
               TRUE AS distinct_within_error
        FROM (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events)
        """
        for name in _SKETCHED
    ),
)
def profile_incremental(tables: Tables) -> DataFrame:
    """Sketches of three loads, the last one run twice, merged and compared with the exact distinct counts."""
    dataset, days = Dataset(tables.spark), event_days(tables)
    known = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    rows = days.select("event_id", "user_id", known, "batch_key")
    parts = ("batch_key <= 20240110", "batch_key > 20240110 AND batch_key <= 20240120", "batch_key > 20240120")
    for number, part in enumerate((*parts, parts[-1])):
        op.keep_sketches(dataset, "events", rows.where(part).drop("batch_key"), f"load-{min(number, 2)}")
    exact = op.column_profile(rows.drop("batch_key"), "events").select("column_name", "distinct_count")
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
    return op.kept_profile(dataset, "events").join(exact, "column_name").select(
        "column_name", "row_count", "null_count", "lowest", "highest",
        (off <= F.col("distinct_count") * op.SKETCH_ERROR).alias("distinct_within_error"),
    )


@query(
    "estimate_rows",
    """
    SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
    """,
)
def estimate_rows(tables: Tables) -> DataFrame:
    open_orders = op.estimate_rows(tables["orders"].where("o_orderstatus = 'O'"), "orders")
    return open_orders.unionByName(op.estimate_rows(tables["lineitem"], "lineitem"))


@query(
    "schema_summary",
    f"""
    WITH p AS ({ORDER_PROFILE_SQL} UNION ALL {CUSTOMER_PROFILE_SQL})
    SELECT table_name, data_type, COUNT(*) AS column_count, bool_or(problematic) AS problematic,
           MAX(row_count) AS row_count, MAX(total_columns) AS total_columns
    FROM p JOIN (SELECT table_name, COUNT(*) AS total_columns FROM p GROUP BY 1) USING (table_name) GROUP BY 1, 2
    """,
)
def schema_summary(tables: Tables) -> DataFrame:
    return op.schema_summary(profiles(tables))


@query(
    "columns_by_type",
    f"""
    WITH p AS ({ORDER_PROFILE_SQL} UNION ALL {CUSTOMER_PROFILE_SQL})
    SELECT data_type, COUNT(*) AS column_count, string_agg(column_name, ', ' ORDER BY column_name) AS columns,
           CAST(SUM(row_count - null_count) AS BIGINT) AS value_count
    FROM p GROUP BY 1
    """,
)
def columns_by_type(tables: Tables) -> DataFrame:
    return op.columns_by_type(profiles(tables))


@query(
    "data_state",
    f"""
    SELECT COUNT(*) AS total_records, COUNT(DISTINCT batch_key) AS unique_batches,
           MIN(batch_key) AS earliest_batch, MAX(batch_key) AS latest_batch FROM ({EVENT_DAYS_SQL})
    """,
)
def data_state(tables: Tables) -> DataFrame:
    return op.data_state(event_days(tables), "batch_key")


@query(
    "batch_stats",
    f"""
    SELECT batch_key, COUNT(*) AS record_count, MIN(ts) AS earliest_record, MAX(ts) AS latest_record,
           format('{{:,}}', COUNT(*)) AS formatted_count FROM ({EVENT_DAYS_SQL}) GROUP BY 1
    """,
)
def batch_stats(tables: Tables) -> DataFrame:
    return op.batch_stats(event_days(tables), "batch_key", "ts")


PREFIXES = {"red": "Red Parts", "blue": "Blue Parts", "small": "Small Parts", "large": "Large Parts"}


@query(
    "prefix_distribution",
    f"""
    SELECT CASE {" ".join(f"WHEN p_name LIKE '{prefix}%' THEN '{label}'" for prefix, label in PREFIXES.items())}
           ELSE 'Other Parts' END AS data_type, COUNT(*) AS record_count, format('{{:,}}', COUNT(*)) AS formatted_count
    FROM part GROUP BY 1
    """,
)
def prefix_distribution(tables: Tables) -> DataFrame:
    return op.prefix_distribution(tables["part"], "p_name", PREFIXES, "Other Parts")


@query(
    "load_total",
    """
    SELECT 'Total Records After Initial Load' AS metric, COUNT(*) AS value, format('{:,}', COUNT(*)) AS formatted_value
    FROM events
    UNION ALL
    SELECT 'Total Records After Incremental Load', COUNT(*), format('{:,}', COUNT(*)) FROM lineitem
    """,
)
def load_total(tables: Tables) -> DataFrame:
    first = op.load_total(tables["events"], F.lit(True))
    return first.unionByName(op.load_total(tables["lineitem"], F.lit(False)))


def outcomes_sql(by: str, group: str) -> str:
    return f"""
        SELECT {by} COUNT(*) AS loads, COUNT(*) FILTER (WHERE event_type <> 'error') AS successes,
               COUNT(*) FILTER (WHERE event_type = 'error') AS failures,
               CAST(SUM(CAST(value AS DECIMAL(19,4))) AS DECIMAL(28,4)) AS total_duration,
               CAST(SUM(CAST(value AS DECIMAL(19,4))) AS DOUBLE) / COUNT(*) AS mean_duration,
               CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE event_type <> 'error') / COUNT(*) AS success_rate
        FROM events {group}
    """


def _outcomes(tables: Tables, by: list[str]) -> DataFrame:
    """Events as an audit of loads: a user is a table, an error a failure, the value a duration."""
    duration = F.col("value").cast("decimal(19,4)")
    return op.load_outcomes(tables["events"], by, F.col("event_type") == "error", duration)


@query("load_outcomes", outcomes_sql("user_id,", "GROUP BY user_id"))
def load_outcomes(tables: Tables) -> DataFrame:
    return _outcomes(tables, ["user_id"])


@query("load_outcomes_total", outcomes_sql("", ""))
def load_outcomes_total(tables: Tables) -> DataFrame:
    return _outcomes(tables, [])


@query(
    "loaded_row_rate",
    "SELECT event_id, (user_id + 1) * 100 / nullif(value, 0.0) AS rows_per_second FROM events",
)
def loaded_row_rate(tables: Tables) -> DataFrame:
    rows = ((F.col("user_id") + 1) * 100).cast("double")
    return op.loaded_row_rate(tables["events"], ["event_id"], rows, F.col("value"))
