"""Write dispositions and runs over several tables. Destinations are written to the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.watermarks import batch_key
from tidemark.operators.coerce import coerce
from tidemark.operators.delta import compact, merge_delta
from tidemark.operators.incremental import run_load
from tidemark.operators.keys import latest_per_key
from tidemark.operators.layout import pack_loads
from tidemark.operators.load import Dataset, load_selected, stamp
from tidemark.plans.registry import Tables, query
from tidemark.sources.scan import scan
from tidemark.spec import Incremental, TableSpec


@query(
    "load_replace",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal * 2 AS c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 0
    """,
)
def load_replace(tables: Tables) -> DataFrame:
    dataset = Dataset(tables.spark)
    dataset.replace("customer", tables["customer"])
    # The new rows come from the table that is replaced.
    kept = dataset.read("customer").where("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    dataset.replace("customer", kept)
    return dataset.read("customer")


@query("load_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def load_append(tables: Tables) -> DataFrame:
    dataset = Dataset(tables.spark)
    dataset.append("orders", tables["orders"])
    dataset.append("orders", tables["orders"])
    return dataset.read("orders")


# Updates: customers of one nation with more on their accounts, and suppliers as new customers.
CUSTOMER_UPDATES_SQL = """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
    FROM customer WHERE c_nationkey = 3
    UNION ALL
    SELECT s_suppkey + 1 + (SELECT MAX(c_custkey) FROM customer), s_name, s_nationkey, s_acctbal, 'SUPPLY'
    FROM supplier
"""


def customer_updates(tables: Tables) -> DataFrame:
    known = tables["customer"].where("c_nationkey = 3").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    highest = tables["customer"].agg(F.max("c_custkey")).scalar()
    new = tables["supplier"].select(
        (F.col("s_suppkey") + 1 + highest).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLY").alias("c_mktsegment"),
    )
    return known.unionByName(new)


@query(
    "load_merge",
    f"""
    WITH u AS ({CUSTOMER_UPDATES_SQL})
    SELECT * FROM u UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM u)
    """,
)
def load_merge(tables: Tables) -> DataFrame:
    dataset = Dataset(tables.spark)
    dataset.replace("customer", tables["customer"])
    dataset.merge("customer", customer_updates(tables), ["c_custkey"])
    return dataset.read("customer")


@query(
    "load_merge_orders",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 100 ELSE o_totalprice END
           AS o_totalprice, o_orderdate, o_orderpriority FROM orders
    UNION ALL
    SELECT c_custkey + 1 + (SELECT MAX(o_orderkey) FROM orders), c_custkey, 'N', c_acctbal, TIMESTAMP '2024-01-01', '0-NEW'
    FROM customer
    """,
)
def load_merge_orders(tables: Tables) -> DataFrame:
    """Open orders get dearer, and every customer places one more."""
    dataset = Dataset(tables.spark)
    dataset.replace("orders", tables["orders"])
    dearer = tables["orders"].where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 100)
    highest = tables["orders"].agg(F.max("o_orderkey")).scalar()
    placed = tables["customer"].select(
        (F.col("c_custkey") + 1 + highest).alias("o_orderkey"),
        F.col("c_custkey").alias("o_custkey"),
        F.lit("N").alias("o_orderstatus"),
        F.col("c_acctbal").alias("o_totalprice"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("0-NEW").alias("o_orderpriority"),
    )
    dataset.merge("orders", dearer.unionByName(placed), ["o_orderkey"], ["o_orderdate"])
    return dataset.read("orders")


@query(
    "load_merge_partitioned",
    """
    SELECT CAST(strftime(ts, '%Y%m%d') AS INT) AS batch_key, event_id, user_id,
           CASE WHEN ts >= TIMESTAMP '2024-01-29' THEN 'seen' ELSE event_type END AS event_type
    FROM events
    """,
)
def load_merge_partitioned(tables: Tables) -> DataFrame:
    """A table by day, in which a merge rewrites the days it touches."""
    dataset = Dataset(tables.spark)
    rows = tables["events"].select(batch_key(F.col("ts")).alias("batch_key"), "event_id", "user_id", "event_type")
    keys = ["batch_key", "event_id"]
    dataset.merge("events", rows.where("batch_key < 20240130"), keys, partition_by=["batch_key"])
    late = rows.where("batch_key >= 20240129").withColumn("event_type", F.lit("seen"))
    dataset.merge("events", late, keys, partition_by=["batch_key"])
    return dataset.read("events")


LOAD_MERGE_DELTA_SQL = f"""
    WITH u AS ({CUSTOMER_UPDATES_SQL}),
    once AS (SELECT * FROM u UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM u))
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment
    FROM once
"""


def merged_customers(tables: Tables, compacted: bool = False) -> DataFrame:
    """Customers, then updates, then debtors, each merge writing its own rows; the second one is run twice."""
    dataset = Dataset(tables.spark)
    merge_delta(dataset, "customer", tables["customer"], ["c_custkey"], load_id="all")
    for _ in range(2):
        merge_delta(dataset, "customer", customer_updates(tables), ["c_custkey"], load_id="updates")
    if compacted:
        compact(dataset, "customer")
    debtors = dataset.read("customer").where("c_acctbal < 0").withColumn("c_mktsegment", F.lit("DEBT"))
    merge_delta(dataset, "customer", debtors, ["c_custkey"], load_id="debtors")
    if compacted:
        compact(dataset, "customer")
    return dataset.read("customer")


@query("load_merge_delta", LOAD_MERGE_DELTA_SQL)
def load_merge_delta(tables: Tables) -> DataFrame:
    return merged_customers(tables)


@query("load_compact", LOAD_MERGE_DELTA_SQL)
def load_compact(tables: Tables) -> DataFrame:
    """The same with the changes folded into the base in between and at the end."""
    return merged_customers(tables, compacted=True)


EVOLVED_SQL = """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
           CAST(o_totalprice AS DECIMAL(19,4)) AS o_totalprice,
           CASE WHEN o_orderkey > {cut} THEN o_orderpriority END AS o_orderpriority
    FROM orders
"""


def _evolving(tables: Tables, disposition: str, **options) -> DataFrame:
    """A first load with narrow types and without a column, then one of the rest as it is in the source."""
    dataset, orders = Dataset(tables.spark), tables["orders"]
    cut = orders.agg((F.max("o_orderkey") / 2).cast("int")).scalar()
    narrow = orders.where(F.col("o_orderkey") <= cut).select(
        F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int"), F.col("o_totalprice").cast("decimal(12,2)")
    )
    wide = orders.where(F.col("o_orderkey") > cut).select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(19,4)"), "o_orderpriority"
    )
    spec = TableSpec(
        "orders", disposition=disposition, primary_key=("o_orderkey",), incremental=Incremental("o_orderkey", -1, "sequence"),
        evolve=True, **options,
    )
    for number, rows in enumerate((narrow, wide, wide)):
        run_load(dataset, spec, f"run-{min(number, 1)}", "2024-02-01", orders=rows)
    return dataset.read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


_HALF = "(SELECT CAST(floor(MAX(o_orderkey) / 2) AS INT) FROM orders)"


@query("load_evolved", EVOLVED_SQL.format(cut=_HALF))
def load_evolved(tables: Tables) -> DataFrame:
    """The older partitions are read as the wider types; nothing is rewritten."""
    return _evolving(tables, "append")


@query("load_evolved_merge", EVOLVED_SQL.format(cut=_HALF))
def load_evolved_merge(tables: Tables) -> DataFrame:
    return _evolving(tables, "merge", merge_on_read=True)


@query(
    "load_compact_append",
    """
    WITH d AS (SELECT event_id, user_id, CAST(strftime(ts, '%Y%m%d') AS INT) AS batch_key FROM events)
    SELECT event_id, user_id, batch_key, 'to-' || CAST(CASE WHEN batch_key <= 20240105 THEN 20240105 WHEN batch_key <= 20240110
           THEN 20240110 WHEN batch_key <= 20240115 THEN 20240115 WHEN batch_key <= 20240120 THEN 20240120 ELSE 20249999 END
           AS VARCHAR) AS _load_id FROM d
    """,
)
def load_compact_append(tables: Tables) -> DataFrame:
    """Five loads, packed by day after the third and after the last, which is run again between and afterwards."""
    dataset = Dataset(tables.spark)
    days = tables["events"].select("event_id", "user_id", batch_key(F.col("ts")).alias("batch_key"))
    spec = TableSpec("events", disposition="append", incremental=Incremental("batch_key", 0, "sequence"))
    for upto in (20240105, 20240110, 20240115, 20240120, 20249999):
        for _ in range(2 if upto == 20249999 else 1):
            run_load(dataset, spec, f"to-{upto}", "2024-02-01", events=days.where(F.col("batch_key") <= upto))
        if upto in (20240115, 20249999):
            pack_loads(dataset, "events", ["batch_key"])
    run_load(dataset, spec, "to-20249999", "2024-02-01", events=days)
    return dataset.read("events").drop("_loaded_at")


@query(
    "merge_dedup_batch",
    """
    SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def merge_dedup_batch(tables: Tables) -> DataFrame:
    return latest_per_key(tables["orders"], ["o_custkey"], ["o_orderdate", "o_orderkey"])


STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(
    "load_selected_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'success' AS status, COUNT(*) AS row_count FROM {name}"
        for name in STAR_TABLES
        if name != "region"
    ),
)
def load_selected_tables(tables: Tables) -> DataFrame:
    dataset = Dataset(tables.spark)

    def load_one(spec: TableSpec) -> int:
        dataset.replace(spec.target, scan(tables.spark, spec))
        return dataset.read(spec.target).count()

    specs = {
        name: TableSpec(f"{tables.folder}/{name}.parquet", enabled=name != "region") for name in STAR_TABLES
    }
    return load_selected(tables.spark, specs, load_one).select("table_name", "status", "row_count")


@query(
    "load_stamp",
    """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(19,4)) AS o_totalprice, 'load-0001' AS _load_id,
           TIMESTAMP '2024-02-01 06:00:00' AS _loaded_at, 'batch-7' AS batch_process_id
    FROM orders
    """,
)
def load_stamp(tables: Tables) -> DataFrame:
    rows = coerce(tables["orders"].select("o_orderkey", "o_totalprice"), {"o_totalprice": "money"})
    return stamp(rows, "load-0001", "2024-02-01 06:00:00", batch_process_id="batch-7")
