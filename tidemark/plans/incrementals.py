"""Incremental loads."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.watermarks import batch_key, parse_integer, parse_number, parse_timestamp
from tidemark.operators import incremental as op
from tidemark.operators.coerce import coerce
from tidemark.operators.load import Dataset
from tidemark.operators.state import load_states
from tidemark.plans.registry import Tables, query
from tidemark.spec import Incremental, TableSpec

LOADED_SHARE = 0.8


def _loaded_bound(tables: Tables):
    """Last key of an earlier load of orders."""
    return (tables["orders"].agg(F.max("o_orderkey")).scalar() * LOADED_SHARE).cast("bigint")


LOADED_BOUND_SQL = "(SELECT CAST(floor(MAX(o_orderkey) * 0.8) AS BIGINT) FROM orders)"


@query(
    "batch_totals_after_watermark",
    f"""
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS batch_key, COUNT(*) AS row_count,
           MIN(o_orderkey) AS min_key, MAX(o_orderkey) AS max_key,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(19,4))) AS DECIMAL(38,4)) AS total
    FROM orders WHERE o_orderkey > {LOADED_BOUND_SQL} GROUP BY 1
    """,
)
def batch_totals_after_watermark(tables: Tables) -> DataFrame:
    """Read past the watermark, coerce, total by batch."""
    rows = op.since(tables["orders"], Incremental("o_orderkey", 0, "sequence"), last=_loaded_bound(tables))
    typed = coerce(rows, {"o_totalprice": "money"})
    return typed.groupBy(batch_key(F.col("o_orderdate")).alias("batch_key")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderkey").alias("min_key"),
        F.max("o_orderkey").alias("max_key"),
        F.sum("o_totalprice").cast("decimal(38,4)").alias("total"),
    )


@query("incr_timestamp", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def incr_timestamp(tables: Tables) -> DataFrame:
    return op.since(tables["events"], Incremental("ts", "2024-01-15T00:00:00Z"))


@query("incr_sequence", f"SELECT * FROM orders WHERE o_orderkey > {LOADED_BOUND_SQL}")
def incr_sequence(tables: Tables) -> DataFrame:
    return op.since(tables["orders"], Incremental("o_orderkey", 0, "sequence"), last=_loaded_bound(tables))


@query("incr_custom", "SELECT * FROM customer WHERE c_name > 'Customer#000000099'")
def incr_custom(tables: Tables) -> DataFrame:
    return op.since(tables["customer"], Incremental("c_name", "Customer#000000099", "custom"))


@query(
    "parse_watermark_text",
    """
    WITH src AS (
        SELECT event_id, CASE event_type
            WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
            WHEN 'click' THEN strftime(ts, '%b %-d, %Y')
            WHEN 'signup' THEN CAST(event_id AS VARCHAR)
            WHEN 'purchase' THEN CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)
            ELSE CASE WHEN value > 5 THEN 'not_a_number' END END AS watermark_text
        FROM events
    )
    SELECT event_id, watermark_text,
           coalesce(CASE WHEN watermark_text LIKE '%Z' THEN TRY_CAST(watermark_text AS TIMESTAMP) END,
                    try_strptime(watermark_text, '%b %d, %Y'),
                    CASE WHEN regexp_full_match(watermark_text, '\\d{8}') THEN try_strptime(watermark_text, '%Y%m%d') END
           ) AS as_timestamp,
           CASE WHEN regexp_full_match(watermark_text, '\\d+') THEN TRY_CAST(watermark_text AS BIGINT) END AS as_integer,
           CASE WHEN regexp_full_match(watermark_text, '[0-9.]+') THEN TRY_CAST(watermark_text AS DOUBLE) END AS as_number,
           coalesce(watermark_text = 'not_a_number', FALSE) AS unparsable
    FROM src
    """,
)
def parse_watermark_text(tables: Tables) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "click", F.date_format("ts", "MMM d, yyyy"))
        .when(kind == "signup", F.col("event_id").cast("string"))
        .when(kind == "purchase", F.col("value").cast("decimal(10,2)").cast("string"))
        .when(F.col("value") > 5, "not_a_number")
    )
    rows = tables["events"].select("event_id", text.alias("watermark_text"))
    value = F.col("watermark_text")
    rows = rows.withColumns(
        {"as_timestamp": parse_timestamp(value), "as_integer": parse_integer(value), "as_number": parse_number(value)}
    )
    known = F.coalesce("as_timestamp", F.lit(None).cast("timestamp_ntz")).isNotNull() | F.col("as_number").isNotNull()
    return rows.withColumn("unparsable", value.isNotNull() & ~known)


@query(
    "watermark_advance",
    """
    SELECT table_name, CAST(watermark AS VARCHAR) AS watermark FROM (
        SELECT 'orders' AS table_name, MAX(o_orderkey) AS watermark FROM orders
        UNION ALL SELECT 'events', MAX(CAST(strftime(ts, '%Y%m%d') AS INT)) FROM events
        UNION ALL SELECT 'nothing_new', 20240101)
    """,
)
def watermark_advance(tables: Tables) -> DataFrame:
    orders = op.advance(tables["orders"], "o_orderkey", F.lit(0))
    events = tables["events"].select(batch_key(F.col("ts")).alias("batch_key"))
    none = op.advance(events.where("batch_key > 99990101"), "batch_key", F.lit(20240101))
    frames = {"orders": orders, "events": op.advance(events, "batch_key", F.lit(0)), "nothing_new": none}
    rows = [
        frame.select(F.lit(name).alias("table_name"), F.col("watermark").cast("string").alias("watermark"))
        for name, frame in frames.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "boundary_dedup",
    """
    WITH bound AS (SELECT MAX(o_orderdate) AS d FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30')
    SELECT o.* FROM orders o, bound
    WHERE o.o_orderdate >= d AND NOT (o.o_orderdate = d AND o.o_orderstatus <> 'P')
    """,
)
def boundary_dedup(tables: Tables) -> DataFrame:
    """The earlier load got only part of the rows of its last day."""
    orders = tables["orders"]
    last = orders.where("o_orderdate <= TIMESTAMP_NTZ '1998-06-30'").agg(F.max("o_orderdate"))
    target = orders.where((F.col("o_orderdate") < last.scalar()) | (F.col("o_orderstatus") != "P"))
    rows = op.since(orders, Incremental("o_orderdate", "1990-01-01"), last=last.scalar())
    return op.drop_loaded_boundary(rows, target, "o_orderdate", last.scalar(), ["o_orderkey"])


EVENT_DAYS_SQL = "SELECT *, CAST(strftime(ts, '%Y%m%d') AS INT) AS batch_key FROM events"


def event_days(tables: Tables) -> DataFrame:
    return tables["events"].withColumn("batch_key", batch_key(F.col("ts")))


@query(
    "detect_new_batches",
    f"""
    WITH e AS ({EVENT_DAYS_SQL})
    SELECT DISTINCT batch_key FROM e
    WHERE batch_key NOT IN (SELECT batch_key FROM e WHERE ts < TIMESTAMP '2024-01-21' AND event_type <> 'error')
    """,
)
def detect_new_batches(tables: Tables) -> DataFrame:
    days = event_days(tables)
    loaded = days.where("ts < TIMESTAMP_NTZ '2024-01-21' AND event_type <> 'error'")
    return op.new_batches(days, loaded, "batch_key")


@query(
    "next_batch_rows",
    f"""
    WITH e AS ({EVENT_DAYS_SQL}), last AS (SELECT MAX(ts) AS t FROM e WHERE ts < TIMESTAMP '2024-01-14')
    SELECT * FROM e
    WHERE batch_key = (SELECT CAST(strftime(CAST(t AS DATE) + INTERVAL 1 DAY, '%Y%m%d') AS INT) FROM last)
    """,
)
def next_batch_rows(tables: Tables) -> DataFrame:
    days = event_days(tables)
    return op.next_batch(days, days.where("ts < TIMESTAMP_NTZ '2024-01-14'"), "batch_key")


@query(
    "next_batch_rows_initial",
    f"""
    WITH e AS ({EVENT_DAYS_SQL})
    SELECT * FROM e WHERE batch_key IN (SELECT DISTINCT batch_key FROM e ORDER BY batch_key LIMIT 3)
    """,
)
def next_batch_rows_initial(tables: Tables) -> DataFrame:
    days = event_days(tables)
    return op.next_batch(days, days.where("batch_key < 0"), "batch_key")


@query(
    "incr_append_run",
    f"""
    SELECT event_id, user_id, batch_key, CAST(value AS DECIMAL(19,4)) AS value,
           CASE WHEN batch_key <= 20240120 THEN 'run-1' ELSE 'run-2' END AS _load_id
    FROM ({EVENT_DAYS_SQL})
    """,
)
def incr_append_run(tables: Tables) -> DataFrame:
    """Three runs: the source up to a day, then all of it, then nothing new."""
    dataset, days = Dataset(tables.spark), event_days(tables)
    spec = TableSpec(
        "events",
        disposition="append",
        incremental=Incremental("batch_key", 0, "sequence"),
        columns=("event_id", "user_id", "batch_key", "value"),
        source_types={"value": "money"},
    )
    early = days.where("batch_key <= 20240120")
    op.run_load(dataset, spec, "run-1", "2024-01-21", events=early)
    op.run_load(dataset, spec, "run-2", "2024-01-31", events=days)
    op.run_load(dataset, spec, "run-3", "2024-02-01", events=days)
    return dataset.read("events").drop("_loaded_at")


@query(
    "incr_merge_run",
    """
    SELECT user_id, event_id, ts, event_type, CAST(value AS DECIMAL(19,4)) AS value FROM events
    WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-05'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def incr_merge_run(tables: Tables) -> DataFrame:
    """Latest accepted event of each user, kept by two merging runs."""
    dataset, events = Dataset(tables.spark), tables["events"]
    spec = TableSpec(
        "events",
        destination="last_event",
        disposition="merge",
        primary_key=("user_id",),
        order_by=("ts", "event_id"),
        where="event_type <> 'error'",
        incremental=Incremental("ts", "2024-01-05T00:00:00"),
        columns=("user_id", "event_id", "ts", "event_type", "value"),
        source_types={"value": "money"},
    )
    op.run_load(dataset, spec, "run-1", "2024-01-21", events=events.where("ts < TIMESTAMP_NTZ '2024-01-21'"))
    op.run_load(dataset, spec, "run-2", "2024-01-31", events=events)
    return dataset.read("last_event").select(*spec.columns)


@query(
    "env_subset_load",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(19,4)) AS o_totalprice,
           o_orderdate, o_orderpriority, 'dev' AS _load_id
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND (o_orderstatus = 'O' OR o_orderstatus IS NULL)
    """,
)
def env_subset_load(tables: Tables) -> DataFrame:
    """A development run: the spec of the full load with a filter and a later start."""
    full = TableSpec(
        "orders",
        disposition="append",
        primary_key=("o_orderkey",),
        incremental=Incremental("o_orderdate", "1990-01-01"),
        source_types={"o_totalprice": "money"},
    )
    dev = replace(
        full, where="o_orderstatus = 'O' OR o_orderstatus IS NULL", incremental=Incremental("o_orderdate", "1998-01-01")
    )
    dataset = Dataset(tables.spark)
    op.run_load(dataset, dev, "dev", "2024-02-01", orders=tables["orders"])
    return dataset.read("orders").drop("_loaded_at")


# Whole days and two columns: very many rows are equal, and the bound of a run is a whole day.
VISIT_SQL = "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type FROM events"


def visits(tables: Tables) -> DataFrame:
    return tables["events"].select(F.to_date("ts").cast("timestamp_ntz").alias("day"), "event_type")


def _appended_visits(tables: Tables, lookback: str | None) -> DataFrame:
    dataset, rows = Dataset(tables.spark), visits(tables)
    spec = TableSpec(
        "visits", disposition="append", incremental=Incremental("day", "2024-01-05T00:00:00"), columns=("day", "event_type")
    )
    early = rows.where("day <= TIMESTAMP_NTZ '2024-01-20'")
    for number, frame in enumerate((early, rows, rows)):
        op.run_load(dataset, spec, f"run-{number}", "2024-02-01", lookback, visits=frame)
    return dataset.read("visits").select("day", "event_type")


@query("incr_append_timestamp", f"SELECT * FROM ({VISIT_SQL}) WHERE day >= TIMESTAMP '2024-01-05'")
def incr_append_timestamp(tables: Tables) -> DataFrame:
    """Three runs without a key: rows at the bound are read again, and none is added twice or lost."""
    return _appended_visits(tables, None)


@query(
    "incr_append_lookback",
    f"SELECT * FROM ({VISIT_SQL}) WHERE day >= TIMESTAMP '2024-01-02'",
)
def incr_append_lookback(tables: Tables) -> DataFrame:
    """The same, reading three days before the bound in each run, the first one too."""
    return _appended_visits(tables, "3 days")


@query("load_replace_incremental", "SELECT o_orderkey, o_custkey FROM orders")
def load_replace_incremental(tables: Tables) -> DataFrame:
    """Two runs that replace, with a watermark that must not cut off older rows."""
    dataset, orders = Dataset(tables.spark), tables["orders"]
    spec = TableSpec("orders", incremental=Incremental("o_orderkey", 0, "sequence"), columns=("o_orderkey", "o_custkey"))
    op.run_load(dataset, spec, "run-1", "2024-02-01", orders=orders.where("o_orderkey <= 500"))
    op.run_load(dataset, spec, "run-2", "2024-02-02", orders=orders)
    return dataset.read("orders").select("o_orderkey", "o_custkey")


@query(
    "load_two_sources",
    """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey <= 500 THEN 'run-1' ELSE 'run-2' END AS _load_id FROM orders
    """,
)
def load_two_sources(tables: Tables) -> DataFrame:
    """Two sources fill one table under the same load ids, each with its own watermark; a run is repeated."""
    dataset, orders = Dataset(tables.spark), tables["orders"].select("o_orderkey", "o_orderstatus")
    specs = [
        TableSpec(name, "orders", "append", ("o_orderkey",), incremental=Incremental("o_orderkey", -1, "sequence"))
        for name in ("finished", "others")
    ]
    for run, upto in (("run-1", 500), ("run-2", None), ("run-2", None)):
        known = orders.where(F.col("o_orderkey") <= upto) if upto else orders
        for spec in specs:
            rows = known.where("o_orderstatus = 'F'" if spec.source == "finished" else "o_orderstatus <> 'F'")
            op.run_load(dataset, spec, run, "2024-02-01", **{spec.source: rows})
    return dataset.read("orders").select("o_orderkey", "o_orderstatus", "_load_id")


@query(
    "watermark_state",
    """
    WITH runs(run, upto) AS (VALUES ('run-1', 20240110), ('run-2', 20240120), ('run-3', 20240120), ('run-4', 99999999)),
    days AS (SELECT user_id, ts, CAST(strftime(ts, '%Y%m%d') AS INT) AS batch_key FROM events),
    bounds AS (SELECT run, upto, (SELECT MAX(batch_key) FROM days WHERE batch_key <= upto) AS bound FROM runs),
    steps AS (SELECT *, lag(bound) OVER (ORDER BY run) AS began FROM bounds)
    SELECT 'visits' AS destination, run AS load_id, CAST(began AS VARCHAR) AS began, CAST(bound AS VARCHAR) AS bound,
           (SELECT COUNT(*) FROM days WHERE batch_key > coalesce(began, 0) AND batch_key <= bound) AS rows
    FROM steps
    UNION ALL
    SELECT 'last_visit', run, CAST(began AS VARCHAR), CAST(bound AS VARCHAR),
           (SELECT COUNT(DISTINCT user_id) FROM days WHERE batch_key > coalesce(began, 0) AND batch_key <= bound)
    FROM steps
    """,
)
def watermark_state(tables: Tables) -> DataFrame:
    """What is kept of four runs, the third without new rows, that append to one table and merge into another."""
    dataset, days = Dataset(tables.spark), event_days(tables)
    mark = Incremental("batch_key", 0, "sequence")
    specs = (
        TableSpec("events", "visits", "append", incremental=mark, columns=("user_id", "ts", "batch_key")),
        TableSpec(
            "events", "last_visit", "merge", ("user_id",), ("ts",), incremental=mark, columns=("user_id", "ts", "batch_key"),
            merge_on_read=True,
        ),
    )
    for number, upto in enumerate((20240110, 20240120, 20240120, 99999999), 1):
        for spec in specs:
            op.run_load(dataset, spec, f"run-{number}", "2024-02-01", events=days.where(F.col("batch_key") <= upto))
    return load_states(dataset).select("destination", "load_id", "began", "bound", "rows")
