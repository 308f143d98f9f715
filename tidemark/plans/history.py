"""Type-2 history built from events: key user_id, attribute status, the type of the last event."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import scd2 as op
from tidemark.operators import scd2_checks as check
from tidemark.operators.load import Dataset
from tidemark.operators.scd2_late import repeated_changes
from tidemark.operators.scd2_load import apply_late_changes, current_table, keep_late, load_batch, start_dimension
from tidemark.plans.registry import Tables, query

KEYS, ATTRIBUTES = ["user_id"], ["status"]
BATCH_DAY = "2024-01-30"
# Small enough to cut the keys of any test table into slices.
FEW_ROWS = 20


def versions_sql(source: str = "events") -> str:
    """All versions of a change history."""
    return f"""
        SELECT user_id, event_type AS status, ts AS effective_from,
               lead(ts) OVER w - INTERVAL 1 SECOND AS effective_to, lead(ts) OVER w IS NULL AS is_latest,
               CAST(strftime(ts, '%Y%m%d') AS INT) AS batch_key,
               CASE WHEN first_row THEN 'INSERT' ELSE 'UPDATE' END AS change_type,
               CASE WHEN first_row THEN 'Initial client load' ELSE 'Changed: status' END AS change_reason,
               CASE WHEN first_row AND lead(ts) OVER w IS NULL THEN 'SCD2_ETL_INITIAL' ELSE 'SCD2_ETL_UPDATE' END
                   AS modified_by
        FROM (SELECT *, row_number() OVER h = 1 AS first_row, lag(event_type) OVER h AS before FROM {source}
              WINDOW h AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE first_row OR before IS DISTINCT FROM event_type
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """


DIM = f"dim AS ({versions_sql()})"


def status_history(tables: Tables) -> DataFrame:
    return tables["events"].select("user_id", F.col("event_type").alias("status"), "ts", "event_id")


def dimension(tables: Tables, before: str | None = None, **options) -> DataFrame:
    history = status_history(tables)
    if before:
        history = history.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    return op.build_versions(history, KEYS, ATTRIBUTES, "ts", ["event_id"], **options)


@query("scd2_build", f"WITH {DIM} SELECT * FROM dim")
def scd2_build(tables: Tables) -> DataFrame:
    return dimension(tables)


@query("scd2_build_sliced", f"WITH {DIM} SELECT * FROM dim")
def scd2_build_sliced(tables: Tables) -> DataFrame:
    """The same with keys treated as hot and cut into slices."""
    return dimension(tables, rows_per_group=FEW_ROWS)


TIED_SQL = "(SELECT user_id, event_type, TIMESTAMP '2024-01-01' AS ts, event_id FROM events)"


@query("scd2_build_tied", f"WITH dim AS ({versions_sql(TIED_SQL)}) SELECT * FROM dim")
def scd2_build_tied(tables: Tables) -> DataFrame:
    """All changes at one time, told apart by their ids alone, with keys cut into slices between them."""
    history = status_history(tables).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    return op.build_versions(history, KEYS, ATTRIBUTES, "ts", ["event_id"], rows_per_group=FEW_ROWS)


@query(
    "scd2_initial",
    """
    SELECT c_custkey, c_mktsegment, c_acctbal, TIMESTAMP '2024-01-01' AS effective_from,
           CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_latest, 20240101 AS batch_key,
           'INSERT' AS change_type, 'Initial client load' AS change_reason, 'SCD2_ETL_INITIAL' AS modified_by
    FROM customer
    """,
)
def scd2_initial(tables: Tables) -> DataFrame:
    return op.initial_versions(tables["customer"], ["c_custkey"], ["c_mktsegment", "c_acctbal"], "2024-01-01")


def last_day(tables: Tables) -> op.Batch:
    """The dimension before the last day, and the changes of that day, with suppliers as new keys."""
    history = status_history(tables)
    highest = tables["events"].agg(F.max("user_id")).scalar()
    new = tables["supplier"].select(
        (F.col("s_suppkey") + 1 + highest).alias("user_id"),
        F.lit("signup").alias("status"),
        F.lit(BATCH_DAY).cast("timestamp_ntz").alias("ts"),
        F.col("s_suppkey").alias("event_id"),
    )
    changes = history.where(F.col("ts") >= F.lit(BATCH_DAY).cast("timestamp_ntz")).unionByName(new)
    return op.Batch(
        dimension(tables, before=BATCH_DAY), changes, KEYS, ATTRIBUTES, as_of=BATCH_DAY, order=["ts", "event_id"]
    )


BATCH = f"""
    dim AS ({versions_sql(f"(SELECT * FROM events WHERE ts < TIMESTAMP '{BATCH_DAY}')")}),
    chg AS (
        SELECT user_id, event_type AS status FROM events WHERE ts >= TIMESTAMP '{BATCH_DAY}'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
        UNION ALL SELECT s_suppkey + 1 + (SELECT MAX(user_id) FROM events), 'signup' FROM supplier
    ),
    hit AS (SELECT d.user_id, c.status FROM dim d JOIN chg c USING (user_id) WHERE d.is_latest AND d.status <> c.status),
    closed AS (
        SELECT d.* REPLACE (
            CASE WHEN h.user_id IS NULL THEN d.effective_to ELSE TIMESTAMP '{BATCH_DAY}' - INTERVAL 1 SECOND END AS effective_to,
            d.is_latest AND h.user_id IS NULL AS is_latest,
            CASE WHEN h.user_id IS NULL THEN d.modified_by ELSE 'SCD2_ETL_UPDATE' END AS modified_by)
        FROM dim d LEFT JOIN hit h ON d.user_id = h.user_id AND d.is_latest
    ),
    opened AS (
        SELECT user_id, status, TIMESTAMP '{BATCH_DAY}' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
               TRUE AS is_latest, 20240130 AS batch_key, 'UPDATE' AS change_type, 'Changed: status' AS change_reason,
               'SCD2_ETL_UPDATE' AS modified_by FROM hit
    ),
    added AS (
        SELECT user_id, status, TIMESTAMP '{BATCH_DAY}' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
               TRUE AS is_latest, 20240130 AS batch_key, 'INSERT' AS change_type, 'New client onboarding' AS change_reason,
               'SCD2_ETL_NEW' AS modified_by FROM chg WHERE user_id NOT IN (SELECT user_id FROM dim)
    )
"""


@query("scd2_close", f"WITH {BATCH} SELECT * FROM closed")
def scd2_close(tables: Tables) -> DataFrame:
    return op.close_versions(last_day(tables))


@query("scd2_new_version", f"WITH {BATCH} SELECT * FROM opened")
def scd2_new_version(tables: Tables) -> DataFrame:
    return op.new_versions(last_day(tables))


@query("scd2_new_entities", f"WITH {BATCH} SELECT * FROM added")
def scd2_new_entities(tables: Tables) -> DataFrame:
    return op.new_entities(last_day(tables))


@query(
    "scd2_apply",
    f"WITH {BATCH} SELECT * FROM closed UNION ALL SELECT * FROM opened UNION ALL SELECT * FROM added",
)
def scd2_apply(tables: Tables) -> DataFrame:
    return op.apply_changes(last_day(tables))


LAST_DAYS = ("2024-01-28", "2024-01-29", "2024-01-30")
CORE = ["user_id", "status", "effective_from", "effective_to", "is_latest", "change_type"]
DAILY_SQL = f"""(
    SELECT user_id, event_type, ts, event_id FROM events WHERE ts < TIMESTAMP '{LAST_DAYS[0]}'
    UNION ALL (
        SELECT user_id, event_type, date_trunc('day', ts), event_id FROM events WHERE ts >= TIMESTAMP '{LAST_DAYS[0]}'
        QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) = 1))
"""


@query("scd2_load_batches", f"WITH dim AS ({versions_sql(DAILY_SQL)}) SELECT {', '.join(CORE)} FROM dim")
def scd2_load_batches(tables: Tables) -> DataFrame:
    """A dimension published, then three daily batches loaded into it, the last one twice."""
    dataset, history = Dataset(tables.spark), status_history(tables)
    start_dimension(dataset, "dim", dimension(tables, before=LAST_DAYS[0]))
    for day in (*LAST_DAYS, LAST_DAYS[-1]):
        changes = history.where(F.to_date("ts") == F.lit(day).cast("date"))
        current = current_table(dataset, "dim")
        batch = op.Batch(current, changes, KEYS, ATTRIBUTES, as_of=day, order=["ts", "event_id"])
        load_batch(dataset, "dim", f"day-{day}", batch)
    return dataset.read("dim").select(*CORE)


@query(
    "scd2_late_changes",
    f"""
    WITH {DIM}
    SELECT user_id, 'late' AS status FROM dim WHERE is_latest AND effective_from >= TIMESTAMP '2024-01-09'
    """,
)
def scd2_late_changes(tables: Tables) -> DataFrame:
    """A batch as of a day before the current versions of many keys: those changes are kept aside."""
    dataset = Dataset(tables.spark)
    start_dimension(dataset, "dim", dimension(tables))
    changes = tables["events"].select("user_id").distinct().withColumns(
        {"status": F.lit("late"), "ts": F.lit("2024-01-09").cast("timestamp_ntz"), "event_id": F.lit(0).cast("bigint")}
    )
    for _ in range(2):
        batch = op.Batch(current_table(dataset, "dim"), changes, KEYS, ATTRIBUTES, as_of="2024-01-09", order=["ts", "event_id"])
        load_batch(dataset, "dim", "late-day", batch)
    return dataset.read("dim_late").select("user_id", "status")


@query("scd2_apply_late", f"WITH {DIM} SELECT {', '.join(CORE)}, change_reason, modified_by FROM dim")
def scd2_apply_late(tables: Tables) -> DataFrame:
    """A dimension built without the errors, then all errors, which come late, the later half of them first."""
    dataset, history = Dataset(tables.spark), status_history(tables)
    in_time = history.where("status <> 'error'")
    names = (KEYS, ATTRIBUTES, "ts", ["event_id"])
    start_dimension(dataset, "dim", op.build_versions(in_time, *names), repeats=repeated_changes(in_time, *names))
    errors = history.where("status = 'error'")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for load_id, late in (("second half", errors.where(F.col("ts") >= middle)), ("first half", errors.where(F.col("ts") < middle))):
        keep_late(dataset, "dim", load_id, late, KEYS, ATTRIBUTES, "ts")
        apply_late_changes(dataset, "dim", load_id, KEYS, ATTRIBUTES)
    return dataset.read("dim").select(*CORE, "change_reason", "modified_by")


@query(
    "scd2_change_detect",
    f"""
    WITH {BATCH}
    SELECT user_id, 'UPDATE' AS change_type, 'status' AS changed_attributes FROM opened
    UNION ALL SELECT user_id, 'INSERT', '' FROM added
    """,
)
def scd2_change_detect(tables: Tables) -> DataFrame:
    return op.detect_changes(last_day(tables))


@query("scd2_current", f"WITH {DIM} SELECT user_id, status, effective_from FROM dim WHERE is_latest")
def scd2_current(tables: Tables) -> DataFrame:
    return op.current_versions(dimension(tables)).select("user_id", "status", "effective_from")


@query("scd2_timeline", f"WITH {DIM} SELECT * FROM dim WHERE user_id = (SELECT MIN(user_id) FROM events)")
def scd2_timeline(tables: Tables) -> DataFrame:
    return op.timeline(dimension(tables), "user_id", tables["events"].agg(F.min("user_id")).scalar())


@query(
    "scd2_as_of",
    f"""
    WITH {DIM} SELECT user_id, status, effective_from, effective_to FROM dim
    WHERE effective_from <= TIMESTAMP '2024-01-15' AND (effective_to IS NULL OR effective_to > TIMESTAMP '2024-01-15')
    """,
)
def scd2_as_of(tables: Tables) -> DataFrame:
    return op.as_of(dimension(tables), "2024-01-15").select("user_id", "status", "effective_from", "effective_to")


@query(
    "scd2_effective_range",
    f"""
    WITH {DIM} SELECT user_id, status, effective_from, effective_to FROM dim
    WHERE effective_from >= TIMESTAMP '2024-01-10' AND (effective_to IS NULL OR effective_to <= TIMESTAMP '2024-01-20')
    """,
)
def scd2_effective_range(tables: Tables) -> DataFrame:
    rows = op.effective_within(dimension(tables), "2024-01-10", "2024-01-20")
    return rows.select("user_id", "status", "effective_from", "effective_to")


@query(
    "fact_join_current",
    f"""
    WITH {DIM} SELECT e.event_id, e.user_id, e.ts, e.value, d.status
    FROM events e JOIN dim d ON e.user_id = d.user_id WHERE d.is_latest
    """,
)
def fact_join_current(tables: Tables) -> DataFrame:
    facts = tables["events"].select("event_id", "user_id", "ts", "value")
    return op.join_current(facts, dimension(tables), KEYS, ATTRIBUTES)


# Facts a while after the events, so that they meet versions, gaps and open ends.
AS_OF_SQL = f"""
    WITH {DIM}, facts AS (SELECT event_id, user_id, value, ts + INTERVAL 90 MINUTE AS happened_at FROM events)
    SELECT f.*, d.status FROM facts f JOIN dim d ON f.user_id = d.user_id
    AND f.happened_at >= d.effective_from AND f.happened_at < coalesce(d.effective_to, TIMESTAMP '9999-12-31')
"""


def _join_as_of(tables: Tables, **options) -> DataFrame:
    happened = (F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("happened_at")
    facts = tables["events"].select("event_id", "user_id", "value", happened)
    return op.join_as_of(facts, dimension(tables), KEYS, "happened_at", ATTRIBUTES, **options)


@query("fact_join_as_of", AS_OF_SQL)
def fact_join_as_of(tables: Tables) -> DataFrame:
    return _join_as_of(tables)


@query("fact_join_as_of_lookup", AS_OF_SQL)
def fact_join_as_of_lookup(tables: Tables) -> DataFrame:
    """Versions as sorted arrays, looked up where the facts lie."""
    happened = (F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("happened_at")
    facts = tables["events"].select("event_id", "user_id", "value", happened)
    return op.join_as_of_lookup(facts, dimension(tables), KEYS, "happened_at", ATTRIBUTES)


@query("fact_join_as_of_sliced", AS_OF_SQL)
def fact_join_as_of_sliced(tables: Tables) -> DataFrame:
    return _join_as_of(tables, rows_per_group=FEW_ROWS)


@query(
    "fact_join_as_of_coarse",
    f"""
    WITH {DIM}, facts AS (SELECT event_id, user_id, value, date_trunc('day', ts) + INTERVAL 1 DAY AS happened_at FROM events)
    SELECT f.*, d.status FROM facts f JOIN dim d ON f.user_id = d.user_id
    AND f.happened_at >= d.effective_from AND f.happened_at < coalesce(d.effective_to, TIMESTAMP '9999-12-31')
    """,
)
def fact_join_as_of_coarse(tables: Tables) -> DataFrame:
    """Facts booked at the end of their day."""
    booked = F.date_add(F.to_date("ts"), 1).cast("timestamp_ntz").alias("happened_at")
    facts = tables["events"].select("event_id", "user_id", "value", booked)
    return op.join_as_of(facts, dimension(tables), KEYS, "happened_at", ATTRIBUTES, coarse_times=True)


@query("fact_left_join_as_of", AS_OF_SQL.replace("FROM facts f JOIN", "FROM facts f LEFT JOIN"))
def fact_left_join_as_of(tables: Tables) -> DataFrame:
    return _join_as_of(tables, how="left")


TREND_SQL = f"""
    WITH {DIM}
    SELECT user_id, effective_from, status,
           lag(status) OVER (PARTITION BY user_id ORDER BY effective_from) AS previous_status
    FROM dim WHERE change_type = 'UPDATE'
"""


@query("scd2_trend", TREND_SQL)
def scd2_trend(tables: Tables) -> DataFrame:
    return op.trend(dimension(tables), KEYS, ATTRIBUTES, F.col("change_type") == "UPDATE")


@query("scd2_trend_sliced", TREND_SQL)
def scd2_trend_sliced(tables: Tables) -> DataFrame:
    rows = dimension(tables)
    return op.trend(rows, KEYS, ATTRIBUTES, F.col("change_type") == "UPDATE", rows_per_group=FEW_ROWS)


# A dimension gone wrong: every event is an open current version.
OPEN_SQL = """
    open AS (SELECT user_id, event_id, ts AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
             TRUE AS is_latest FROM events)
"""


def all_open(tables: Tables) -> DataFrame:
    return tables["events"].select(
        "user_id",
        "event_id",
        F.col("ts").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_latest"),
    )


@query(
    "scd2_check_single_current",
    f"""
    WITH {OPEN_SQL}
    SELECT user_id, COUNT(*) AS current_versions FROM open WHERE is_latest GROUP BY 1 HAVING COUNT(*) > 1
    """,
)
def scd2_check_single_current(tables: Tables) -> DataFrame:
    return check.several_current(all_open(tables), KEYS)


# Versions that last half a day whatever follows.
HALF_DAY_SQL = """
    half AS (SELECT user_id, event_id, ts AS effective_from, ts + INTERVAL 12 HOUR AS effective_to FROM events)
"""


def half_days(tables: Tables) -> DataFrame:
    end = (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("effective_to")
    return tables["events"].select("user_id", "event_id", F.col("ts").alias("effective_from"), end)


def overlap_sql(name: str) -> str:
    return f"""
        SELECT a.user_id, a.event_id AS version_1, b.event_id AS version_2
        FROM {name} a JOIN {name} b ON a.user_id = b.user_id AND a.event_id <> b.event_id
        AND a.effective_from < coalesce(b.effective_to, TIMESTAMP '9999-12-31')
        AND coalesce(a.effective_to, TIMESTAMP '9999-12-31') > b.effective_from
    """


OVERLAP_COUNT_SQL = "SELECT user_id, version_1 AS event_id, COUNT(*) AS overlapping FROM p GROUP BY ALL"


@query("scd2_check_overlap", f"WITH {OPEN_SQL}, p AS ({overlap_sql('open')}) {OVERLAP_COUNT_SQL}")
def scd2_check_overlap(tables: Tables) -> DataFrame:
    return check.overlapping_versions(all_open(tables), KEYS, "event_id")


@query("scd2_check_overlap_sliced", f"WITH {HALF_DAY_SQL}, p AS ({overlap_sql('half')}) {OVERLAP_COUNT_SQL}")
def scd2_check_overlap_sliced(tables: Tables) -> DataFrame:
    return check.overlapping_versions(half_days(tables), KEYS, "event_id", rows_per_group=FEW_ROWS)


@query("scd2_overlap_pairs", f"WITH {HALF_DAY_SQL} {overlap_sql('half')}")
def scd2_overlap_pairs(tables: Tables) -> DataFrame:
    return check.overlap_pairs(half_days(tables), KEYS, "event_id")


@query(
    "scd2_check_continuity",
    f"""
    WITH {DIM} SELECT user_id, COUNT(*) AS version_count, MIN(effective_from) AS earliest_version,
           MAX(CASE WHEN is_latest THEN effective_from END) AS latest_version FROM dim GROUP BY 1
    """,
)
def scd2_check_continuity(tables: Tables) -> DataFrame:
    return check.continuity(dimension(tables), KEYS)


GAPS_SQL = f"""
    WITH {DIM} SELECT user_id, effective_from, effective_to,
        lead(effective_from) OVER (PARTITION BY user_id ORDER BY effective_from) AS next_from
    FROM dim WHERE status <> 'error' QUALIFY next_from > effective_to + INTERVAL 1 SECOND
"""


@query("scd2_check_gaps", GAPS_SQL)
def scd2_check_gaps(tables: Tables) -> DataFrame:
    """A dimension that lost its error versions."""
    return check.gaps(dimension(tables).where("status <> 'error'"), KEYS)


@query("scd2_check_gaps_sliced", GAPS_SQL)
def scd2_check_gaps_sliced(tables: Tables) -> DataFrame:
    return check.gaps(dimension(tables).where("status <> 'error'"), KEYS, rows_per_group=FEW_ROWS)


@query(
    "scd2_check_inverted",
    f"WITH {DIM} SELECT user_id, effective_from, effective_to FROM dim WHERE effective_to <= effective_from",
)
def scd2_check_inverted(tables: Tables) -> DataFrame:
    """Versions closed at or before their start: changes that came within the closing offset."""
    return check.inverted_versions(dimension(tables)).select("user_id", "effective_from", "effective_to")


@query(
    "scd2_orphans",
    f"""
    WITH {DIM}, broken AS (SELECT * FROM dim WHERE NOT (is_latest AND status = 'error'))
    SELECT user_id, COUNT(*) AS version_count FROM broken GROUP BY 1 HAVING NOT bool_or(is_latest)
    """,
)
def scd2_orphans(tables: Tables) -> DataFrame:
    """A dimension that lost its current error versions."""
    return check.orphans(dimension(tables).where("NOT (is_latest AND status = 'error')"), KEYS)


@query(
    "scd2_archive_split",
    f"""
    WITH {DIM} SELECT user_id, status, effective_from, effective_to,
        CASE WHEN effective_to < TIMESTAMP '2024-01-11' THEN 'archive' ELSE 'active' END AS part FROM dim
    """,
)
def scd2_archive_split(tables: Tables) -> DataFrame:
    columns = ["user_id", "status", "effective_from", "effective_to"]
    old, rest = check.archive_split(dimension(tables).select(*columns), "2024-01-11")
    return old.withColumn("part", F.lit("archive")).unionByName(rest.withColumn("part", F.lit("active")))


@query(
    "scd2_stats",
    f"""
    WITH {DIM} SELECT COUNT(*) AS total_records, COUNT(DISTINCT user_id) AS unique_keys,
        COUNT(CASE WHEN is_latest THEN 1 END) AS current_versions,
        COUNT(CASE WHEN NOT is_latest THEN 1 END) AS historical_versions,
        format('{{:,}}', COUNT(*)) AS formatted_total FROM dim
    """,
)
def scd2_stats(tables: Tables) -> DataFrame:
    return check.stats(dimension(tables), KEYS)


@query(
    "scd2_daily_summary",
    f"""
    WITH {DIM} SELECT batch_key, COUNT(*) AS records_loaded, COUNT(DISTINCT user_id) AS keys_affected,
        COUNT(CASE WHEN change_type = 'INSERT' THEN 1 END) AS new_keys,
        COUNT(CASE WHEN change_type = 'UPDATE' THEN 1 END) AS updated_keys,
        format('{{:,}}', COUNT(*)) AS formatted_count FROM dim GROUP BY 1
    """,
)
def scd2_daily_summary(tables: Tables) -> DataFrame:
    return check.daily_summary(dimension(tables), KEYS)


@query(
    "scd2_change_mix",
    f"""
    WITH {DIM} SELECT change_type, COUNT(*) AS record_count,
        CAST(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM dim) AS DECIMAL(5,2)) AS percentage FROM dim GROUP BY 1
    """,
)
def scd2_change_mix(tables: Tables) -> DataFrame:
    return check.change_mix(dimension(tables))


@query(
    "scd2_sample_history",
    f"""
    WITH {DIM} SELECT user_id, status, effective_from, effective_to, is_latest, change_type FROM dim
    WHERE user_id = (SELECT MIN(user_id) FROM dim WHERE NOT is_latest) ORDER BY effective_from LIMIT 5
    """,
)
def scd2_sample_history(tables: Tables) -> DataFrame:
    rows = dimension(tables).select("user_id", "status", "effective_from", "effective_to", "is_latest", "change_type")
    return check.sample_history(rows, "user_id")
