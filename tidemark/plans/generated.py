"""Test data made from the keys of tables, so that it grows with them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.draws import draw_sql, id_text
from tidemark.operators import generate as op
from tidemark.operators import scd2, verify
from tidemark.operators.incremental import run_load
from tidemark.operators.load import Dataset
from tidemark.operators.run import verify_all
from tidemark.plans.registry import Tables, query
from tidemark.spec import Incremental, TableSpec

# The same rules as SQL text for the other engine.
SQL_TYPES = {"string": "VARCHAR", "boolean": "BOOLEAN", "int": "INT", "timestamp_ntz": "TIMESTAMP"}


def padded_sql(value: str, width: int) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {max(width, 1)}, '0') END"


def rule_sql(rule: op.Rule, key: str, salt: int, day: int, at: str) -> str:
    drawn, args = draw_sql(key, salt), rule.args
    if rule.kind == "pick":
        value = f"list_extract({list(args)}, CAST({drawn} % {len(args)} + 1 AS INT))"
    elif rule.kind == "flag":
        value = f"{drawn} % 100 < {args[0]}"
    elif rule.kind == "money":
        value = f"CAST(CAST({drawn} % {args[0]} * {100 + args[1] * day} AS DOUBLE) / 10000 AS DECIMAL(19,4))"
    elif rule.kind == "exact":
        fraction = f"lpad(CAST({draw_sql(key, salt + op.SECOND_DRAW)} % 1000000 AS VARCHAR), 6, '0')"
        value = f"CAST(CAST({drawn} % 999999999 AS VARCHAR) || '.' || {fraction} AS DECIMAL(38,18))"
    elif rule.kind == "ratio":
        value = f"CAST({drawn} % {args[0]} + ({args[2]}) AS DOUBLE) / CAST({args[1]} AS DOUBLE)"
    elif rule.kind == "count":
        value = f"CAST({drawn} % {args[0] + args[1] * day} AS INT)"
    elif rule.kind == "number":
        value = f"CAST({drawn} % {args[0]} + {args[1] + args[2] * day} AS INT)"
    elif rule.kind == "text":
        value = f"'{args[0]}' || {padded_sql(f'({drawn} % {args[1]})', args[3])} || '{args[2]}'"
    elif rule.kind == "by_day":
        label = args[0][day - 1] if day <= len(args[0]) else args[1]
        value = f"'{label}' || {padded_sql(f'({drawn} % {args[2]})', args[3])}"
    elif rule.kind == "text_of_day":
        value = f"'{args[0]}{day}{args[1]}' || CAST({drawn} % {args[2]} AS VARCHAR)"
    elif rule.kind == "days_away":
        value = f"{at} + to_days(CAST({drawn} % {args[0]} * ({args[1]}) AS INT))"
    elif rule.kind == "exact_plus":
        value = f"CAST(CAST({drawn} % {args[0]} AS VARCHAR) || '{args[1][1:]}' AS DECIMAL(38,18))"
    elif rule.kind == "days_off":
        value = f"{at} + to_days({args[0]})"
    elif rule.kind == "rate":
        value = f"CAST(CAST({drawn} % {args[0]} + ({args[3]}) AS DOUBLE) / {args[1]} AS {args[2]})"
    else:
        constant = "NULL" if args[0] is None else f"'{args[0]}'"
        value = f"CAST({constant} AS {SQL_TYPES.get(args[1], args[1])})"
    if rule.null_of:
        of, nulls = rule.null_of
        value = f"CASE WHEN {draw_sql(key, salt + op.NULL_DRAW)} % {of} >= {nulls} THEN {value} END"
    return value


def rules_sql(rules, key: str, day: int, at: str) -> str:
    return ", ".join(
        f'{rule_sql(rule, key, 1 + place, day, at)} AS "{rule.name}"' for place, rule in enumerate(rules)
    )


AT, AT_SQL = "2024-03-01 08:30:00", "TIMESTAMP '2024-03-01 08:30:00'"


def batch_sql(rules, day: int) -> str:
    return f"""
        SELECT o_orderkey AS "RecordID", 20240301 AS "SystemCalendarID",
               CAST(CAST(md5('20240301-' || CAST(o_orderkey AS VARCHAR)) AS UUID) AS VARCHAR) AS "BatchProcessID",
               {rules_sql(rules, "o_orderkey", day, AT_SQL)}
        FROM orders
    """


@query("generate_batch", batch_sql(op.REPORTING_COLUMNS, 2))
def generate_batch(tables: Tables) -> DataFrame:
    return op.generate_batch(tables["orders"].select("o_orderkey"), "o_orderkey", 2, AT)


def loaded_reporting(tables: Tables) -> tuple[Dataset, TableSpec, DataFrame]:
    """The wide table, half of it loaded at first and the rest by a second run."""
    dataset = Dataset(tables.spark)
    rows = op.generate_batch(tables["orders"].select("o_orderkey"), "o_orderkey", 2, AT)
    half = tables["orders"].agg((F.max("o_orderkey") / 2).cast("bigint")).scalar()
    spec = TableSpec(
        "reporting", disposition="append", primary_key=("RecordID",), incremental=Incremental("RecordID", -1, "sequence")
    )
    run_load(dataset, spec, "full", "2024-03-01", reporting=rows.where(F.col("RecordID") <= half))
    run_load(dataset, spec, "incremental", "2024-03-02", reporting=rows)
    return dataset, spec, rows


@query("load_reporting_wide", batch_sql(op.REPORTING_COLUMNS, 2))
def load_reporting_wide(tables: Tables) -> DataFrame:
    """118 columns generated, loaded and loaded on, and read back."""
    dataset, _, _ = loaded_reporting(tables)
    return dataset.read("reporting").drop("_load_id", "_loaded_at")


@query(
    "verify_reporting_wide",
    """
    SELECT 4 AS total_checks, 4 AS passed_checks, 0 AS failed_checks, CAST(100 AS DOUBLE) AS success_rate,
           TRUE AS overall_passed, '' AS tables_with_issues, (SELECT COUNT(*) FROM orders) AS row_count, 0 AS differing_rows
    """,
)
def verify_reporting_wide(tables: Tables) -> DataFrame:
    """What was loaded against its source: counts, keys, a check of the user's, and all values by checksums."""
    dataset, spec, rows = loaded_reporting(tables)
    custom = {"batches": 'SELECT COUNT(*) FROM {reporting} WHERE SystemCalendarID <> 20240301 OR BatchProcessID IS NULL'}
    checks = verify_all(dataset, {"reporting": spec}, custom_checks=custom, reporting=rows)
    loaded = dataset.read("reporting").drop("_load_id", "_loaded_at")
    differing = verify.compare_by_checksum(rows, loaded, ["RecordID"]).agg(F.count(F.lit(1)).cast("int").alias("differing_rows"))
    totals = verify.summary(checks).withColumns({"row_count": loaded.agg(F.count(F.lit(1))).scalar()})
    return totals.withColumn("differing_rows", differing.scalar())


@query("generate_batch_quick", batch_sql(op.QUICK_COLUMNS, 4))
def generate_batch_quick(tables: Tables) -> DataFrame:
    """A day after the initial load, in the quick form."""
    return op.generate_batch(tables["orders"].select("o_orderkey"), "o_orderkey", 4, AT, op.QUICK_COLUMNS)


CATEGORY_NAMES = ("Industry", "CountryCode", "IsActive", "IsDeleted", "ParentClientID", "Address2", "LastLoginDate")
CATEGORIES = [rule for rule in op.REPORTING_COLUMNS if rule.name in CATEGORY_NAMES]


@query("generate_categories", f"SELECT event_id, {rules_sql(CATEGORIES, 'event_id', 1, AT_SQL)} FROM events")
def generate_categories(tables: Tables) -> DataFrame:
    ids = tables["events"].select("event_id")
    now = F.lit(AT).cast("timestamp_ntz")
    made = [
        op.value_of(rule, id_text("event_id"), 1 + place, 1, now).alias(rule.name) for place, rule in enumerate(CATEGORIES)
    ]
    return ids.select("event_id", *made)


KEY_SQL = "'CLIENT_' || " + padded_sql("c_custkey", 4)
CLIENTS_SQL = f"""
    clients AS (SELECT c_custkey, {KEY_SQL} AS "ClientBusinessKey",
                {rules_sql(op.CLIENT_COLUMNS, "c_custkey", 1, AT_SQL)} FROM customer)
"""


@query("generate_entities", f"WITH {CLIENTS_SQL} SELECT * EXCLUDE (c_custkey) FROM clients")
def generate_entities(tables: Tables) -> DataFrame:
    return op.generate_entities(tables["customer"], "c_custkey", AT)


def change_sql(change: op.Change, place: int, day: int) -> str:
    salt = op.CHANGE_SALT + 100 * day
    if change.kind == "prefix":
        new = f"'{change.args[0]}' || \"{change.column}\""
    elif change.kind == "value":
        new = f"CAST('{change.args[0]}' AS {SQL_TYPES[change.args[1]]})"
    else:
        new = rule_sql(change.args[0], "c_custkey", salt + 50 + place, day, AT_SQL)
    hit = f"{draw_sql('c_custkey', salt + place)} % {change.odds} = 0"
    return f'CASE WHEN {hit} THEN {new} ELSE "{change.column}" END AS "{change.column}"'


@query(
    "generate_changes",
    f"""
    WITH {CLIENTS_SQL}
    SELECT * REPLACE ({", ".join(change_sql(change, place, 2) for place, change in enumerate(op.CLIENT_CHANGES, start=1))})
    FROM clients WHERE {draw_sql("c_custkey", op.CHANGE_SALT + 200)} % 100 < {op.CHANGED_SHARE_PERCENT}
    """,
)
def generate_changes(tables: Tables) -> DataFrame:
    return op.generate_changes(_numbered_clients(tables), "c_custkey", day=2)


def _numbered_clients(tables: Tables) -> DataFrame:
    now = F.lit(AT).cast("timestamp_ntz")
    made = [
        op.value_of(rule, id_text("c_custkey"), 1 + place, 1, now).alias(rule.name)
        for place, rule in enumerate(op.CLIENT_COLUMNS)
    ]
    key = op.business_key(F.col("c_custkey")).alias("ClientBusinessKey")
    return tables["customer"].select("c_custkey", key, *made)


ATTRIBUTES = [rule.name for rule in op.CLIENT_COLUMNS]
_LISTED = ", ".join(f'"{name}"' for name in ATTRIBUTES)
_DIFFERS = " OR ".join(f'o."{name}" IS DISTINCT FROM n."{name}"' for name in ATTRIBUTES)
_REASON = ", ".join(f"CASE WHEN o.\"{name}\" IS DISTINCT FROM n.\"{name}\" THEN '{name}' END" for name in ATTRIBUTES)
CHANGES_SQL = f"""
    SELECT * REPLACE ({", ".join(change_sql(change, place, 2) for place, change in enumerate(op.CLIENT_CHANGES, start=1))})
    FROM clients WHERE {draw_sql("c_custkey", op.CHANGE_SALT + 200)} % 100 < {op.CHANGED_SHARE_PERCENT}
"""


def _version_sql(start: str, end: str, change: str, reason: str, author: str, key: int) -> str:
    return (
        f"TIMESTAMP '{start}' AS effective_from, {end} AS effective_to, {end} IS NULL AS is_latest, "
        f"{key} AS batch_key, '{change}' AS change_type, {reason} AS change_reason, {author} AS modified_by"
    )


@query(
    "scd2_populate",
    f"""
    WITH {CLIENTS_SQL}, chg AS ({CHANGES_SQL}),
    pairs AS (SELECT o.*, n.c_custkey IS NOT NULL AND ({_DIFFERS}) AS hit FROM clients o LEFT JOIN chg n USING (c_custkey)),
    fresh AS (SELECT s_suppkey + 1 + (SELECT MAX(c_custkey) FROM customer) AS k FROM supplier)
    SELECT "ClientBusinessKey", {_LISTED}, {_version_sql("2024-03-01", "CASE WHEN hit THEN TIMESTAMP '2024-03-01 23:59:59' END",
        "INSERT", "'Initial client load'", "CASE WHEN hit THEN 'SCD2_ETL_UPDATE' ELSE 'SCD2_ETL_INITIAL' END", 20240301)}
    FROM pairs
    UNION ALL
    SELECT n."ClientBusinessKey", {", ".join(f'n."{name}"' for name in ATTRIBUTES)}, {_version_sql("2024-03-02", "CAST(NULL AS TIMESTAMP)",
        "UPDATE", f"'Changed: ' || concat_ws(', ', {_REASON})", "'SCD2_ETL_UPDATE'", 20240302)}
    FROM chg n JOIN clients o USING (c_custkey) WHERE {_DIFFERS}
    UNION ALL
    SELECT 'CLIENT_' || {padded_sql("k", 4)}, {_LISTED}, {_version_sql("2024-03-02", "CAST(NULL AS TIMESTAMP)",
        "INSERT", "'New client onboarding'", "'SCD2_ETL_NEW'", 20240302)}
    FROM (SELECT k, {rules_sql(op.NEW_CLIENT_COLUMNS, "k", 2, AT_SQL)} FROM fresh)
    """,
)
def scd2_populate(tables: Tables) -> DataFrame:
    """A generated dimension after two days: first versions, then changes and new clients."""
    clients = _numbered_clients(tables)
    dimension = scd2.initial_versions(clients, ["ClientBusinessKey"], ATTRIBUTES, "2024-03-01")
    changes = op.generate_changes(clients, "c_custkey", day=2).drop("c_custkey")
    reserved = tables["customer"].agg(F.max("c_custkey") + 1).scalar()
    fresh = op.generate_new_entities(tables["supplier"], "s_suppkey", reserved, 2, AT)
    batch = scd2.Batch(dimension, changes.unionByName(fresh), ["ClientBusinessKey"], ATTRIBUTES, "2024-03-02")
    return scd2.apply_changes(batch)


@query(
    "generate_new_entities",
    f"""
    SELECT 'CLIENT_' || {padded_sql("k", 4)} AS "ClientBusinessKey", {rules_sql(op.NEW_CLIENT_COLUMNS, "k", 3, AT_SQL)}
    FROM (SELECT s_suppkey + 1 + (SELECT MAX(c_custkey) FROM customer) AS k FROM supplier)
    """,
)
def generate_new_entities(tables: Tables) -> DataFrame:
    reserved = tables["customer"].agg(F.max("c_custkey") + 1).scalar()
    return op.generate_new_entities(tables["supplier"], "s_suppkey", reserved, 3, AT)


@query("sample_n", f"SELECT * FROM customer ORDER BY {draw_sql('c_custkey', 7)}, c_custkey LIMIT 50")
def sample_n(tables: Tables) -> DataFrame:
    return op.sample_rows(tables["customer"], "c_custkey", 50, seed=7)


@query(
    "row_source",
    """
    SELECT o_orderkey, CAST(copy AS INT) AS copy FROM (
        SELECT o_orderkey, unnest(range(1, 1 + CAST(left(o_orderpriority, 1) AS INT))) AS copy FROM orders)
    """,
)
def row_source(tables: Tables) -> DataFrame:
    """Each order as many times as its priority says."""
    copies = F.left("o_orderpriority", F.lit(1)).cast("int")
    return op.row_source(tables["orders"].select("o_orderkey", "o_orderpriority"), copies).drop("o_orderpriority")
