"""Whole runs: load a selection of tables, note the outcome, verify what was loaded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import verify
from tidemark.operators.coerce import map_columns, rename_by_convention
from tidemark.operators.incremental import run_load
from tidemark.operators.load import Dataset, LoadError, load_selected
from tidemark.operators.profile import load_outcomes
from tidemark.sources.scan import scan
from tidemark.spec import TableSpec

AUDIT = "load_audit"


def run_all(
    dataset: Dataset,
    specs: Mapping[str, TableSpec],
    load_id: str,
    loaded_at: datetime | str,
    requested: Sequence[str] | None = None,
    parallel: int = 4,
    **frames: DataFrame,
) -> DataFrame:
    """Load the enabled or requested tables side by side; returns one outcome per table and
    adds them to the audit table. Fails after all were tried if any failed."""

    def load_one(spec: TableSpec) -> int:
        run_load(dataset, spec, load_id, loaded_at, **frames)
        return dataset.read(spec.target).count()

    try:
        results, failure = load_selected(dataset.spark, specs, load_one, requested, parallel), None
    except LoadError as problem:
        results, failure = problem.results, problem
    stamped = results.withColumn("loaded_at", F.lit(str(loaded_at)).cast("timestamp_ntz"))
    dataset.append(AUDIT, stamped, load_id, by=["table_name"])
    if failure:
        raise failure
    return results


def audit_report(dataset: Dataset, by_table: bool = True) -> DataFrame:
    """Loads, failures, durations and success rates from the audit table."""
    by = ["table_name"] if by_table else []
    duration = F.col("duration_seconds").cast("decimal(19,4)")
    return load_outcomes(dataset.read(AUDIT), by, F.col("status") == "failed", duration)


def verify_all(
    dataset: Dataset,
    specs: Mapping[str, TableSpec],
    tables: Sequence[str] | None = None,
    tolerance: int = 0,
    custom_checks: Mapping[str, str] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Row counts, existence and primary keys of the enabled or given tables, and the user's
    checks, in which `{name}` stands for a destination table. One row per check."""
    names = [name for name, spec in specs.items() if spec.enabled] if tables is None else list(tables)
    checks = []
    for name in names:
        checks += _table_checks(dataset, name, specs.get(name), tolerance, frames)
    loaded = {spec.target: dataset.read(spec.target) for spec in specs.values() if dataset.exists(spec.target)}
    for name, text in (custom_checks or {}).items():
        used = {table: df for table, df in loaded.items() if "{" + table + "}" in text}
        checks.append(verify.custom_check(dataset.spark, name, text, **used))
    return verify.union_checks(checks)


def _table_checks(
    dataset: Dataset, name: str, spec: TableSpec | None, tolerance: int, frames: Mapping[str, DataFrame]
) -> list[DataFrame]:
    spark = dataset.spark
    if spec is None:
        return [verify.failed(spark, name, "configuration_check", f"no configuration for table {name}")]
    if not dataset.exists(spec.target):
        missing = f"table {spec.target} does not exist"
        return [verify.failed(spark, name, check, missing) for check in ("row_count", "table_existence")]
    destination = dataset.read(spec.target)
    checks = []
    try:
        source = scan(spark, spec, **frames)
        checks.append(verify.row_count(name, source, destination, tolerance))
    except PySparkException as problem:
        return [verify.failed(spark, name, "row_count", str(problem).splitlines()[0])]
    checks.append(verify.tables_loaded(spark, [name], verify.row_counts({name: destination})))
    if spec.primary_key:
        empty = source.limit(0)
        renamed = rename_by_convention(map_columns(empty, spec.rename), spec.naming).columns
        new = {old.lower(): now for old, now in zip(empty.columns, renamed)}
        checks.append(verify.primary_key(name, destination, [new[key.lower()] for key in spec.primary_key]))
    return checks
