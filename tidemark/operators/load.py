"""Writing destinations: replace, append, merge, and loading a selection of tables.

A dataset is a database in the shared folder. Each table is a view over its newest version
table; replace and merge write a new version and then repoint the view, so that nothing is
overwritten while it is read and a failed job leaves the old version in place.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import read_as_wider
from tidemark.operators.coerce import align_schema
from tidemark.operators.keys import latest_per_key, require_keys, without_match
from tidemark.session import fresh_path
from tidemark.spec import TableSpec

LOAD_ID = "_load_id"
LOADED_AT = "_loaded_at"
# Kept with the rows but not shown: what a load id belongs to when several sources fill one table.
LOAD_SOURCE = "_load_source"
FILES_OF = "tidemark.files_of"  # the version whose files another one reads
# Loads packed together: number of the packing as a column and as a property, and ids being packed.
PACK, PACKED, PENDING = "_pack", "tidemark.packed", "tidemark.pending"


def quoted(text: str) -> str:
    """A text literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stamp(df: DataFrame, load_id: str, loaded_at: datetime | str, **extra) -> DataFrame:
    """Mark rows with their load: one literal per load, the same in every retry."""
    columns = {LOAD_ID: F.lit(load_id), LOADED_AT: F.lit(loaded_at).cast("timestamp_ntz")}
    return df.withColumns(columns | {name: F.lit(value) for name, value in extra.items()})


def merge_rows(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Upsert on a key: whole rows replaced or added, the latest update of a key counting.

    The anti join broadcasts a small batch and leaves the target unshuffled.
    """
    latest = latest_per_key(require_keys(updates.select(*target.columns), keys), keys, order)
    return without_match(target, latest, keys).unionByName(latest)


def _by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together, so that not every task writes a file into every
    partition. The rebalance hint splits large partitions again. Rows of one load need none."""
    columns = [name for name in partition_by if name not in (LOAD_ID, LOAD_SOURCE)]
    return df.hint("rebalance", *columns) if columns else df


def merge_into(table: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> None:
    """Upsert into a table of a catalog with row-level operations, which rewrites only the
    files it must. Plain parquet tables refuse it; the tests cannot cover it further."""
    latest = latest_per_key(require_keys(updates, keys), keys, order).alias("updates")
    matches = [F.col(f"{table}.{key}") == F.col(f"updates.{key}") for key in keys]
    merge = latest.mergeInto(table, reduce(lambda one, other: one & other, matches))
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


class Dataset:
    """Destination tables of one run."""

    def __init__(self, spark: SparkSession, name: str | None = None, location: str | None = None) -> None:
        """A named dataset lies where the catalog or `location` says, an unnamed one in the
        shared folder."""
        self.spark = spark
        self.name = name or f"tidemark_{uuid.uuid4().hex}"
        if not re.fullmatch(r"\w+", self.name):
            raise ValueError(f"not a database name: {self.name!r}")
        if not spark.catalog.databaseExists(self.name):
            folder = location if name else fresh_path(spark, self.name)
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name}" + (f" LOCATION '{folder}'" if folder else ""))

    def table(self, name: str) -> str:
        return f"{self.name}.`{name}`"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.name}.{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.table(name))

    def replace(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), properties: Mapping[str, str] | None = None
    ) -> None:
        """Make the table hold exactly these rows. They may come from the table itself. Properties
        are kept with the view, so that they change in the same moment as the rows."""
        old = self._versions(name)
        version = f"{name}__v{(old[-1] if old else 0) + 1}"
        writer = _by_partition(df, partition_by).write.format("parquet").mode("overwrite")
        if partition_by:
            # Kept with the table, so that later overwrites touch their own partitions only.
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
        writer.saveAsTable(self.table(version))
        self._show(name, version, properties)
        # The version before stays for readers that have planned on it, with the one whose files it reads.
        needed = {f"{name}__v{old[-1]}", self._files_of(f"{name}__v{old[-1]}")} if len(old) > 1 else set()
        for number in old[:-1]:
            if f"{name}__v{number}" not in needed:
                for kind in ("v", "c", "a"):
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.table(f'{name}__{kind}{number}')}")

    def version(self, name: str) -> str:
        """Name of the table that holds the newest version of the rows."""
        return f"{name}__v{self._versions(name)[-1]}"

    def stored(self, name: str) -> DataFrame:
        """The rows with the source that loaded them, where that is kept."""
        version = self.version(name)
        packed = self._packed(name, version)
        return self.spark.sql(packed) if packed else self.spark.table(self.table(version))

    def recent(self, name: str) -> DataFrame:
        """The rows that are not packed yet, those of each source's last load among them."""
        return self.spark.table(self.table(self.version(name)))

    def packed_table(self, version: str) -> str:
        """Where the packed loads of a version lie (see `layout`)."""
        return "__a".join(self._files_of(version).rsplit("__v", 1))

    def _packed(self, name: str, version: str, properties: Mapping[str, str] | None = None) -> str | None:
        """SELECT of recent and packed rows together, if loads of this version have been packed."""
        packed = self.packed_table(version)
        if not self.exists(packed):
            return None
        known = self.properties(name) if properties is None else properties
        if PACKED not in known:
            return None
        held = {field.name: field.dataType for field in self.spark.table(self.table(packed)).schema.fields}
        fields = self.spark.table(self.table(version)).schema.fields
        columns = ", ".join(f"`{field.name}`" for field in fields)
        fitted = ", ".join(
            f"CAST({f'`{field.name}`' if field.name in held else 'NULL'} AS {field.dataType.simpleString()}) AS `{field.name}`"
            for field in fields
        )
        pending = json.loads(known.get(PENDING, "[]"))
        without = f" WHERE {LOAD_ID} NOT IN ({', '.join(map(quoted, pending))})" if pending else ""
        return (
            f"SELECT {columns} FROM {self.table(version)}{without} UNION ALL "
            f"SELECT {fitted} FROM {self.table(packed)} WHERE {PACK} <= {known[PACKED]}"
        )

    def widen(self, name: str, schema: T.StructType) -> str:
        """Let the table's columns have the types of a schema where those are wider; returns the version.

        The new version is a table of its own over the same files, which are read as the wider types:
        nothing is rewritten, and later loads write the wider types into new files.
        """
        version = self.version(name)
        wanted = {field.name.lower(): field.dataType for field in schema.fields}
        fields = self.stored(name).schema.fields
        wider = {
            field.name: wanted[field.name.lower()]
            for field in fields
            if read_as_wider(field.dataType, wanted.get(field.name.lower(), field.dataType))
        }
        if not wider:
            return version
        new = f"{name}__v{self._versions(name)[-1] + 1}"
        columns = ", ".join(f"`{field.name}` {wider.get(field.name, field.dataType).simpleString()}" for field in fields)
        partition = self._partitions(version)
        kept = f"PARTITIONED BY ({', '.join(f'`{column}`' for column in partition)})" if partition else ""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(version)}").where("col_name = 'Location'")
        self.spark.sql(
            f"CREATE TABLE {self.table(new)} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') {kept} "
            f"LOCATION '{described.first().data_type}' TBLPROPERTIES ('{FILES_OF}' = '{self._files_of(version)}')"
        )
        if partition:
            self.spark.sql(f"ALTER TABLE {self.table(new)} RECOVER PARTITIONS")
        self._show(name, new)
        return new

    def _files_of(self, version: str) -> str:
        """The version that owns the files of a version."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.table(version)}").where(F.col("key") == FILES_OF).collect()
        return rows[0].value if rows else version

    def properties(self, name: str) -> dict[str, str]:
        """Properties of the view of a table."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.table(name)}").collect()
        return {row.key: row.value for row in rows}

    def append(
        self, name: str, df: DataFrame, load_id: str | None = None, evolve: bool = False,
        source: str | None = None, by: Sequence[str] = (),
    ) -> None:
        """Add rows. In a table begun with a load id, the rows that one load of one source has for
        given values of the columns `by` form a partition, which a retry of that load overwrites
        instead of doubling; other sources and values under the same load id are left alone.

        Rows are fitted to the table's schema; columns it lacks, and wider types, are an error unless
        `evolve` is set, when the table takes them over.
        """
        partition = [*by]
        if load_id is not None:
            df = df.withColumn(LOAD_ID, F.lit(load_id))
            if source is not None:
                df = df.withColumn(LOAD_SOURCE, F.lit(source))
                partition.append(LOAD_SOURCE)
            partition.append(LOAD_ID)
        if not self.exists(name):
            self.replace(name, df, partition)
            return
        version = self.version(name)
        if LOAD_SOURCE not in self.spark.table(self.table(version)).columns:
            df = df.drop(LOAD_SOURCE)
        if evolve:
            version = self.widen(name, df.schema)
        batch = self._fitted(version, df, evolve)
        if evolve:
            batch = self._add_columns(name, version, batch)
        by_load = LOAD_ID in self._partitions(version)
        batch.write.insertInto(self.table(version), overwrite=load_id is not None and by_load)

    def merge(
        self, name: str, df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
        partition_by: Sequence[str] = (), evolve: bool = False,
    ) -> None:
        """Upsert into the table. With `evolve` it takes over new columns and wider types.

        Plain files cannot change in place, so the table is written anew, unless it is
        partitioned by key columns: then only the partitions that the batch touches are read
        and written. See `merge_into` for catalogs with row-level operations.
        """
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns of a merge must be key columns")
        latest = latest_per_key(require_keys(df, keys), keys, order)
        if not self.exists(name):
            self.replace(name, latest, partition_by)
            return
        if evolve:
            self.evolve(name, df)
        version = self.version(name)
        df = self._fitted(version, df)
        if not partition_by:
            self.replace(name, merge_rows(self.read(name), df, keys, order))
            return
        if self._partitions(version) != list(partition_by):
            raise ValueError(f"table {name} is partitioned by {self._partitions(version)}")
        target = self.spark.table(self.table(version))
        touched = target.join(df.select(*partition_by).distinct(), list(partition_by), "left_semi")
        merged = merge_rows(touched.select(*target.columns), df, keys, order)
        batch = _by_partition(merged.select(*target.columns), partition_by)
        batch.write.insertInto(self.table(version), overwrite=True)

    def evolve(self, name: str, df: DataFrame) -> None:
        """Give the table the new columns and wider types of a frame, without any of its rows."""
        version = self.widen(name, df.schema)
        self._add_columns(name, version, self._fitted(version, df, True))

    def _fitted(self, version: str, df: DataFrame, evolve: bool = False) -> DataFrame:
        fitted, extra = align_schema(df, self.spark.table(self.table(version)).schema, evolve)
        if extra and not evolve:
            raise ValueError(f"columns {extra} are not in {version}")
        return fitted

    def _add_columns(self, name: str, version: str, batch: DataFrame) -> DataFrame:
        known = self.spark.table(self.table(version)).columns
        new = [field for field in batch.schema.fields if field.name not in known]
        if new:
            added = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new)
            self.spark.sql(f"ALTER TABLE {self.table(version)} ADD COLUMNS ({added})")
            self._show(name, version)
        return batch.select(*self.spark.table(self.table(version)).columns)

    def _show(self, name: str, version: str, properties: Mapping[str, str] | None = None) -> None:
        if properties is None and self.exists(name) and self.exists(self.packed_table(version)):
            properties = {key: value for key, value in self.properties(name).items() if key in (PACKED, PENDING)}
        packed = self._packed(name, version, properties or {})
        hidden = LOAD_SOURCE in self.spark.table(self.table(version)).columns
        rows = f"({packed})" if packed else self.table(version)
        self.view(name, f"SELECT *{f' EXCEPT ({LOAD_SOURCE})' if hidden else ''} FROM {rows}", properties)

    def view(self, name: str, text: str, properties: Mapping[str, str] | None = None) -> None:
        pairs = ", ".join(f"{quoted(key)} = {quoted(value)}" for key, value in (properties or {}).items())
        kept = f" TBLPROPERTIES ({pairs})" if pairs else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table(name)}{kept} AS {text}")

    def _partitions(self, version: str) -> list[str]:
        columns = self.spark.catalog.listColumns(f"{self.name}.{version}")
        return [column.name for column in columns if column.isPartition]

    def _versions(self, name: str) -> list[int]:
        found = self.spark.sql(f"SHOW TABLES IN {self.name} LIKE '{name}__v*'")
        numbers = [row.tableName.rsplit("__v", 1)[-1] for row in found.select("tableName").collect()]
        return sorted(int(number) for number in numbers if number.isdigit())


class LoadError(RuntimeError):
    """Some tables of a run failed; `results` holds the outcome of every table."""

    def __init__(self, message: str, results: DataFrame) -> None:
        super().__init__(message)
        self.results = results


@dataclass(frozen=True)
class Outcome:
    table_name: str
    status: str
    row_count: int | None
    duration_seconds: float
    error: str | None


OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


def select_specs(specs: Mapping[str, TableSpec], requested: Sequence[str] | None = None) -> dict[str, TableSpec]:
    """Enabled specs, or the requested ones among them; an unknown name is an error."""
    enabled = {name: spec for name, spec in specs.items() if spec.enabled}
    unknown = [name for name in requested or () if name not in enabled]
    if unknown:
        raise ValueError(f"tables not configured or not enabled: {unknown}")
    chosen = enabled if requested is None else {name: enabled[name] for name in requested}
    if not chosen:
        raise ValueError("no tables to load")
    return chosen


def load_selected(
    spark: SparkSession,
    specs: Mapping[str, TableSpec],
    load_one: Callable[[TableSpec], int],
    requested: Sequence[str] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Load tables side by side and report each. All are tried; any failure fails the run.

    `load_one` loads a table and returns its row count.
    """
    chosen = select_specs(specs, requested)

    def attempt(item: tuple[str, TableSpec]) -> Outcome:
        name, spec = item
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        begun = time.monotonic()
        try:
            rows = load_one(spec)
            return Outcome(spec.target, "success", rows, time.monotonic() - begun, None)
        except Exception as problem:  # noqa: BLE001 - one table must not stop the others
            return Outcome(spec.target, "failed", None, time.monotonic() - begun, str(problem))

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(chosen)))) as pool:
        outcomes = list(pool.map(inheritable_thread_target(spark)(attempt), chosen.items()))
    results = spark.createDataFrame([vars(outcome) for outcome in outcomes], OUTCOME_SCHEMA)
    failed = [outcome.table_name for outcome in outcomes if outcome.status == "failed"]
    if failed:
        raise LoadError(f"tables failed to load: {failed}", results)
    return results
