"""Registration of queries: a callable over the tables, and the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.scan import read_table


@dataclass(frozen=True)
class Tables:
    """The tables of a folder, read when asked for: `tables["orders"]`."""

    spark: SparkSession
    folder: str

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable:
    """Register the decorated function under a name, next to its SQL."""

    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return register
