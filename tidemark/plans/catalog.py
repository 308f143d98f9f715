"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import (  # noqa: F401 - importing a module registers its queries
    checks,
    coercions,
    generated,
    history,
    incrementals,
    loads,
    profiles,
    scans,
    streams,
)
from tidemark.plans.registry import ORACLES, QUERIES, Tables


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_folder(function: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: function(Tables(spark, folder))

    return {name: over_folder(function) for name, function in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
