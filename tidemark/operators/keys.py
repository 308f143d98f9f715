"""Latest row per key, and keys that may not be NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when a key column holds NULL."""
    types = {field.name: field.dataType for field in df.schema.fields}
    checked = {
        key: F.coalesce(
            F.col(key), F.raise_error(F.lit(f"key column {key} holds NULL")).cast(types[key])
        )
        for key in keys
    }
    return df.withColumns(checked)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the greatest by `order`, then by all other columns.

    An aggregate that combines before the shuffle, so that many copies of one key are cheap.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.select(*keys).distinct()
    rank = F.struct(*order, *[name for name in others if name not in order])
    best = df.groupBy(*keys).agg(F.max(rank).alias("_best"))
    return best.select(*[F.col(name) if name in keys else F.col(f"_best.{name}").alias(name) for name in df.columns])


def without_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the other frame does not hold."""
    return df.join(other.select(*keys), list(keys), "left_anti")
