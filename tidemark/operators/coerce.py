"""Casting columns to their target types, auditing casts and fitting batches to a schema."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import convert_names, unique_names
from tidemark.functions.types import target_types, try_fit, widens
from tidemark.session import materialize


def cast_columns(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in one projection; the others and the order stay."""
    return df.select(
        *[F.col(name).cast(targets[name]).alias(name) if name in targets else F.col(name) for name in df.columns]
    )


def coerce(
    df: DataFrame, source_types: Mapping[str, str] | None = None, overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """Cast every column by its declared source type; explicit overrides win."""
    return cast_columns(df, target_types(df, source_types, overrides))


def declare(df: DataFrame, source_types: Mapping[str, str]) -> DataFrame:
    """Note declared source types in the field metadata, where `coerce` finds them."""
    return df.select(
        *[
            F.col(name).alias(name, metadata={"source_type": source_types[name]}) if name in source_types else F.col(name)
            for name in df.columns
        ]
    )


def unpivot_columns(
    measures: DataFrame, columns: Sequence[str], prefixes: Sequence[str], name: str = "column_name"
) -> DataFrame:
    """One row per column from a one-row frame with a value `<prefix>_<position>` for each."""
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias(name),
                *[F.col(f"{prefix}_{place}").alias(prefix) for prefix in prefixes],
            )
            for place, column in enumerate(columns)
        ]
    )
    return measures.select(F.inline(rows))


PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def audit_casts(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Per column: rows, NULLs, values the cast would lose, and numbers it would change.

    One aggregate over the columns concerned.
    """
    measures: list[Column] = []
    for place, (name, target) in enumerate(targets.items()):
        value = F.col(name)
        fitted = try_fit(value, df.schema[name].dataType, target)
        changed = _changed(value, fitted, df.schema[name].dataType, target)
        measures += [
            F.count(F.lit(1)).alias(f"row_count_{place}"),
            F.count_if(value.isNull()).alias(f"null_count_{place}"),
            F.count_if(value.isNotNull() & fitted.isNull()).alias(f"lost_count_{place}"),
            F.count_if(changed).alias(f"changed_count_{place}"),
        ]
    prefixes = ["row_count", "null_count", "lost_count", "changed_count"]
    return unpivot_columns(df.agg(*measures), list(targets), prefixes)


def _changed(value: Column, fitted: Column, source: T.DataType, target: str) -> Column:
    """Whether a cast has changed a number: casting back does not give it again.

    Plain numbers in texts are compared by their digits, others as the widest decimals that hold their
    whole or their fractional digits.
    """
    if isinstance(source, T.NumericType):
        return fitted.isNotNull() & ~fitted.try_cast(source).eqNullSafe(value)
    if isinstance(source, T.StringType) and re.match("decimal|double|float|int|bigint|smallint|tinyint", target):
        kept = F.lit(False)
        for wide in ("decimal(38,0)", "decimal(38,9)", "decimal(38,18)", "decimal(38,36)"):
            one, other = value.try_cast(wide), fitted.try_cast(wide)
            kept = kept | (one.isNotNull() & other.isNotNull() & (one != other))
        made = fitted.cast("string")
        plain = value.rlike(PLAIN_NUMBER) & made.rlike(PLAIN_NUMBER)
        return F.when(made.isNull(), False).when(plain, _digits_of(value) != _digits_of(made)).otherwise(kept)
    return F.lit(False)


def _digits_of(text: Column) -> Column:
    """A plain number without plus, outer blanks and zeros that say nothing: `-12.5`, `12.` or `.`."""
    short = F.regexp_replace(text, r"^\s*(?:\+|(-))?0*(\d*?)(?:\.(\d*?)0*)?\s*$", "$1$2.$3")
    return F.when(short == "-.", ".").otherwise(short)


def audit_precision(df: DataFrame, columns: Sequence[str], expected: tuple[int, int] = (19, 4)) -> DataFrame:
    """Per decimal column: declared digits, digits in use, and values beyond the expected type."""
    measures: list[Column] = []
    for place, name in enumerate(columns):
        declared = df.schema[name].dataType
        if not isinstance(declared, T.DecimalType):
            raise ValueError(f"{name} is {declared.simpleString()}, not a decimal")
        whole, fraction = _digits(F.col(name), declared)
        beyond = (whole > expected[0] - expected[1]) | (fraction > expected[1])
        measures += [
            F.lit(declared.precision).alias(f"declared_precision_{place}"),
            F.lit(declared.scale).alias(f"declared_scale_{place}"),
            F.lit((declared.precision, declared.scale) == expected).alias(f"as_expected_{place}"),
            F.coalesce(F.max(whole), F.lit(0)).alias(f"integer_digits_{place}"),
            F.coalesce(F.max(fraction), F.lit(0)).alias(f"fraction_digits_{place}"),
            F.count_if(beyond).alias(f"beyond_expected_{place}"),
        ]
    prefixes = [
        "declared_precision", "declared_scale", "as_expected",
        "integer_digits", "fraction_digits", "beyond_expected",
    ]
    return unpivot_columns(df.agg(*measures), columns, prefixes)


def _digits(value: Column, declared: T.DecimalType) -> tuple[Column, Column]:
    """Digits in use before and after the point. By arithmetic, as the text of a small decimal may
    have an exponent, depending on the session."""
    size, scale = declared.precision, declared.scale
    number = F.abs(value)
    whole = F.when(value.isNotNull(), F.lit(0))
    for digits in range(1, size - scale + 1):
        whole = F.when(number >= F.lit(Decimal("1" + "0" * (digits - 1))), digits).otherwise(whole)
    fraction = F.when(value.isNotNull(), F.lit(scale))
    for digits in range(scale - 1, -1, -1):
        fraction = F.when(F.bround(number, digits).try_cast(declared) == number, digits).otherwise(fraction)
    return whole, fraction


def align_schema(
    batch: DataFrame, target: T.StructType, evolve: bool = False
) -> tuple[DataFrame, list[str]]:
    """Fit a batch to a destination schema, and list the batch columns the schema lacks.

    Missing columns become NULL, types may only widen, and new columns are dropped unless
    `evolve` is set, when they follow the known ones.
    """
    present = {name.lower(): name for name in batch.columns}
    known = {field.name.lower() for field in target.fields}
    selected: list[Column] = []
    for field in target.fields:
        name = present.get(field.name.lower())
        if name is None:
            if not field.nullable:
                raise ValueError(f"column {field.name} is missing and may not be NULL")
            selected.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        found = batch.schema[name].dataType
        if not widens(found, field.dataType):
            raise ValueError(
                f"column {field.name}: {found.simpleString()} does not fit {field.dataType.simpleString()}"
            )
        selected.append(F.col(name).cast(field.dataType).alias(field.name))
    extra = [name for name in batch.columns if name.lower() not in known]
    if evolve:
        selected += [F.col(name) for name in extra]
    return batch.select(*selected), extra


def rename_by_convention(df: DataFrame, convention: str) -> DataFrame:
    return df.toDF(*convert_names(df.columns, convention))


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the listed columns and keep the rest."""
    missing = sorted(set(mapping) - set(df.columns))
    if missing:
        raise ValueError(f"columns to rename do not exist: {missing}")
    unique_names(df.columns, [mapping.get(name, name) for name in df.columns])
    return df.withColumnsRenamed(dict(mapping))


def original_names(df: DataFrame, names: Mapping[str, str], view: str | None = None) -> DataFrame:
    """The listed columns under their original names, given as original by current name;
    also as a temporary view if one is named."""
    restored = df.select(*[F.col(current).alias(original) for current, original in names.items()])
    if view:
        restored.createOrReplaceTempView(view)
    return restored


def apply_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULLs by column defaults; a column the frame lacks is added with its default."""
    types = {field.name: field.dataType for field in df.schema.fields}
    filled = {}
    for name, default in defaults.items():
        value = default if isinstance(default, Column) else F.lit(default)
        filled[name] = F.coalesce(F.col(name), value.cast(types[name])) if name in types else value
    return df.withColumns(filled)


def assign_surrogate_key(
    df: DataFrame, name: str, order: Sequence[str], after: Column | int = 0
) -> DataFrame:
    """Number rows without gaps in the given order, from `after` + 1.

    Range partitions are sorted and written with their row positions, then shifted by the
    sizes of the partitions before them: no global window. Rows equal in `order` follow a hash of
    the row, so that numbers do not depend on the layout of files; only rows equal in all columns
    are interchangeable, and many of them spread over several partitions.
    """
    hashed = [field.name for field in df.schema.fields if "map<" not in field.dataType.simpleString()]
    # The id holds the partition in its upper bits and the row's position in the lower 33.
    numbered = materialize(
        df.withColumns({"_tie": F.xxhash64(*hashed), "_spread": F.rand(0)})
        .repartitionByRange(*order, "_tie", "_spread")
        .sortWithinPartitions(*order, "_tie", "_spread")
        .withColumn("_position", F.monotonically_increasing_id())
        .drop("_tie", "_spread"),
        "numbered",
    )
    part = F.shiftright("_position", 33)
    row = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per shuffle partition, so a single task may order them.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_part").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    start = after if isinstance(after, Column) else F.lit(after)
    return (
        numbered.withColumn("_of", part)
        .join(F.broadcast(starts), "_of")
        .withColumn(name, (F.coalesce(start, F.lit(0)) + F.col("_start") + row + 1).cast("bigint"))
        .select(*df.columns, name)
    )
