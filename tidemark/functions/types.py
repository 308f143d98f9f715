"""Rules from declared source types to Spark types."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Target of each source type that always gets one.
TARGET_TYPES = {
    "money": "decimal(19,4)",
    "smallmoney": "decimal(10,4)",
    "float": "double",
    "real": "double",
    "uniqueidentifier": "string",
    "datetime2": "timestamp_ntz",
    "bigint": "bigint",
    "bit": "boolean",
}
TEXT_TYPES = ("varchar", "nvarchar", "text", "ntext")
DECIMAL_TYPES = ("decimal", "numeric")
PROBLEMATIC_TYPES = ("money", "smallmoney", "uniqueidentifier", "text", "ntext", "float", "real")
LARGE_TEXT_LENGTH = 8000
EXACT_PRECISION_ABOVE = 28

_DECLARED = re.compile(r"^\s*(\w+)\s*(?:\(\s*(max|-?\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$", re.IGNORECASE)


@dataclass(frozen=True)
class SourceType:
    """A declared type such as `money`, `decimal(38,18)` or `varchar(max)`."""

    name: str
    size: int | None = None
    scale: int | None = None

    @staticmethod
    def parse(text: str) -> "SourceType":
        found = _DECLARED.match(text)
        if not found:
            raise ValueError(f"not a column type: {text!r}")
        name, size, scale = found.groups()
        if size is not None:
            size = -1 if size.lower() == "max" else int(size)
        return SourceType(name.lower(), size, int(scale) if scale is not None else None)

    @property
    def problematic(self) -> bool:
        return self.name in PROBLEMATIC_TYPES

    @property
    def target(self) -> str | None:
        """Spark type to cast to, or None when the column is kept as read."""
        if self.name in DECIMAL_TYPES:
            exact = self.size is not None and self.scale is not None
            return f"decimal({self.size},{self.scale})" if exact and self.size > EXACT_PRECISION_ABOVE else None
        if self.name in TEXT_TYPES:
            large = self.size is None or self.size == -1 or self.size > LARGE_TEXT_LENGTH
            return "string" if large else None
        return TARGET_TYPES.get(self.name)


# Source type that stands for a Spark type without a declared one.
_DECLARED_FOR = {
    "string": "varchar(max)",
    "double": "float",
    "float": "real",
    "boolean": "bit",
    "timestamp_ntz": "datetime2",
}


def declared_types(df: DataFrame) -> dict[str, str]:
    """Declared source type of each column, from field metadata or else from its Spark type."""
    found = {}
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        found[field.name] = field.metadata.get("source_type") or _DECLARED_FOR.get(spark_type, spark_type)
    return found


def target_types(
    df: DataFrame, source_types: Mapping[str, str] | None = None, overrides: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Cast target by column name: derived from declared types, explicit overrides winning.

    Names match without case. Columns without a rule are absent.
    """
    given = {name.lower(): text for name, text in (source_types or {}).items()}
    forced = {name.lower(): text for name, text in (overrides or {}).items()}
    unknown = (given.keys() | forced.keys()) - {name.lower() for name in df.columns}
    if unknown:
        raise ValueError(f"type given for columns that do not exist: {sorted(unknown)}")
    targets = {}
    for name, declared in declared_types(df).items():
        target = forced.get(name.lower()) or SourceType.parse(given.get(name.lower(), declared)).target
        if target:
            targets[name] = target
    return targets


def problematic_columns(df: DataFrame, source_types: Mapping[str, str] | None = None) -> list[str]:
    given = {name.lower(): text for name, text in (source_types or {}).items()}
    return [
        name
        for name, declared in declared_types(df).items()
        if SourceType.parse(given.get(name.lower(), declared)).problematic
    ]


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of `old` fits `new` unchanged."""
    if old == new:
        return True
    if isinstance(new, T.StringType):
        return not isinstance(old, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    integers = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    digits = {"byte": 3, "short": 5, "integer": 10, "long": 19}
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if old in integers and new in integers:
        return integers.index(old) <= integers.index(new)
    if old in integers and isinstance(new, T.DecimalType):
        return new.precision - new.scale >= digits[old.typeName()]
    if old in integers[:3] and isinstance(new, T.DoubleType):
        return True
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def read_as_wider(old: T.DataType, new: T.DataType) -> bool:
    """Whether files of the one type can be read as the other, wider one."""
    numbers = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType)
    if old == new or not (isinstance(old, numbers) and isinstance(new, numbers) and widens(old, new)):
        return False
    return not (isinstance(old, T.IntegralType) and isinstance(new, T.DecimalType))


# A text that can be a number: sign, digits with a point, exponent, blanks around.
NUMBER_TEXT = r"^[\x00-\x20]*[+-]?[0-9.]+([eE][+-]?[0-9]+)?[\x00-\x20]*[dDfFlL]?[\x00-\x20]*$"
INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def try_fit(value: Column, source: T.DataType, target: str) -> Column:
    """`try_cast`, where values that plainly do not fit are told by a comparison first: a
    failed cast costs an exception for every row."""
    wanted = T.DataType.fromDDL(target)
    fitted = value.try_cast(target)
    if isinstance(source, T.StringType):
        exact = isinstance(wanted, (T.IntegralType, T.DecimalType))
        return F.when(value.rlike(NUMBER_TEXT), fitted) if exact else fitted
    if not isinstance(source, T.NumericType):
        return fitted
    if isinstance(wanted, T.DecimalType):
        limit = 10 ** (wanted.precision - wanted.scale)
    elif wanted.simpleString() in INTEGER_BITS:
        limit = 2 ** (INTEGER_BITS[wanted.simpleString()] - 1) + 1
    else:
        return fitted
    # Values at the limit itself are left to the cast, which rounds.
    if isinstance(source, T.DecimalType):
        digits = source.precision - source.scale
        return fitted if limit >= 10**digits else F.when(value.between(Decimal(-limit), Decimal(limit)), fitted)
    if isinstance(source, T.IntegralType):
        return fitted if limit >= 2**63 else F.when(value.between(-limit, limit), fitted)
    return F.when(value.between(float(-limit), float(limit)), fitted)
