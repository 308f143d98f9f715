"""Typing watermark values, as a column of texts or as the one bound of a load."""

from __future__ import annotations

import math
from datetime import date, datetime, timezone
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.types import NUMBER_TEXT

# Text forms of a timestamp besides ISO 8601, as a pattern, in Spark and in
# Python notation. Digits alone are a compact date, never a year.
OTHER_DATE_FORMATS = (
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy", "%b %d, %Y"),
    (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy", "%m/%d/%Y"),
    (r"^\d{8}$", "yyyyMMdd", "%Y%m%d"),
)
ZONED_TEXT = r"\d:\d.*(Z|[+-]\d{1,2}(:?\d{2})?)\s*$"


def parse_timestamp(text: Column) -> Column:
    """Timestamp of an ISO text or of one of the other formats, else NULL. A text with a zone
    gives its time in UTC, whatever the zone of the session."""
    epoch = F.lit("1970-01-01 00:00:00")
    since_epoch = text.try_cast("timestamp") - F.concat(epoch, F.lit("Z")).cast("timestamp")
    others = [
        F.when(text.rlike(pattern), F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz"))
        for pattern, form, _ in OTHER_DATE_FORMATS
    ]
    return F.coalesce(
        F.when(text.rlike(ZONED_TEXT), epoch.cast("timestamp_ntz") + since_epoch),
        F.when(~text.rlike(r"^\d+$"), text.try_cast("timestamp_ntz")),
        *others,
    )


def parse_integer(text: Column) -> Column:
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))


def parse_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def convert_bound(value: Any, strategy: str) -> Any:
    """Typed bound of a load. Only NULL counts as missing; a wrong type is an error."""
    if value is None or strategy == "custom":
        return value
    if strategy == "timestamp":
        return _timestamp_bound(value)
    return _sequence_bound(value)


def _timestamp_bound(value: Any) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    if isinstance(value, str):
        try:
            return datetime.fromisoformat(value)
        except ValueError:
            pass
        for _, _, form in OTHER_DATE_FORMATS:
            try:
                return datetime.strptime(value, form)
            except ValueError:
                continue
    raise ValueError(f"Invalid timestamp initial value: {value!r}")


def _sequence_bound(value: Any) -> int | float | Decimal:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return value
    if isinstance(value, str):
        try:
            return int(value)
        except ValueError:
            pass
        try:
            number = float(value)
            if math.isfinite(number):
                return number
        except ValueError:
            pass
    raise ValueError(f"Invalid sequence initial value: {value!r}")


def bound_literal(value: Any, spark_type: str) -> Column:
    """Literal of a column's type. Times go as text: the zone of the driver has no say."""
    if isinstance(value, datetime):
        zoned = value.tzinfo is not None
        text = (value.astimezone(timezone.utc) if zoned else value).replace(tzinfo=None).isoformat(" ")
        value = f"{text}+00:00" if zoned and spark_type == "timestamp" else text
    return F.lit(value).cast(spark_type)


def moment(value: Any) -> Column:
    """A point in time without zone, from a datetime, a text or a column."""
    return value.cast("timestamp_ntz") if isinstance(value, Column) else bound_literal(value, "timestamp_ntz")


def batch_key(timestamp: Column) -> Column:
    """Calendar key yyyymmdd of a timestamp."""
    return F.year(timestamp) * 10000 + F.month(timestamp) * 100 + F.day(timestamp)


def batch_date(key: Column) -> Column:
    """Midnight of a calendar key."""
    day = F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)
    return day.cast("timestamp_ntz")
