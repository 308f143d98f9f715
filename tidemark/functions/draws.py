"""Repeatable pseudo-random numbers from a row's id: plain integer arithmetic, the same on
any cluster, with any partitioning and in any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MODULUS = 2147483648
MULTIPLIER = 1103515245
SECOND_MULTIPLIER = 69069
INCREMENT = 12345


def _factor(salt: int) -> int:
    return pow(MULTIPLIER, 2 * salt + 3, MODULUS)


def draw(key: str, salt: int) -> Column:
    """Number in [0, 2**31) for a non-negative id and a salt, one salt per generated column.

    `key` is a SQL expression; as one text the plan is built in a single call. The middle
    digits of a square unlink the columns and the neighbouring ids.
    """
    line = f"(({key} % {MODULUS} * {_factor(salt)} + {salt * INCREMENT + 1}) % {MODULUS})"
    middle = f"(shiftright({line} * {line}, 16) % {MODULUS})"
    return F.expr(f"({middle} * {SECOND_MULTIPLIER} + {line} + shiftright({key}, 31)) % {MODULUS}")


def id_text(column: str) -> str:
    """A column as the SQL text of an id."""
    return f"CAST(`{column}` AS BIGINT)"


def draw_sql(key: str, salt: int) -> str:
    """The same number as SQL text for another engine."""
    line = f"((({key} % {MODULUS}) * {_factor(salt)} + {salt * INCREMENT + 1}) % {MODULUS})"
    middle = f"({line} * {line} // 65536 % {MODULUS})"
    return f"(({middle} * {SECOND_MULTIPLIER} + {line} + {key} // {MODULUS}) % {MODULUS})"
