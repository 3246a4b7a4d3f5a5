"""Typed columns and flags from raw text codes."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_int(column: Column | str) -> Column:
    """Text to int; malformed or blank text becomes NULL, also in ANSI mode."""
    return _col(column).try_cast("int")


def try_double(column: Column | str) -> Column:
    """Text to double; malformed or blank text becomes NULL, also in ANSI mode."""
    return _col(column).try_cast("double")


def any_flag(*conditions: Column) -> Column:
    """1 if any condition holds, else 0; a NULL condition does not hold, so the flag is never NULL."""
    return F.when(reduce(or_, conditions), 1).otherwise(0)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
