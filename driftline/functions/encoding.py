"""Derived model inputs as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_column, to_double

# English month names in calendar order.
MONTH_NAMES = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)


def month_number(name: str | Column) -> Column:
    """1..12 for an exact English month name, null for anything else."""
    position = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), as_column(name))
    return F.when(position > 0, position.cast("long"))


def cycle(column: str | Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = to_double(column) * (2.0 * math.pi) / float(period)
    return F.sin(angle), F.cos(angle)


def is_present(column: str | Column) -> Column:
    """1 for a positive id, 0 for a missing, unparsable or non-positive one."""
    return F.coalesce(to_double(column) > 0, F.lit(False)).cast("int")
