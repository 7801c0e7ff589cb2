"""Missing values, coercion, rounding and repeatable draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that a CSV reader of the source data treats as missing.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def as_column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def missing_token_to_null(column: str | Column) -> Column:
    text = as_column(column).cast("string")
    return F.when(~F.trim(text).isin(*MISSING_TOKENS), text)


def to_double(column: str | Column) -> Column:
    """Numeric coercion: unparsable text and NaN become null."""
    number = as_column(column).try_cast("double")
    return F.when(~F.isnan(number), number)


def finite(column: str | Column) -> Column:
    """NaN and both infinities become null."""
    number = as_column(column)
    bad = F.isnan(number) | (F.abs(number.cast("double")) == F.lit(float("inf")))
    return F.when(~bad, number)


def count_where(condition: Column) -> Column:
    """Number of rows that meet a condition; generates less code than count_if."""
    return F.count(F.when(condition, 1))


def half_up(column: str | Column, places: int) -> Column:
    """Round halves up by plain double arithmetic, the same in every engine."""
    scale = float(10**places)
    return F.floor(as_column(column) * scale + 0.5).cast("double") / scale


def draw(seed: int, key: str | Column) -> Column:
    """Repeatable uniform hash of a row key, used wherever a random draw is needed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_column(key).cast("string")))


def draw_digits(drawn: str | Column) -> list[Column]:
    """The hash as ordered digits of bounded cardinality (12 bits each, then the rest)."""
    text = as_column(drawn)
    return [*[F.substring(text, start, 3) for start in (1, 4, 7)], F.substring(text, 10, 23)]


def utc_instant(column: str | Column) -> Column:
    """A zoneless timestamp read as UTC, whatever the session zone (watermarks need a zoned one)."""
    ts = as_column(column)
    return F.make_timestamp_ltz(
        F.year(ts),
        F.month(ts),
        F.dayofmonth(ts),
        F.hour(ts),
        F.minute(ts),
        F.extract(F.lit("SECOND"), ts),
        F.lit("UTC"),
    )


def utc_micros(column: str | Column) -> Column:
    """Microseconds since the epoch of a zoneless timestamp read as UTC."""
    return F.unix_micros(utc_instant(column))


def utc_day(instant: str | Column) -> Column:
    """The UTC date of a zoned timestamp, whatever the session zone."""
    days = F.floor(F.unix_seconds(as_column(instant)) / 86_400)
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))
