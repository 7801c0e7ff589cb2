"""CSV in, Parquet or CSV out."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import missing_token_to_null, to_double

# The numeric columns of the booking table; everything else is text.
BOOKING_TYPES = {
    "arrival_date_year": "bigint",
    "arrival_date_week_number": "bigint",
    "arrival_date_day_of_month": "bigint",
    "lead_time": "bigint",
    "stays_in_weekend_nights": "bigint",
    "stays_in_week_nights": "bigint",
    "adults": "bigint",
    "children": "double",
    "babies": "bigint",
    "is_repeated_guest": "bigint",
    "previous_cancellations": "bigint",
    "previous_bookings_not_canceled": "bigint",
    "booking_changes": "bigint",
    "agent": "double",
    "company": "double",
    "days_in_waiting_list": "bigint",
    "adr": "double",
    "required_car_parking_spaces": "bigint",
    "total_of_special_requests": "bigint",
    "is_canceled": "bigint",
    "month": "bigint",
}


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case names with underscores for spaces."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"column names collide after normalization: {twice}")
    return df.toDF(*names)


def has_open_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a line holds an odd number of quotes, as it does where a field goes on after it."""
    lines = spark.read.text(path)
    return not lines.filter(F.regexp_count("value", F.lit('"')) % 2 == 1).isEmpty()


def read_csv_text(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Every column as text, missing-value tokens as null. No inference pass over the data.

    Where a line is a row, one large file is read by many tasks; with ``multi_line`` quoted
    fields may hold line breaks and every file is one task. By default a parallel look at the
    quotes of all lines decides.
    """
    if multi_line is None:
        multi_line = has_open_quotes(spark, path)
    # quotes are doubled inside quoted fields; columns are read by name
    options = {"header": True, "multiLine": multi_line, "escape": '"', "enforceSchema": False}
    text = spark.read.options(**options).csv(path)
    return text.select(
        *[missing_token_to_null(F.col(f"`{name}`")).alias(name) for name in text.columns]
    )


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Declared types for the text columns present; unreadable text becomes null."""
    columns = []
    for name in df.columns:
        declared = types.get(name)
        if declared is None:
            columns.append(F.col(name))
        elif declared == "double":
            columns.append(to_double(name).alias(name))
        else:
            columns.append(F.col(name).try_cast(declared).alias(name))
    return df.select(*columns)


def read_bookings_csv(
    spark: SparkSession,
    path: str,
    types: dict[str, str] = BOOKING_TYPES,
    multi_line: bool | None = None,
) -> DataFrame:
    return typed(normalize_columns(read_csv_text(spark, path, multi_line)), types)


def _place(path: str) -> str:
    """Host and path of a location, without its scheme."""
    parts = urlparse(path)
    return parts.netloc + unquote(parts.path).rstrip("/")


def write_processed(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Overwrite ``path``; refused while the table is still being read from there.

    An overwrite clears the target first, so reading from it would lose the data.
    """
    target = _place(path)
    sources = (_place(name) for name in df.inputFiles())
    if any(source == target or source.startswith(target + "/") for source in sources):
        raise ValueError(f"cannot overwrite {path}: the table is read from there")
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(path)
