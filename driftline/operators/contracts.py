"""Data contracts: every check of a table in one aggregation pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import count_where


class ContractError(Exception):
    """A table violates its contract."""


@dataclass(frozen=True)
class Field:
    """What a column must look like. Bounds are closed and ignore nulls."""

    name: str
    type: str
    nullable: bool = False
    at_least: float | None = None
    at_most: float | None = None
    allowed: tuple | None = None

    def failures(self, dtype: T.DataType) -> dict[str, Column]:
        """Check name -> predicate that is true for a failing row."""
        column = F.col(self.name)
        missing = column.isNull()
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(column)
        checks = {} if self.nullable else {"not_null": missing}
        if self.at_least is not None and self.at_most is not None:
            inside = column.between(self.at_least, self.at_most)
            checks[f"in_range({self.at_least}, {self.at_most})"] = ~missing & ~inside
        elif self.at_least is not None:
            checks[f"at_least({self.at_least})"] = ~missing & (column < self.at_least)
        elif self.at_most is not None:
            checks[f"at_most({self.at_most})"] = ~missing & (column > self.at_most)
        if self.allowed is not None:
            names = ", ".join(str(value) for value in self.allowed)
            checks[f"is_in({names})"] = ~missing & ~column.isin(*self.allowed)
        return checks


@dataclass(frozen=True)
class Contract:
    stage: str
    fields: tuple[Field, ...]
    non_empty: bool = False


def _text(*names: str, **how) -> tuple[Field, ...]:
    return tuple(Field(name, "string", **how) for name in names)


def _counts(*names: str) -> tuple[Field, ...]:
    return tuple(Field(name, "bigint", at_least=0) for name in names)


WEEK = Field("arrival_date_week_number", "bigint", at_least=1, at_most=53)
DAY = Field("arrival_date_day_of_month", "bigint", at_least=1, at_most=31)
CHILDREN = Field("children", "double", nullable=True, at_least=0)

# The column rules of the raw table.
RAW_BOOKINGS = Contract(
    "raw",
    (
        *_text("hotel", "market_segment", "arrival_date_month"),
        *_counts("lead_time", "adults", "babies"),
        CHILDREN,
        Field("adr", "double", nullable=True),
        WEEK,
        DAY,
    ),
)

# The column rules of the cleaned table.
PROCESSED_BOOKINGS = Contract(
    "processed",
    (
        *_text("market_segment", "hotel", "meal"),
        *_text("country", nullable=True),
        *_text("reserved_room_type", "deposit_type", "customer_type"),
        Field("month", "bigint", at_least=1, at_most=12),
        WEEK,
        DAY,
        *_counts("lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "adults"),
        CHILDREN,
        *_counts("babies"),
        Field("is_repeated_guest", "bigint", allowed=(0, 1)),
        *_counts(
            "previous_cancellations", "previous_bookings_not_canceled", "days_in_waiting_list"
        ),
        Field("adr", "double", at_least=0),
        *_counts("required_car_parking_spaces", "total_of_special_requests"),
        Field("agent", "double", nullable=True, at_least=1),
        Field("company", "double", nullable=True, at_least=1),
    ),
    non_empty=True,
)

_REPORT = "array<struct<column:string,check:string,n_failed:bigint>>"


def _type_fits(actual: T.DataType, declared: str) -> bool:
    if declared == "bigint":
        return isinstance(actual, T.IntegralType)
    if declared == "double":
        return isinstance(actual, (T.DoubleType, T.FloatType))
    return actual.simpleString() == declared


def _checks(
    df: DataFrame, contract: Contract, weight: str | None = None
) -> list[tuple[str, str, Column]]:
    """(column, check, number of failures as an aggregate); a row counts ``weight`` times."""
    def failures(failed: Column) -> Column:
        if weight is None:
            return count_where(failed)
        return F.coalesce(F.sum(F.when(failed, F.col(weight))), F.lit(0))

    types = {field.name: field.dataType for field in df.schema.fields}
    entries: list[tuple[str, str, Column]] = []
    for field in contract.fields:
        present = field.name in types
        entries.append((field.name, "present", F.lit(0 if present else 1)))
        if not present:
            continue
        fits = _type_fits(types[field.name], field.type)
        entries.append((field.name, f"type({field.type})", F.lit(0 if fits else 1)))
        if fits:
            entries.extend(
                (field.name, check, failures(failed))
                for check, failed in field.failures(types[field.name]).items()
            )
    if contract.non_empty:
        entries.append(("*", "not_empty", F.when(F.count("*") > 0, 0).otherwise(1)))
    return entries


def _counted(df: DataFrame, contract: Contract, weight: str | None = None) -> DataFrame:
    """One row: n_rows and the report as an array."""
    report = F.array(
        *[
            F.struct(F.lit(column), F.lit(check), n_failed.cast("long"))
            for column, check, n_failed in _checks(df, contract, weight)
        ]
    ).cast(_REPORT)
    rows = F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return df.agg(rows.alias("n_rows"), report.alias("report"))


def failure_report(df: DataFrame, contract: Contract) -> DataFrame:
    """(stage, column, check, n_failed) for every check, passed ones with 0.

    Missing columns and wrong types are read off the schema and count one failure each;
    value checks of such columns are left out.
    """
    return _counted(df, contract).select(
        F.lit(contract.stage).alias("stage"), F.inline("report")
    )


def failing_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that fail a value check, with the array of reasons."""
    types = {field.name: field.dataType for field in df.schema.fields}
    reasons = [
        F.when(failed, F.lit(f"{field.name}: {check}"))
        for field in contract.fields
        if field.name in types and _type_fits(types[field.name], field.type)
        for check, failed in field.failures(types[field.name]).items()
    ]
    return df.withColumn("reasons", F.array_compact(F.array(*reasons))).filter(
        F.size("reasons") > 0
    )


def validated_rows(df: DataFrame, contract: Contract, weight: str | None = None) -> int:
    """The number of rows, or one error that names the stage and all failing checks.

    ``weight`` names a column that tells how many rows each one stands for.
    """
    found = _counted(df, contract, weight).first()
    failed = [entry for entry in found.report if entry.n_failed > 0]
    if failed:
        total = sum(entry.n_failed for entry in failed)
        detail = "; ".join(f"{e.column} {e.check}: {e.n_failed}" for e in failed)
        raise ContractError(
            f"contract violated at stage '{contract.stage}': {total} failing case(s): {detail}"
        )
    return found.n_rows


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    validated_rows(df, contract)
    return df


def validate_raw(df: DataFrame) -> DataFrame:
    return validate(df, RAW_BOOKINGS)


def validate_processed(df: DataFrame) -> DataFrame:
    return validate(df, PROCESSED_BOOKINGS)


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name not in df.columns]


def require_inputs(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, names)
    if missing:
        raise ContractError(f"missing model input column(s): {missing}")
    return df


# Columns that leak the target, identify an agent, or are known too late.
BANNED_INPUTS = frozenset(
    {
        "market_segment",
        "distribution_channel",
        "reservation_status",
        "reservation_status_date",
        "is_canceled",
        "assigned_room_type",
        "booking_changes",
        "arrival_date_year",
    }
)
# Ids of which only the presence may be used.
PRESENCE_ONLY = frozenset({"agent", "company"})


def leak_guard(spec, banned: Iterable[str] = BANNED_INPUTS) -> None:
    """Refuse a feature spec that reads a banned column or uses an id as a quantity."""
    leaks = set(spec.sources()) & set(banned)
    leaks |= PRESENCE_ONLY & set(spec.sources("number", "cycle", "category"))
    if leaks:
        raise ContractError(f"columns not allowed as model inputs: {sorted(leaks)}")


@dataclass(frozen=True)
class ScoringField:
    """A field of a row to be scored; a default makes it optional."""

    rule: Field
    default: object = None
    optional: bool = False


def _optional_counts(*names: str) -> tuple[ScoringField, ...]:
    return tuple(ScoringField(rule, 0, True) for rule in _counts(*names))


# Fields, ranges and defaults of a booking sent for scoring.
SCORING_BOOKINGS = (
    *[ScoringField(rule) for rule in _text("hotel")],
    *[ScoringField(rule) for rule in _counts("lead_time")],
    ScoringField(Field("month", "bigint", at_least=1, at_most=12)),
    ScoringField(WEEK),
    ScoringField(DAY),
    *[
        ScoringField(rule)
        for rule in _counts("stays_in_weekend_nights", "stays_in_week_nights", "adults")
    ],
    ScoringField(Field("children", "double", at_least=0), 0.0, True),
    *_optional_counts("babies"),
    *[ScoringField(rule) for rule in _text("meal", "country")],
    ScoringField(Field("is_repeated_guest", "bigint", at_least=0, at_most=1), 0, True),
    *_optional_counts("previous_cancellations", "previous_bookings_not_canceled"),
    *[ScoringField(rule) for rule in _text("reserved_room_type", "deposit_type")],
    *_optional_counts("days_in_waiting_list"),
    *[ScoringField(rule) for rule in _text("customer_type")],
    ScoringField(Field("adr", "double", at_least=0)),
    *_optional_counts("required_car_parking_spaces", "total_of_special_requests"),
    ScoringField(Field("agent", "double", nullable=True, at_least=0), None, True),
    ScoringField(Field("company", "double", nullable=True, at_least=0), None, True),
)


def judge_scoring_rows(
    df: DataFrame,
    fields: tuple[ScoringField, ...] = SCORING_BOOKINGS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Allowlisted, typed fields plus ``reasons``; an empty array means accepted.

    A default is used only for a column the table does not have; a null in an optional
    field that is present fails like any other null. Columns that are neither fields nor
    in ``keep`` (row keys, times) are dropped.
    """
    typed, failures = _typed_rows(df, fields, keep)
    value_reasons = [F.when(failed, F.lit(reason)) for reason, failed in failures]
    return typed.withColumn(
        "reasons", F.concat("reasons", F.array_compact(F.array(*value_reasons)))
    )


def _typed_rows(
    df: DataFrame, fields: tuple[ScoringField, ...], keep: tuple[str, ...]
) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """Typed fields with the ``reasons`` that types give, and what else may fail with its reason."""
    columns: list[Column] = []
    reasons: list[Column] = []
    for field in fields:
        name, declared = field.rule.name, field.rule.type
        if name not in df.columns:
            value = F.lit(field.default) if field.optional else F.lit(None)
            columns.append(value.cast(declared).alias(name))
            if not field.optional:
                reasons.append(F.lit(f"{name}: required"))
            continue
        raw = F.col(name)
        value = raw.try_cast(declared)
        columns.append(value.alias(name))
        if df.schema[name].dataType.simpleString() == declared:
            continue
        unreadable = raw.isNotNull() & value.isNull()
        if declared == "bigint":
            number = raw.try_cast("double")
            unreadable = unreadable | (number.isNotNull() & (number != F.floor(number)))
        reasons.append(F.when(unreadable, F.lit(f"{name}: type({declared})")))
    found = F.array_compact(F.array(*reasons).cast("array<string>"))
    typed = df.select(*keep, *columns, found.alias("reasons"))
    return typed, [
        (f"{field.rule.name}: {check}", failed)
        for field in fields
        if field.rule.name in df.columns
        for check, failed in field.rule.failures(typed.schema[field.rule.name].dataType).items()
    ]


def validate_scoring_rows(
    df: DataFrame,
    fields: tuple[ScoringField, ...] = SCORING_BOOKINGS,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with their reasons)."""
    judged = judge_scoring_rows(df, fields, keep)
    typed, failures = _typed_rows(df, fields, keep)
    # no list of reasons is made for rows that have none
    sound = [~F.coalesce(failed, F.lit(False)) for _, failed in failures]
    accepted = typed.filter(reduce(Column.__and__, sound, F.size("reasons") == 0)).drop("reasons")
    return accepted, judged.filter(F.size("reasons") > 0)


def cast_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column, n_failed): texts that are not missing yet unreadable as the declared type."""
    counts = F.array(
        *[
            F.struct(
                F.lit(name),
                count_where(F.col(name).isNotNull() & F.col(name).try_cast(declared).isNull()),
            )
            for name, declared in types.items()
        ]
    ).cast("array<struct<column:string,n_failed:bigint>>")
    return df.agg(counts.alias("report")).select(F.inline("report"))
