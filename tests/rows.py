"""Small booking frames for the tests."""

from __future__ import annotations

RAW = {
    "hotel": "City Hotel",
    "market_segment": "Direct",
    "arrival_date_year": 2016,
    "arrival_date_month": "July",
    "arrival_date_week_number": 27,
    "arrival_date_day_of_month": 1,
    "lead_time": 1,
    "stays_in_weekend_nights": 1,
    "stays_in_week_nights": 2,
    "adults": 2,
    "children": 0.0,
    "babies": 0,
    "meal": "BB",
    "country": "PRT",
    "is_repeated_guest": 0,
    "previous_cancellations": 0,
    "previous_bookings_not_canceled": 0,
    "reserved_room_type": "A",
    "deposit_type": "No Deposit",
    "customer_type": "Transient",
    "adr": 100.0,
    "booking_changes": 0,
    "days_in_waiting_list": 0,
    "required_car_parking_spaces": 0,
    "total_of_special_requests": 0,
    "agent": 9.0,
    "company": None,
}


def schema(names, extra: str = "") -> str:
    kinds = {int: "bigint", float: "double", str: "string", type(None): "double"}
    parts = [f"`{name}` {kinds[type(RAW[name])]}" for name in names]
    return ", ".join(parts) + extra


def raw_bookings(spark, *overrides: dict):
    rows = [{**RAW, **override} for override in overrides]
    return spark.createDataFrame(
        [tuple(row[name] for name in RAW) for row in rows], schema(RAW)
    )


def separable_bookings(spark, years=(2016,)):
    """20 rows per class and year; the lead time alone tells the class."""
    rows, key = [], 0
    for year in years:
        for offset, segment in ((0, "Direct"), (100, "Corporate"), (200, "Groups")):
            for i in range(20):
                row = {
                    **RAW,
                    "market_segment": segment,
                    "lead_time": offset + i % 10,
                    "arrival_date_year": year,
                    "adr": 80.0 + i,
                    "agent": None if segment == "Direct" else 9.0,
                }
                rows.append((key, 7, *[row[n] for n in RAW if n != "arrival_date_month"]))
                key += 1
    names = [n for n in RAW if n != "arrival_date_month"]
    return spark.createDataFrame(rows, "booking_id bigint, month bigint, " + schema(names))
