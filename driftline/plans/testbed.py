"""Bindings of the test tables: the booking-like base view, in Spark and as oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import MONTH_NAMES
from ..operators.features import ModelInputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One booking per order: its customer, and what its lines add up to."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal"
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").alias("quantity"),
            F.max("l_suppkey").alias("supplier"),
            F.min("l_shipdate").alias("first_ship"),
            F.count_if(F.col("l_linenumber") % 2 == 0).alias("n_even"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
            F.count_if(F.col("l_returnflag") == "A").alias("n_accepted"),
            F.count_if(F.col("l_linestatus") == "O").alias("n_open"),
            F.count_if(F.col("l_discount") >= 0.05).alias("n_discounted"),
            F.max("l_returnflag").alias("flag"),
            F.max("l_linestatus").alias("line_status"),
        )
    )
    date = F.col("o_orderdate")

    def count(column: str):
        return F.coalesce(column, F.lit(0)).cast("long")

    return (
        orders.join(customers, "o_custkey", "inner")
        .join(lines, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("booking_id"),
            F.col("o_orderstatus").alias("hotel"),
            F.col("c_mktsegment").alias("market_segment"),
            F.year(date).cast("long").alias("arrival_date_year"),
            F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(date)).alias(
                "arrival_date_month"
            ),
            F.weekofyear(date).cast("long").alias("arrival_date_week_number"),
            F.dayofmonth(date).cast("long").alias("arrival_date_day_of_month"),
            F.date_diff(F.to_date("first_ship"), F.to_date(date)).cast("long").alias("lead_time"),
            count("n_even").alias("stays_in_weekend_nights"),
            count("n_lines").alias("stays_in_week_nights"),
            (F.col("c_nationkey") % 4 + 1).cast("long").alias("adults"),
            F.col("quantity").alias("children"),
            count("n_returned").alias("babies"),
            F.when(F.col("n_even") > 1, "HB").otherwise("BB").alias("meal"),
            F.col("c_nationkey").cast("string").alias("country"),
            (F.col("o_custkey") % 2).cast("long").alias("is_repeated_guest"),
            count("n_accepted").alias("previous_cancellations"),
            count("n_open").alias("previous_bookings_not_canceled"),
            F.coalesce("flag", F.lit("X")).alias("reserved_room_type"),
            F.col("o_orderpriority").alias("deposit_type"),
            F.coalesce("line_status", F.lit("X")).alias("customer_type"),
            F.col("supplier").cast("double").alias("agent"),
            F.when(F.col("o_custkey") % 4 == 0, F.col("o_custkey"))
            .cast("double")
            .alias("company"),
            F.col("c_nationkey").cast("long").alias("days_in_waiting_list"),
            F.col("c_acctbal").alias("adr"),
            (F.col("o_custkey") % 3).cast("long").alias("required_car_parking_spaces"),
            count("n_discounted").alias("total_of_special_requests"),
        )
    )


def sound_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base view with lead times made non-negative and id 0 made missing."""
    raw = raw_bookings(spark, sf_dir)
    return raw.withColumns(
        {
            "lead_time": F.abs(F.coalesce("lead_time", F.lit(0))),
            "agent": F.when(F.col("agent") > 0, F.col("agent")),
            "company": F.when(F.col("company") > 0, F.col("company")),
        }
    )


_MONTHS = ", ".join(f"'{name}'" for name in MONTH_NAMES)

RAW_BOOKINGS_SQL = f"""
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity,
         max(l_suppkey) AS supplier, min(l_shipdate) AS first_ship,
         count(*) FILTER (WHERE l_linenumber % 2 = 0) AS n_even,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
         count(*) FILTER (WHERE l_returnflag = 'A') AS n_accepted,
         count(*) FILTER (WHERE l_linestatus = 'O') AS n_open,
         count(*) FILTER (WHERE l_discount >= 0.05::DOUBLE) AS n_discounted,
         max(l_returnflag) AS flag, max(l_linestatus) AS line_status
  FROM lineitem GROUP BY l_orderkey),
raw_bookings AS (
  SELECT o_orderkey AS booking_id, o_orderstatus AS hotel, c_mktsegment AS market_segment,
         year(o_orderdate)::BIGINT AS arrival_date_year,
         ([{_MONTHS}])[month(o_orderdate)] AS arrival_date_month,
         weekofyear(o_orderdate)::BIGINT AS arrival_date_week_number,
         day(o_orderdate)::BIGINT AS arrival_date_day_of_month,
         (first_ship::DATE - o_orderdate::DATE)::BIGINT AS lead_time,
         coalesce(n_even, 0)::BIGINT AS stays_in_weekend_nights,
         coalesce(n_lines, 0)::BIGINT AS stays_in_week_nights,
         (c_nationkey % 4 + 1)::BIGINT AS adults, quantity AS children,
         coalesce(n_returned, 0)::BIGINT AS babies,
         CASE WHEN n_even > 1 THEN 'HB' ELSE 'BB' END AS meal,
         c_nationkey::VARCHAR AS country, (o_custkey % 2)::BIGINT AS is_repeated_guest,
         coalesce(n_accepted, 0)::BIGINT AS previous_cancellations,
         coalesce(n_open, 0)::BIGINT AS previous_bookings_not_canceled,
         coalesce(flag, 'X') AS reserved_room_type, o_orderpriority AS deposit_type,
         coalesce(line_status, 'X') AS customer_type, supplier::DOUBLE AS agent,
         CASE WHEN o_custkey % 4 = 0 THEN o_custkey::DOUBLE END AS company,
         c_nationkey::BIGINT AS days_in_waiting_list, c_acctbal AS adr,
         (o_custkey % 3)::BIGINT AS required_car_parking_spaces,
         coalesce(n_discounted, 0)::BIGINT AS total_of_special_requests
  FROM orders JOIN customer ON o_custkey = c_custkey
       LEFT JOIN lines ON l_orderkey = o_orderkey)"""

SOUND_BOOKINGS_SQL = (
    RAW_BOOKINGS_SQL
    + """,
sound_bookings AS (
  SELECT * REPLACE (abs(coalesce(lead_time, 0)) AS lead_time,
                    CASE WHEN agent > 0 THEN agent END AS agent,
                    CASE WHEN company > 0 THEN company END AS company)
  FROM raw_bookings)"""
)

# Model inputs taken from the embedding table: its vector entries as columns.
EMBEDDING_DIMS = 64
EMBEDDING_SPEC = ModelInputs.of(number=tuple(f"e{i}" for i in range(EMBEDDING_DIMS)))


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, class, e0 ... e63)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("label").cast("string").alias("class"),
        *[
            F.element_at("embedding", i + 1).cast("double").alias(f"e{i}")
            for i in range(EMBEDDING_DIMS)
        ],
    )
