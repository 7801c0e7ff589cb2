"""Queries: contracts, cleaning, sampling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import half_up
from ..operators import cleaning, contracts, sampling
from ..operators.aggregates import distinct_values, value_counts
from ..operators.features import BOOKING_SPEC
from ..operators.ranking import with_position
from ..runtime import scratch_path
from ..sources.bookings import read_bookings_csv, write_processed
from .registry import query
from .testbed import RAW_BOOKINGS_SQL, SOUND_BOOKINGS_SQL, raw_bookings, sound_bookings, table

SEED = 42

# -- cleaning -------------------------------------------------------------------------


@query(
    """SELECT DISTINCT * FROM lineitem"""
)
def clean_dedup(spark, sf_dir):
    """Whole rows, the first line of every order sent twice."""
    lines = table(spark, sf_dir, "lineitem")
    return cleaning.drop_exact_duplicates(lines.unionAll(lines.filter("l_linenumber = 1")))


@query(
    """SELECT c_custkey, balance FROM (
         SELECT c_custkey, CASE WHEN c_nationkey <> 7 THEN c_acctbal END AS balance FROM customer)
       WHERE balance IS NULL OR NOT balance < 0"""
)
def clean_negative(spark, sf_dir):
    balance = F.when(F.col("c_nationkey") != 7, F.col("c_acctbal")).alias("balance")
    return cleaning.drop_negative(
        table(spark, sf_dir, "customer").select("c_custkey", balance), "balance"
    )


@query(
    """SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (
         SELECT c_nationkey FROM customer GROUP BY c_nationkey HAVING count(*) >= 55)"""
)
def clean_rare(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return cleaning.drop_rare_classes(customers, "c_nationkey", 55)


@query(
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) = 8 THEN NULL
                               ELSE month(o_orderdate)::BIGINT END AS month FROM orders"""
)
def clean_month(spark, sf_dir):
    # one month is written in lower case, which the name map does not know
    name = F.date_format("o_orderdate", "MMMM")
    named = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.month("o_orderdate") == 8, F.lower(name)).otherwise(name).alias(
            "arrival_date_month"
        ),
    )
    return cleaning.map_month_name(named)


def messy_bookings(spark, sf_dir):
    """Sound bookings with a class of few rows, and every seventh row sent twice."""
    few = F.when(F.col("booking_id") % 5000 == 1, "Few").otherwise(F.col("market_segment"))
    rows = sound_bookings(spark, sf_dir).withColumn("market_segment", few)
    return rows.unionByName(rows.filter("booking_id % 7 = 0"))


_CLEAN_SQL = f"""WITH {SOUND_BOOKINGS_SQL},
with_few AS (SELECT * REPLACE (CASE WHEN booking_id % 5000 = 1 THEN 'Few' ELSE market_segment END
                               AS market_segment) FROM sound_bookings),
messy AS (SELECT * FROM with_few UNION ALL SELECT * FROM with_few WHERE booking_id % 7 = 0),
unique_rows AS (SELECT DISTINCT * FROM messy),
kept AS (SELECT * FROM unique_rows WHERE market_segment IS NOT NULL
                                     AND NOT coalesce(adr < 0, false)),
valid AS (SELECT market_segment FROM kept GROUP BY market_segment HAVING count(*) >= 10)"""


@query(
    _CLEAN_SQL
    + f"""
SELECT booking_id, market_segment, {", ".join(c for c in BOOKING_SPEC.sources() if c != "month")},
       month(strptime(arrival_date_month, '%B'))::BIGINT AS month
FROM kept WHERE market_segment IN (SELECT market_segment FROM valid)
           AND arrival_date_year <= 2000"""
)
def clean_bookings(spark, sf_dir):
    clean, _ = cleaning.clean_bookings(messy_bookings(spark, sf_dir), min_class_count=10)
    recent = cleaning.training_period(clean, 2000)
    contracts.require_inputs(recent, BOOKING_SPEC.sources())
    return recent.select("booking_id", "market_segment", *BOOKING_SPEC.sources())


@query(
    _CLEAN_SQL
    + """
SELECT (SELECT count(*) FROM messy) AS rows_in,
       (SELECT count(*) FROM messy) - (SELECT count(*) FROM unique_rows) AS duplicates,
       (SELECT count(*) FROM unique_rows WHERE adr < 0) AS negative,
       (SELECT count(*) FROM kept
        WHERE market_segment NOT IN (SELECT market_segment FROM valid)) AS rare_class"""
)
def removed_counts(spark, sf_dir):
    _, removed = cleaning.clean_bookings(messy_bookings(spark, sf_dir), min_class_count=10)
    return spark.createDataFrame(
        [(removed.rows_in, removed.duplicates, removed.negative, removed.rare_class)],
        "rows_in bigint, duplicates bigint, negative bigint, rare_class bigint",
    )


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}
SELECT booking_id, market_segment, country, adr, agent, lead_time FROM sound_bookings"""
)
def bookings_roundtrip(spark, sf_dir):
    """Bookings written as CSV, read with declared types, and written as processed Parquet."""
    rows = sound_bookings(spark, sf_dir)
    raw, processed = scratch_path(spark, "raw-csv"), scratch_path(spark, "processed")
    rows.toDF(*[name.replace("_", " ").upper() for name in rows.columns]).write.csv(raw, header=True)
    write_processed(read_bookings_csv(spark, raw), processed)
    return spark.read.parquet(processed).select(
        F.col("booking_id").cast("long").alias("booking_id"),
        "market_segment", "country", "adr", "agent", "lead_time",
    )


_UNKNOWN = ("hotel", "arrival_date_month", "meal", "country", "reserved_room_type",
            "deposit_type", "customer_type")


@query(
    f"""WITH {RAW_BOOKINGS_SQL}
SELECT * EXCLUDE (market_segment)
         REPLACE (coalesce(children, 0) AS children, coalesce(lead_time, 0) AS lead_time,
                  coalesce(adr, 0) AS adr,
                  {", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in _UNKNOWN)})
FROM (SELECT * REPLACE (nullif(country, '7') AS country) FROM raw_bookings)"""
)
def payload_normalize(spark, sf_dir):
    gaps = raw_bookings(spark, sf_dir).withColumn("country", F.nullif("country", F.lit("7")))
    return cleaning.normalize_payload(gaps)


@query(
    f"""WITH {RAW_BOOKINGS_SQL}
SELECT booking_id, CASE WHEN booking_id % 5 IN (0, 1, 2) THEN NULL ELSE adr END AS adr, children
FROM raw_bookings"""
)
def nonfinite(spark, sf_dir):
    spoilt = (
        F.when(F.col("booking_id") % 5 == 0, float("nan"))
        .when(F.col("booking_id") % 5 == 1, float("inf"))
        .when(F.col("booking_id") % 5 == 2, float("-inf"))
        .otherwise(F.col("adr"))
    )
    rows = raw_bookings(spark, sf_dir).select("booking_id", spoilt.alias("adr"), "children")
    return cleaning.nonfinite_to_null(rows)


@query("""SELECT c_mktsegment, count(*) AS n FROM customer
          WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_mktsegment""")
def class_counts(spark, sf_dir):
    segment = F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("c_mktsegment")
    return value_counts(table(spark, sf_dir, "customer").select(segment), "c_mktsegment")


@query("SELECT DISTINCT year(o_orderdate)::BIGINT AS year FROM orders ORDER BY year")
def year_values(spark, sf_dir):
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("year"))
    return distinct_values(years, "year")


# -- contracts ------------------------------------------------------------------------


def _report_sql(contract: contracts.Contract, view: str) -> str:
    """The checks of a contract as one UNION ALL; the fields are the shared fixed values."""
    parts = []
    for f in contract.fields:
        c = f.name
        checks = [("present", "0"), (f"type({f.type})", "0")]
        if not f.nullable:
            checks.append(("not_null", f"count(*) FILTER (WHERE {c} IS NULL)"))
        if f.at_least is not None and f.at_most is not None:
            checks.append((f"in_range({f.at_least}, {f.at_most})",
                           f"count(*) FILTER (WHERE {c} NOT BETWEEN {f.at_least} AND {f.at_most})"))
        elif f.at_least is not None:
            checks.append((f"at_least({f.at_least})", f"count(*) FILTER (WHERE {c} < {f.at_least})"))
        if f.allowed is not None:
            values = ", ".join(str(v) for v in f.allowed)
            checks.append((f"is_in({values})", f"count(*) FILTER (WHERE {c} NOT IN ({values}))"))
        parts += [f'SELECT \'{contract.stage}\' AS stage, \'{c}\' AS "column", \'{name}\' AS "check", '
                  f"({n})::BIGINT AS n_failed FROM {view}" if n != "0" else
                  f'SELECT \'{contract.stage}\', \'{c}\', \'{name}\', 0::BIGINT' for name, n in checks]
    if contract.non_empty:
        parts.append(f"SELECT '{contract.stage}', '*', 'not_empty', "
                     f"CASE WHEN count(*) > 0 THEN 0 ELSE 1 END::BIGINT FROM {view}")
    return " UNION ALL ".join(parts)


@query(
    f"""WITH {RAW_BOOKINGS_SQL}, processed AS (
  SELECT *, month(strptime(arrival_date_month, '%B'))::BIGINT AS month FROM raw_bookings)
SELECT stage, "column", "check", n_failed FROM (
  SELECT NULL::VARCHAR AS stage, NULL::VARCHAR AS "column", NULL::VARCHAR AS "check",
         NULL::BIGINT AS n_failed WHERE false
  UNION ALL {_report_sql(contracts.RAW_BOOKINGS, "raw_bookings")}
  UNION ALL {_report_sql(contracts.PROCESSED_BOOKINGS, "processed")})"""
)
def contract_failures(spark, sf_dir):
    raw = raw_bookings(spark, sf_dir)
    processed = cleaning.map_month_name(raw)
    return contracts.failure_report(raw, contracts.RAW_BOOKINGS).unionByName(
        contracts.failure_report(processed, contracts.PROCESSED_BOOKINGS)
    )


@query(
    f"""WITH {RAW_BOOKINGS_SQL}
SELECT booking_id, n_reasons, accepted FROM (
  SELECT booking_id,
         ((lead_time IS NULL)::INT + coalesce(lead_time < 0, false)::INT
          + (children IS NULL)::INT + (adr < 0)::INT
          + (agent < 0)::INT * 0)::INT AS n_reasons,
         coalesce(lead_time >= 0, false) AND children IS NOT NULL AND adr >= 0 AS accepted
  FROM (SELECT * REPLACE (coalesce(agent, 0) AS agent) FROM raw_bookings))"""
)
def contract_scoring(spark, sf_dir):
    rows = cleaning.map_month_name(raw_bookings(spark, sf_dir))
    judged = contracts.judge_scoring_rows(rows, keep=("booking_id",))
    n_reasons = F.size("reasons")
    return judged.select(
        "booking_id", n_reasons.alias("n_reasons"), (n_reasons == 0).alias("accepted")
    )


@query(
    """SELECT event_id, value, k FROM (
         SELECT event_id, value, (props->>'$.k')::BIGINT AS k FROM events)
       WHERE k BETWEEN 10 AND 90 AND value >= 0.5"""
)
def contract_events(spark, sf_dir):
    fields = (
        contracts.ScoringField(contracts.Field("value", "double", at_least=0.5)),
        contracts.ScoringField(contracts.Field("k", "bigint", at_least=10, at_most=90)),
        contracts.ScoringField(contracts.Field("absent", "bigint", at_least=0), 0, True),
    )
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    accepted, _ = contracts.validate_scoring_rows(events, fields, keep=("event_id",))
    return accepted.drop("absent")


# -- samples and splits ---------------------------------------------------------------

_DRAW = f"md5('{SEED}:' || booking_id::VARCHAR)"


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}, counts AS (
  SELECT market_segment, count(*) AS n FROM sound_bookings GROUP BY 1 HAVING count(*) >= 10),
ranked AS (
  SELECT booking_id, market_segment,
         row_number() OVER (PARTITION BY market_segment ORDER BY {_DRAW}) AS r
  FROM sound_bookings WHERE market_segment IN (SELECT market_segment FROM counts))
SELECT booking_id, market_segment FROM ranked
WHERE r <= ceil(1000.0 / (SELECT count(*) FROM counts))"""
)
def sample_quota(spark, sf_dir):
    rows = sound_bookings(spark, sf_dir).select("booking_id", "market_segment")
    return sampling.stratified_quota_sample(rows, "market_segment", "booking_id", 1000, 10, SEED)


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}, ranked AS (
  SELECT booking_id, adr, row_number() OVER (ORDER BY {_DRAW}) AS r FROM sound_bookings)
SELECT booking_id, adr FROM ranked WHERE r <= 2000"""
)
def sample_seeded(spark, sf_dir):
    rows = sound_bookings(spark, sf_dir).select("booking_id", "adr")
    return sampling.seeded_sample(rows, "booking_id", 2000, SEED)


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}
SELECT booking_id, row_number() OVER (ORDER BY {_DRAW}) - 1 AS position FROM sound_bookings"""
)
def sample_shuffled(spark, sf_dir):
    """A seeded shuffle written to files: the place of every row in the order of the files."""
    rows = sound_bookings(spark, sf_dir).select("booking_id")
    path = scratch_path(spark, "shuffled")
    sampling.seeded_shuffle(rows, "booking_id", SEED).write.parquet(path)
    written = spark.read.parquet(path).select(
        "booking_id",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    return with_position(written, "file", "row").select("booking_id", "position")


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}, ranked AS (
  SELECT booking_id, market_segment,
         row_number() OVER (PARTITION BY market_segment ORDER BY {_DRAW}) AS r,
         count(*) OVER (PARTITION BY market_segment) AS n FROM sound_bookings),
sized AS (SELECT *, floor(n * 0.4::DOUBLE + 0.5) AS held FROM ranked)
SELECT booking_id, market_segment,
       CASE WHEN r <= n - held THEN 'train'
            WHEN r <= n - floor(held * 0.5::DOUBLE + 0.5) THEN 'validation'
            ELSE 'test' END AS split
FROM sized"""
)
def split_three_way(spark, sf_dir):
    rows = sound_bookings(spark, sf_dir).select("booking_id", "market_segment")
    return sampling.stratified_split(rows, "market_segment", "booking_id", SEED)


@query(
    """WITH years AS (SELECT year(o_orderdate)::BIGINT AS year, o_totalprice FROM orders)
SELECT CASE WHEN year = (SELECT max(year) FROM years) THEN 'future' ELSE 'past' END AS side,
       year, count(*) AS n FROM years GROUP BY 1, 2"""
)
def split_temporal(spark, sf_dir):
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("year"))
    past, future = sampling.temporal_split(years, "year")
    sides = past.withColumn("side", F.lit("past")).unionByName(
        future.withColumn("side", F.lit("future"))
    )
    return sides.groupBy("side", "year").agg(F.count("*").alias("n"))


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}
SELECT booking_id, market_segment, month(strptime(arrival_date_month, '%B'))::BIGINT AS month
FROM sound_bookings
WHERE arrival_date_year = 1997 AND arrival_date_month IN ('May', 'June', 'July')"""
)
def replay_slice(spark, sf_dir):
    rows = cleaning.map_month_name(sound_bookings(spark, sf_dir))
    picked = sampling.slice_for_replay(rows, year=1997, months=[5, 6, 7])
    return picked.select("booking_id", "market_segment", "month")


@query(
    """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 100 < 80 AS labelled
FROM orders"""
)
def label_fraction(spark, sf_dir):
    return sampling.label_fraction(
        table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.8
    )


@query(
    """WITH drawn AS (
  SELECT o_orderkey, ('0x' || substr(md5('42:' || o_orderkey::VARCHAR), 1, 8))::BIGINT
                     / 4294967296.0::DOUBLE AS p FROM orders)
SELECT CASE WHEN p < 1 - 0.2::DOUBLE - 0.2::DOUBLE THEN 'train'
            WHEN p < 1 - 0.2::DOUBLE THEN 'validation' ELSE 'test' END AS split,
       count(*) AS n FROM drawn GROUP BY 1"""
)
def split_hashed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    split = sampling.hashed_split(orders, "o_orderkey", SEED)
    return split.groupBy("split").agg(F.count("*").alias("n"))
