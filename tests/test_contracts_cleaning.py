import pytest
from pyspark.sql import functions as F

from driftline.operators import cleaning, contracts
from driftline.operators.features import BOOKING_SPEC, ModelInputs
from driftline.sources import bookings
from rows import RAW, raw_bookings, schema

# -- cleaning -------------------------------------------------------------------------


def test_duplicates_rare_class_and_month(spark):
    df = raw_bookings(
        spark, {}, {}, {"lead_time": 2}, {"lead_time": 3},
        {"market_segment": "Aviation", "lead_time": 4},
    )
    clean, removed = cleaning.clean_bookings(df, min_class_count=2)
    assert clean.count() == 3
    assert {row.month for row in clean.collect()} == {7}
    assert "arrival_date_month" not in clean.columns
    assert (removed.rows_in, removed.duplicates, removed.negative, removed.rare_class) == (5, 1, 0, 1)
    assert removed.any


def test_negative_rate_goes_and_class_counts_follow(spark):
    groups = [{"market_segment": "Groups", "adr": rate, "lead_time": 8} for rate in (-0.01, 0.0, -400.0)]
    df = raw_bookings(spark, {}, {"adr": 0.0, "lead_time": 2}, *groups)
    clean, removed = cleaning.clean_bookings(df, min_class_count=2)
    # nothing is below zero but two rates of a class, which then is too small
    assert {row.market_segment for row in clean.collect()} != {"Groups"} and clean.count() == 2
    assert (removed.negative, removed.rare_class) == (2, 1)


def test_missing_rate_survives_the_filter_and_fails_the_contract(spark):
    df = raw_bookings(spark, {}, {"adr": None}, {"adr": -1.0})
    assert cleaning.drop_negative(df, "adr").count() == 2
    with pytest.raises(contracts.ContractError, match="processed.*adr not_null: 1"):
        cleaning.clean_bookings(df, min_class_count=1)


def test_missing_column_and_bad_week(spark):
    with pytest.raises(contracts.ContractError, match="raw.*adr present"):
        cleaning.clean_bookings(raw_bookings(spark, {}).drop("adr"), 1)
    for week in (0, 54):  # one beside the first and one beside the last
        with pytest.raises(contracts.ContractError, match="arrival_date_week_number in_range.*: 1"):
            cleaning.clean_bookings(raw_bookings(spark, {"arrival_date_week_number": week}), 1)


def test_unknown_month_fails_the_processed_contract(spark):
    with pytest.raises(contracts.ContractError, match="month not_null: 1"):
        cleaning.clean_bookings(raw_bookings(spark, {}, {"arrival_date_month": "july"}), 1)


def test_emptied_table_fails(spark):
    with pytest.raises(contracts.ContractError, match="not_empty"):
        cleaning.clean_bookings(raw_bookings(spark, {}), min_class_count=5)


def test_many_classes_take_the_join_path(spark):
    df = spark.range(3000).select((F.col("id") % 600).alias("c"), "id")
    df = df.unionByName(spark.createDataFrame([(9999, 1)], "c bigint, id bigint"))
    assert cleaning.drop_rare_classes(df, "c", 5).count() == 3000


def test_training_period(spark):
    df = raw_bookings(spark, {"arrival_date_year": 2015}, {"arrival_date_year": 2017},
                      {"arrival_date_year": None})
    assert cleaning.training_period(df, None).count() == 3
    assert cleaning.training_period(df, 2016).count() == 1
    assert cleaning.training_period(df.drop("arrival_date_year"), 2016).count() == 3


def test_payload(spark):
    df = spark.createDataFrame(
        [("Direct", None, None, None, float("nan"), 2.5)],
        "market_segment string, country string, agent double, babies bigint, adr double, x double",
    )
    row = cleaning.normalize_payload(df).first()
    assert row.asDict() == {"country": "Unknown", "agent": None, "babies": 0, "adr": 0.0, "x": 2.5}
    text = cleaning.normalize_payload(df).select(
        cleaning.payload_json(cleaning.normalize_payload(df)).alias("j")
    ).first().j
    assert text == '{"country":"Unknown","agent":null,"babies":0,"adr":0,"x":2.5}'


def test_payload_json_escapes(spark):
    df = spark.createDataFrame([('a "b"\n', 1e300)], "s string, big double")
    import json

    text = df.select(cleaning.payload_json(df).alias("j")).first().j
    assert json.loads(text) == {"s": 'a "b"\n', "big": 1e300}


# -- contracts ------------------------------------------------------------------------


def test_report_counts_all_failures_at_once(spark):
    df = cleaning.map_month_name(
        raw_bookings(spark, {"adults": -1, "agent": 0.0}, {"is_repeated_guest": 2, "hotel": None})
    )
    report = contracts.failure_report(df, contracts.PROCESSED_BOOKINGS)
    failed = {(r.column, r.check): r.n_failed for r in report.filter("n_failed > 0").collect()}
    assert failed == {
        ("adults", "at_least(0)"): 1,
        ("agent", "at_least(1)"): 1,
        ("is_repeated_guest", "is_in(0, 1)"): 1,
        ("hotel", "not_null"): 1,
    }
    reasons = {
        tuple(r.reasons) for r in contracts.failing_rows(df, contracts.PROCESSED_BOOKINGS).collect()
    }
    assert reasons == {
        ("adults: at_least(0)", "agent: at_least(1)"),
        ("hotel: not_null", "is_repeated_guest: is_in(0, 1)"),
    }


def test_wrong_type_is_reported_not_coerced(spark):
    df = raw_bookings(spark, {}).withColumn("lead_time", F.col("lead_time").cast("string"))
    with pytest.raises(contracts.ContractError, match=r"lead_time type\(bigint\): 1"):
        contracts.validate_raw(df)


def test_nan_is_missing(spark):
    df = cleaning.map_month_name(raw_bookings(spark, {"children": float("nan")}))
    assert contracts.validate_processed(df).count() == 1
    with pytest.raises(contracts.ContractError, match="adr not_null"):
        contracts.validate_processed(
            cleaning.map_month_name(raw_bookings(spark, {"adr": float("nan")}))
        )


def test_required_inputs_and_leaks(spark):
    with pytest.raises(contracts.ContractError, match="month"):
        contracts.require_inputs(raw_bookings(spark, {}), BOOKING_SPEC.sources())
    contracts.leak_guard(BOOKING_SPEC)
    for spec in (
        ModelInputs.of(number=("agent",)),
        ModelInputs.of(category=("distribution_channel",)),
    ):
        with pytest.raises(contracts.ContractError):
            contracts.leak_guard(spec)


def test_scoring_rows(spark):
    required = [
        f.rule.name for f in contracts.SCORING_BOOKINGS if not f.optional
    ]
    assert len(required) == 14
    df = cleaning.map_month_name(raw_bookings(spark, {}, {"adr": -1.0}, {"agent": 0.0}))
    accepted, rejected = contracts.validate_scoring_rows(df.select(*required, "agent"))
    assert "reservation_status" not in accepted.columns
    assert accepted.count() == 2
    row = accepted.first()
    assert (row.children, row.babies, row.company) == (0.0, 0, None)
    assert [r.reasons for r in rejected.collect()] == [["adr: at_least(0)"]]


def test_scoring_rejects_missing_and_unreadable(spark):
    df = cleaning.map_month_name(raw_bookings(spark, {"country": None}))
    df = df.withColumn("adults", F.lit("two")).drop("meal").withColumn("babies", F.lit(1.5))
    _, rejected = contracts.validate_scoring_rows(df)
    assert set(rejected.first().reasons) >= {
        "country: not_null", "adults: type(bigint)", "meal: required", "babies: type(bigint)"
    }


# -- files ----------------------------------------------------------------------------


def test_csv_round_trip(spark, tmp_path):
    path = tmp_path / "raw.csv"
    names = [" Hotel", "Market_Segment ", "adr", "Lead Time", "children", "agent"]
    path.write_text(
        ",".join(names) + "\n"
        "City,Direct,100.5,3,,NULL\n"
        " NA ,Direct,n/a,x,1,9\n"
    )
    df = bookings.read_bookings_csv(spark, str(path))
    assert df.columns == ["hotel", "market_segment", "adr", "lead_time", "children", "agent"]
    first, second = df.collect()
    assert tuple(first) == ("City", "Direct", 100.5, 3, None, None)
    assert tuple(second) == (None, "Direct", None, None, 1.0, 9.0)
    text = bookings.normalize_columns(bookings.read_csv_text(spark, str(path)))
    failures = {r.column: r.n_failed for r in
                contracts.cast_failures(text, {"lead_time": "bigint", "adr": "double"}).collect()}
    assert failures == {"lead_time": 1, "adr": 0}
    bookings.write_processed(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    bookings.write_processed(df, str(tmp_path / "out_csv"), "csv")
    assert bookings.read_bookings_csv(spark, str(tmp_path / "out_csv")).count() == 2


def test_colliding_names_raise(spark):
    with pytest.raises(ValueError, match="collide"):
        bookings.normalize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `A_B` int"))


def test_overwriting_the_input_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="overwrite"):
        bookings.write_processed(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 3


def test_sound_rows_are_accepted_without_a_list_of_reasons(spark):
    fields = (
        contracts.ScoringField(contracts.Field("n", "bigint", at_least=0)),
        contracts.ScoringField(contracts.Field("x", "double", at_least=0, at_most=9)),
        contracts.ScoringField(contracts.Field("kind", "string", allowed=("a", "b"))),
        contracts.ScoringField(contracts.Field("free", "double", nullable=True, at_least=0), None, True),
    )
    nan = float("nan")
    rows = [(1, 1.0, "a", None), (-1, 1.0, "a", 1.0), (None, 1.0, "b", 1.0), (2, nan, "b", 1.0), (3, 9.5, "a", 1.0),
            (4, 9.0, "c", 1.0), (5, None, "a", 1.0), (6, 0.0, None, 1.0), (7, 0.0, "b", -1.0), (8, 0.0, "b", nan)]
    typed = spark.createDataFrame(rows, "n long, x double, kind string, free double")
    text = typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns])
    for df in (typed, text):
        accepted, refused = contracts.validate_scoring_rows(df, fields)
        judged = contracts.judge_scoring_rows(df, fields)
        sound = judged.filter(F.size("reasons") == 0).drop("reasons").collect()
        assert accepted.columns == typed.columns
        assert sorted(map(str, accepted.collect())) == sorted(map(str, sound))
        assert {1} <= {r.n for r in sound} and len(sound) + refused.count() == len(rows)
    accepted, _ = contracts.validate_scoring_rows(typed, fields)
    assert "n: at_least" not in accepted._jdf.queryExecution().optimizedPlan().toString()
