import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftline.functions.values import draw, draw_digits
from driftline.operators import sampling
from driftline.operators.ranking import order_value, rank_cuts, with_cuts, with_position


def drawn(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds most rows, one a single row, one has no name."""
    c = (
        F.when(F.col("id") < 4000, "big")
        .when(F.col("id") < 4900, "mid")
        .when(F.col("id") < 4999, None)
        .otherwise("one")
    )
    return spark.range(5000).select("id", c.alias("c")).cache()


@pytest.mark.parametrize("task_rows", [1_000_000, 0])
def test_cuts_equal_plain_ranks(skewed, task_rows):
    digits = draw_digits(draw(1, "id"))
    takes = {"a": F.lit(10), "b": F.floor(F.col("group_size") * 0.5), "none": F.lit(0)}
    cuts = rank_cuts(skewed, ["c"], digits, takes, task_rows)
    got = with_cuts(skewed, ["c"], cuts).select(
        "c", "id",
        (order_value(digits) <= F.col("a")).alias("a"),
        (order_value(digits) <= F.col("b")).alias("b"),
        F.col("none").isNull().alias("none"),
    ).collect()
    groups = {}
    for row in got:
        groups.setdefault(row.c, []).append(row)
    assert len(got) == 5000 and set(groups) == {"big", "mid", None, "one"}
    for rows in groups.values():
        ordered = sorted(rows, key=lambda r: drawn(1, r.id))
        assert [r.id for r in ordered if r.a] == [r.id for r in ordered[:10]]
        half = len(rows) // 2
        assert sum(bool(r.b) for r in rows) == half
        assert all(r.b for r in ordered[:half])
        assert all(r.none for r in rows)


def test_coarse_digits_descend_through_all_levels(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("hi"), (F.col("id") % 7).alias("lo"))
    digits = [F.col("hi"), F.col("lo"), F.col("id")]
    cuts = rank_cuts(df, [], digits, {"cut": F.lit(437)}, task_rows=1)
    kept = with_cuts(df, [], cuts).filter(order_value(digits) <= F.col("cut"))
    want = sorted(range(1000), key=lambda i: (i % 3, i % 7, i))[:437]
    assert {r.id for r in kept.collect()} == set(want)


def test_seeded_sample(spark):
    df = spark.range(500)
    got = {r.id for r in sampling.seeded_sample(df, "id", 50, 7).collect()}
    assert got == set(sorted(range(500), key=lambda i: drawn(7, i))[:50])
    again = sampling.seeded_sample(df.repartition(13), "id", 50, 7)
    assert got == {r.id for r in again.collect()}
    assert sampling.seeded_sample(df, "id", 900, 7).count() == 500
    assert sampling.seeded_sample(df.limit(0), "id", 5, 7).count() == 0


def test_quota_sample(skewed):
    df = skewed.filter("c IS NOT NULL")
    got = Counter(r.c for r in sampling.stratified_quota_sample(df, "c", "id", 1001, 2, 3).collect())
    assert got == {"big": math.ceil(1001 / 2), "mid": math.ceil(1001 / 2)}
    small = sampling.stratified_quota_sample(df, "c", "id", 3000, 1, 3)
    assert Counter(r.c for r in small.collect()) == {"big": 1000, "mid": 900, "one": 1}
    assert sampling.stratified_quota_sample(df, "c", "id", 10, 9999, 3).count() == 0


def test_three_way_split(skewed):
    got = sampling.stratified_split(skewed, "c", "id", 42)
    rows = got.collect()
    assert len(rows) == len({r.id for r in rows}) == 5000
    sizes = Counter((r.c, r.split) for r in rows)
    assert [sizes["big", s] for s in ("train", "validation", "test")] == [2400, 800, 800]
    assert [sizes["mid", s] for s in ("train", "validation", "test")] == [540, 180, 180]
    assert sizes["one", "train"] == 1
    again = {(r.id, r.split) for r in sampling.stratified_split(
        skewed.repartition(11), "c", "id", 42).collect()}
    assert again == {(r.id, r.split) for r in rows}
    other = sampling.stratified_split(skewed, "c", "id", 43)
    assert {(r.id, r.split) for r in other.collect()} != again


def test_temporal_split(spark):
    df = spark.createDataFrame([(2015,), (2016,), (2017,), (2017,), (None,)], "y int")
    past, future = sampling.temporal_split(df, "y")
    assert (past.count(), future.count()) == (2, 2)
    assert sampling.temporal_split(df.filter("y = 2017"), "y") is None
    assert sampling.temporal_split(df.limit(0), "y") is None


def test_positions_and_label_fraction(spark):
    df = spark.range(1000, 0, -1).repartition(5)
    rows = with_position(df, "id").collect()
    assert {(r.id, r.position) for r in rows} == {(i + 1, i) for i in range(1000)}
    labelled = sampling.label_fraction(df, "id", 0.255).filter("labelled").collect()
    assert {r.id for r in labelled} == {i + 1 for i in range(1000) if i % 100 < round(25.5)}


def test_replay_slice_and_shuffle(spark):
    df = spark.createDataFrame(
        [(2016, 5), (2017, 5), (2017, 8)], "arrival_date_year int, month int"
    )
    assert sampling.slice_for_replay(df).count() == 3
    assert sampling.slice_for_replay(df, year=2017).count() == 2
    assert sampling.slice_for_replay(df, year=2017, months=[5, 6]).count() == 1
    order = [r.id for r in sampling.seeded_shuffle(spark.range(50), "id", 1).collect()]
    assert order == sorted(range(50), key=lambda i: drawn(1, i))


def test_a_repeated_key_raises_where_the_cut_meets_it(spark):
    rows = spark.range(20).selectExpr("1 AS id", "id AS x")
    with pytest.raises(Exception, match="the key repeats"):
        sampling.seeded_sample(rows, "id", 3, 7).collect()
