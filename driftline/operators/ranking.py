"""Exact rank cut points inside few, huge groups, without shuffling the rows.

A window over a 5-valued class is five tasks however large the cluster is. Here the
order of the rows is spelled as digits of bounded cardinality (12 bits of a hash, a
minute, a second, ...). Counting rows per (group, digit) is a map-side combined
aggregate whose result is small; its running sum tells in which digit a wanted rank
falls, and only the rows of that digit are looked at further. What comes back is one
row per group: the order value of the wanted rank. Selecting or splitting is then a
plain comparison per row, next to a broadcast of that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import draw, draw_digits
from ..runtime import SmallSide, Staging, null_safe_join, small_side, stage_table

# Rows of one boundary digit up to which one task ranks them directly.
TASK_ROWS = 1_000_000

_DIGIT = "__digit{}"


def _digit_names(n: int) -> list[str]:
    return [_DIGIT.format(i) for i in range(n)]


def order_value(digits: list[Column]) -> Column:
    """The digits as one comparable value."""
    return F.struct(*[d.alias(name) for d, name in zip(digits, _digit_names(len(digits)))])


def rank_cuts(
    df: DataFrame,
    groups: list[str],
    digits: list[Column],
    takes: dict[str, Column],
    task_rows: int = TASK_ROWS,
) -> SmallSide:
    """Order value of the wanted ranks: one row per group with a struct per cut.

    ``takes`` maps a cut name to an expression over ``group_size``; ranks beyond the
    group are clipped to its size and a cut of 0 rows or less gives null. The digits
    together must order the rows of a group totally: rows that tie across a cut raise.
    """
    names = _digit_names(len(digits))
    keyed = df.select(*groups, *[d.alias(name) for d, name in zip(digits, names)])
    with Staging(df.sparkSession) as staging:
        # groups and digits once: no pass computes the caller's rows again
        return _staged_cuts(staging.put(keyed, "digits"), groups, names, takes, task_rows)


def _staged_cuts(
    keyed: DataFrame, groups: list[str], names: list[str], takes: dict[str, Column], task_rows: int
) -> SmallSide:
    whole = Window.partitionBy(*groups)
    wanted = F.array(
        *[F.struct(F.lit(cut).alias("cut"), take.cast("long").alias("take"))
          for cut, take in takes.items()]
    )
    histogram = (
        keyed.groupBy(*groups, names[0]).agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(whole.orderBy(names[0])))
        .withColumn("group_size", F.sum("n").over(whole))
        .select("*", F.inline(wanted))
        .withColumn("take", F.least("take", "group_size"))
    )
    edges = _boundary(histogram, [*groups, "cut", names[0]])
    known = 1
    while known < len(names) - 1 and not _fits_one_task(edges, task_rows):
        histogram = (
            _inside(keyed, edges, [*groups, *names[:known]])
            .groupBy(*groups, "cut", *names[: known + 1])
            .agg(F.count("*").alias("n"), F.first("left").alias("take"))
            .withColumn(
                "upto",
                F.sum("n").over(Window.partitionBy(*groups, "cut").orderBy(names[known])),
            )
        )
        known += 1
        edges = _boundary(histogram, [*groups, "cut", *names[:known]])

    order = Window.partitionBy(*groups, "cut").orderBy(*names[known:])
    edge = F.struct(*names)
    tied = F.raise_error(F.lit("the key repeats: rows on both sides of a cut share it"))
    found = (
        _inside(keyed, edges, [*groups, *names[:known]])
        .withColumns({"rank": F.row_number().over(order), "next": F.lead(edge).over(order)})
        .filter("rank = left")
        .select(*groups, "cut", F.when(F.col("next") == edge, tied).otherwise(edge).alias("edge"))
    )
    per_group = found.groupBy(*groups).agg(
        *[F.max(F.when(F.col("cut") == cut, F.col("edge"))).alias(cut) for cut in takes]
    )
    return small_side(per_group)


def _boundary(histogram: DataFrame, keys: list[str]) -> SmallSide:
    """The digit each wanted rank falls into, with the rank left inside of it."""
    hit = histogram.filter("upto >= take AND upto - n < take")
    return small_side(hit.select(*keys, "n", (F.col("take") - F.col("upto") + F.col("n")).alias("left")))


def _inside(keyed: DataFrame, edges: SmallSide, keys: list[str]) -> DataFrame:
    return null_safe_join(keyed, edges.df, keys, "inner")


def _fits_one_task(edges: SmallSide, task_rows: int) -> bool:
    if edges.is_small:
        sizes = edges.rows.column("n").to_pylist()
    else:
        sizes = [edges.df.agg(F.max("n")).first()[0]]
    return max(sizes, default=0) <= task_rows


def with_cuts(df: DataFrame, groups: list[str], cuts: SmallSide) -> DataFrame:
    """The cut columns of its group next to every row; groups without a cut get nulls."""
    if groups:
        return null_safe_join(df, cuts.df, groups, "left")
    # one group, so at most one row of cuts: literals instead of a join
    row = cuts.rows.to_pylist()[0] if cuts.rows.num_rows else {}
    literals = {}
    for field in cuts.df.schema.fields:
        value = row.get(field.name)
        if value is None:
            literals[field.name] = F.lit(None).cast(field.dataType)
        else:
            parts = [F.lit(v).alias(name) for name, v in value.items()]
            literals[field.name] = F.struct(*parts).cast(field.dataType)
    return df.withColumns(literals)


def drawn_first(
    df: DataFrame, groups: list[str], key: str, seed: int, take: Column
) -> DataFrame:
    """The first ``take`` rows of each group in the order of their draw.

    ``key`` must identify a row: copies of one key share a draw, and raise if a cut meets them.
    """
    drawn = df.withColumn("__draw", draw(seed, key))
    digits = draw_digits("__draw")
    cuts = rank_cuts(drawn, groups, digits, {"__last": take})
    return (
        with_cuts(drawn, groups, cuts)
        .filter(order_value(digits) <= F.col("__last"))
        .drop("__last", "__draw")
    )


def with_position(df: DataFrame, *order: str | Column) -> DataFrame:
    """Adds ``position``: 0, 1, 2, ... over the whole table in the given order.

    One range shuffle, then each range numbers its own rows and adds the sizes of the
    ranges before it. The ranges are staged, since a recomputed range shuffle need not
    cut at the same keys.
    """
    row_in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = stage_table(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__range", F.spark_partition_id())
        .withColumn("__row", row_in_range),
        "positions",
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small_side(
        ranges.groupBy("__range").agg(F.count("*").alias("n"))
        .select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    )
    return (
        ranges.join(offsets.df, "__range")
        .withColumn("position", F.col("__offset") + F.col("__row"))
        .drop("__range", "__row", "__offset")
    )
