"""Bloom filters as plain columns: built by bit_or, read through a one-row table.

A filter is a one-row table holding ``array<bigint>``, at most ``MAX_WORDS`` words of 64 bits
(8 MB), whatever the number of keys: with more keys than it was sized for it lets more rows
through, never fewer. Nothing here runs Python on executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import null_safe_join
from .common import Stages

#: Proven bound of what is broadcast: words of 64 bits in one filter.
MAX_WORDS = 1 << 20


def words_for(keys: int, bits_per_key: float) -> int:
    """Words of a filter: a power of two, at least one, never above the bound."""
    words = 1
    while words * 64 < keys * bits_per_key and words < MAX_WORDS:
        words *= 2
    return words


def slots(key: Column, words: int, probes: int, seed: int) -> list[Column]:
    """Positions of the bits of a key."""
    return [
        F.pmod(F.xxhash64(key, F.lit(seed * 64 + probe)), F.lit(words * 64))
        for probe in range(probes)
    ]


def bitmap(slot_rows: DataFrame, words: int) -> DataFrame:
    """One row with the bits of all rows' ``slot`` set; words no slot touches are zero."""
    spark = slot_rows.sparkSession
    set_bits = slot_rows.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot % 64))")).alias("bits")
    )
    empty = spark.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = set_bits.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return dense.agg(F.transform(ordered, lambda entry: entry["bits"]).alias("bitmap"))


def has_bits(filter_row: DataFrame, positions: list[Column]) -> Column:
    """Whether every position is set in the filter."""
    words = filter_row.scalar()
    tests = [
        F.getbit(F.element_at(words, (F.shiftright(p, 6) + 1).cast("int")), (p % 64).cast("int"))
        == 1
        for p in positions
    ]
    return reduce(Column.__and__, tests)


def passing(
    rows: DataFrame, filter_row: DataFrame, positions: list[Column], inside: bool = True
) -> DataFrame:
    """The rows of which every position is set in the filter, or else the other rows.

    The filter is broadcast once. Where ``has_bits`` reads it, it is a constant of every probe, so
    the driver holds some copies of it for each stage that tests rows: too much for a large one.
    """
    tests = [
        F.getbit(F.element_at("__bits", (F.shiftright(p, 6) + 1).cast("int")), (p % 64).cast("int"))
        == 1
        for p in positions
    ]
    held = reduce(Column.__and__, tests)
    joined = rows.join(F.broadcast(filter_row.toDF("__bits")), held if inside else ~held)
    return joined.drop("__bits")


def bloom(keys: DataFrame, column: str, words: int, probes: int, seed: int) -> DataFrame:
    """The filter of all keys of a column."""
    marked = keys.select(F.explode(F.array(*slots(F.col(column), words, probes, seed))).alias("slot"))
    return bitmap(marked, words)


def without(
    stages: Stages, rows: DataFrame, dropped: DataFrame, on: list[str], null_safe: bool = False
) -> DataFrame:
    """Rows whose key is not in ``dropped``; only rows that a filter of it may hold are shuffled.

    A key with a null in it is never dropped, or with ``null_safe`` as any other.
    """
    dropped = dropped.select(*on).distinct().withColumn("__key", F.xxhash64(*on))
    words = words_for(max(1, dropped.count()), 12)
    held = stages.put(bloom(dropped, "__key", words, 3, 7), "dropped-bits")
    places = slots(F.xxhash64(*on), words, 3, 7)
    held_rows, gone = passing(rows, held, places), dropped.select(*on)
    if null_safe:
        left = null_safe_join(held_rows, gone, on, "left_anti")
    else:
        left = held_rows.join(gone, on, "left_anti")
    return passing(rows, held, places, inside=False).unionByName(left.select(*rows.columns))
