"""Exact deduplication by two Bloom passes: only rows whose hash may repeat are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bitmap, has_bits, slots, words_for
from .common import Stages, ascii_lower, whole_text

BITS_PER_ROW = 16
PROBES = 2


def text_digest(column: str):
    """SHA-256 of the text after lower-casing A-Z; null counts as empty."""
    return F.sha2(ascii_lower(whole_text(column)), 256)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stages: Stages | None = None
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    First pass: the digests of all rows are written as a narrow table, and every digest marks
    ``PROBES`` slots; slots marked twice or more become a bitmap. Second pass: a row whose slots
    are not all in it is alone and passes straight through; the others are grouped by digest.
    Rows are counted per slot before any shuffle, so a text that many rows hold is no hot spot.
    The bitmap has a fixed upper size; beyond it more rows are grouped and the result is the same.

    Null and empty texts are equal. Of equal texts the largest id stays; rows that repeat both
    id and text stay or go together; a null id stays only if its group has no other. An empty
    table gives no rows. Other columns are not read, whatever their names.
    """
    stages = stages or Stages(docs.sparkSession)
    rows = stages.put(
        docs.select(F.col(f"`{id_col}`").alias("id"), text_digest(text_col).alias("sha")), "digests"
    )
    words = words_for(max(1, rows.count()), BITS_PER_ROW)
    positions = slots(F.col("sha"), words, PROBES, 0)
    marks = rows.select(F.explode(F.array_distinct(F.array(*positions))).alias("slot"))
    repeated = marks.groupBy("slot").count().filter("count > 1").select("slot")
    filter_row = stages.put(bitmap(repeated, words), "repeated-bits")
    maybe = has_bits(filter_row, positions)
    alone = rows.filter(~maybe).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha"
    )
    suspects = rows.filter(maybe)
    groups = suspects.groupBy("sha").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    grouped = suspects.join(groups, "sha").select("id", "keep_id", "group_size", "sha")
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
