"""Near duplicates by b-bit MinHash: bands, collision-corrected estimates, confirmed links."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .block_links import cluster_links
from .common import Stages, ship, slices, whole_text
from .components import components
from .shingles import FOLD, confirmed, mix, shingle_set

ship(__name__)

#: Minima, and the bits kept of each, in planes of longs.
POSITIONS = 1024
LOW_BITS = 2
LANES = POSITIONS // 64
#: Chance that two texts just at the bound share no band.
MISSED = 3e-7
#: Pairs that are estimated further below the bound are not worth an early confirmation.
MARGIN = 0.064
BLOCK = 256
#: Bucket ends of either kind that an id is confirmed against before the blocks are.
STARS = 2

def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of the hash functions."""
    numbers = mix(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64) * FOLD).astype(np.uint32)
    return numbers[:POSITIONS] | np.uint32(1), numbers[POSITIONS:]


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, minima in each) for a bound: a band is shared by about a third of the pairs there."""
    if not 0 < percent < 100:
        raise ValueError(f"percent must lie between 0 and 100, not {percent}")
    alike = percent / 100
    rows = min(25, max(1, round(math.log(1 / 3) / math.log(alike))))
    bands = math.ceil(math.log(MISSED) / math.log(1 - alike**rows))
    if bands * rows > POSITIONS:
        raise ValueError(f"{POSITIONS} minima are too few for {percent} percent")
    return bands, rows


def sketch(shingles: np.ndarray, percent: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """(bit planes of the hashed minima's low bits, band hashes), both as signed longs.

    A minimum's own low bits follow from those of its element, as the factors are odd: in small
    sets they differ together. A hash of minimum and position makes them independent.
    """
    times, plus = _multipliers()
    minima = np.full(POSITIONS, np.iinfo(np.uint32).max, np.uint32)
    halves = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(halves), BLOCK):
        block = halves[start : start + BLOCK, None] * times
        block += plus
        np.minimum(minima, block.min(axis=0), out=minima)
    mixed = mix(minima + np.arange(1, POSITIONS + 1, dtype=np.uint64) * FOLD)
    planes = [
        np.packbits(((mixed >> np.uint64(bit)) & np.uint64(1)).astype(bool), bitorder="little")
        for bit in range(LOW_BITS)
    ]
    number, rows = bands_for(percent)
    bands = np.arange(number, dtype=np.uint64)
    for row in minima[: number * rows].reshape(number, rows).T:
        bands = bands * FOLD + row
    return np.concatenate(planes).view(np.int64), mix(bands).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) for r in rows])
    values = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def sketches(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows (id, digest of the set, n_shingles, planes, bands) from rows (id, text)."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.empty(0, np.int64)
        for batch in slices(batches):
            digests, sizes, planes, bands = [], [], [], []
            for text in batch.column(1).to_pylist():
                shingles = shingle_set(text, width)
                sizes.append(len(shingles))
                if len(shingles):
                    digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    bits, hashes = sketch(shingles, percent)
                else:
                    digests.append(None)
                    bits = hashes = nothing
                planes.append(bits)
                bands.append(hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    _lists(planes),
                    _lists(bands),
                ],
                names=["id", "digest", "n_shingles", "planes", "bands"],
            )

    return docs.mapInArrow(
        sketched,
        "id long, digest binary, n_shingles long, planes array<bigint>, bands array<bigint>",
    )


def estimate(left: str, right: str) -> Column:
    """Similarity from two signatures: positions whose low bits agree, freed of chance hits."""
    differing = F.lit(0)
    for lane in range(LANES):
        apart = F.lit(0).cast("long")
        for bit in range(LOW_BITS):
            at = bit * LANES + lane
            apart = apart.bitwiseOR(F.col(left)[at].bitwiseXOR(F.col(right)[at]))
        differing = differing + F.bit_count(apart)
    chance = 1 / (1 << LOW_BITS)
    return (1 - differing / POSITIONS - chance) / (1 - chance)


def with_planes(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) with the estimate of their similarity."""
    planes = reps.select("id", "planes")
    left = planes.select(F.col("id").alias("a"), F.col("planes").alias("planes_a"))
    right = planes.select(F.col("id").alias("b"), F.col("planes").alias("planes_b"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", estimate("planes_a", "planes_b").alias("estimate"))


def star_pairs(shared: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """For every representative the smallest and the largest bucket members it meets most often.

    The number of shared bands ranks them, so no more than 2 * STARS pairs of an id are joined.
    """
    per_end = [
        shared.select("id", F.lit(end).alias("end"), F.col(end).alias("other"))
        for end in ("low", "high")
    ]
    met = per_end[0].unionByName(per_end[1]).filter("id <> other")
    met = met.groupBy("id", "end", "other").agg(F.count(F.lit(1)).alias("bands"))
    best = W.partitionBy("id", "end").orderBy(F.desc("bands"), "other")
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= STARS)
    pairs = ranked.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
    likely = with_planes(pairs.distinct(), reps).filter(F.col("estimate") >= least)
    return likely.select("a", "b")


def open_clusters(stages: Stages, shared: DataFrame, found: DataFrame, sizes: DataFrame) -> DataFrame:
    """Staged rows (id, cluster, component, weight) of texts that still have something to test.

    These are the members of buckets that hold more than one component; buckets with a member in
    common are one cluster.
    """
    placed = shared.select("bucket", "low", "id").join(found, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("bucket").agg(F.min("component") != F.max("component"))
    mixed = stages.put(mixed.toDF("bucket", "mixed").filter("mixed").select("bucket"), "mixed")
    still = placed.join(mixed, "bucket", "left_semi")
    clusters = components(stages, still.select(F.col("id").alias("a"), F.col("low").alias("b")))
    clusters = clusters.select("id", F.col("component").alias("cluster"))
    members = still.select("id", "component").distinct().join(clusters, "id")
    return stages.put(members.join(sizes, "id"), "open")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    stages: Stages | None = None,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Documents of equal shingle sets are one class, its smallest id speaks for it. Classes that
    share a band are candidates: first each is compared with the commonest of its buckets' ends by
    the packed low bits, and confirmed on the full sets if the estimate comes near the bound,
    which joins large groups of near copies at a linear cost; then the texts of buckets that
    still hold different components are tested on their full sets, block against block. So
    texts that link and share a band are never apart, whatever their estimate. A link is
    100 * intersection >= percent * union. Components are over the confirmed links; the smallest
    id of each is kept. The number of bands follows from ``percent``.

    Null texts count as empty; documents without words have no shingles and no links. A null id
    is linked with nothing, has a null component and is kept. Rows repeating an id belong to one
    component; each returns a row. Texts of any length are read whole. An empty table gives no
    rows. Other columns are not read.
    """
    stages = stages or Stages(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), whole_text(text_col).alias("text")
    )
    drawn = stages.put(sketches(rows, width, percent), "sketches")
    classes = stages.put(
        drawn.filter("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("rep")),
        "classes",
    )
    reps = stages.put(
        drawn.join(classes.withColumnRenamed("rep", "id"), ["id", "digest"], "left_semi")
        .select("id", "digest", "n_shingles", "planes", "bands")
        .dropDuplicates(["id", "digest"]),
        "representatives",
    )
    banded = reps.select("id", F.explode("bands").alias("bucket"))
    ends = banded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = stages.put(banded.join(ends.filter("low < high"), "bucket"), "buckets")

    least = percent / 100 - MARGIN
    first = stages.put(star_pairs(shared, reps, least), "star-pairs")
    links = confirmed(stages, first, rows, width, percent)
    found = stages.put(components(stages, links), "groups")
    sizes = reps.groupBy("id").agg(F.sum("n_shingles").alias("weight"))
    left = open_clusters(stages, shared, found, sizes)
    more = cluster_links(stages, left, rows, width, percent)
    found = components(stages, links.unionByName(more))

    placed = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    placed = placed.select("digest", F.coalesce("component", "rep").alias("class_component"))
    lowest = drawn.select("id", "digest", "n_shingles").join(placed, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("class_component", "id"))
    result = lowest.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
    stages.drop(shared, reps, first, left)
    return result
