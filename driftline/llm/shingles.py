"""Word shingles of whole texts, and links between texts confirmed on their full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bloom, passing, slots, words_for
from .common import Stages, ship, slices

ship(__name__)

FOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    A-Z are lower-cased, words are what ASCII white space separates; fewer words than ``width``
    are one shingle together, no words are none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64)
    size = min(width, len(hashes))
    folded = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        folded = folded * FOLD + hashes[k : len(hashes) - size + 1 + k]
    return np.unique(mix(folded))


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sets link: 100 * intersection >= percent * union; sizes are compared first."""
    if 100 * min(len(one), len(two)) < percent * max(len(one), len(two), 1):
        return False
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def texts_of(stages: Stages, ids: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (id, text) of the ids, staged; each text of an id once.

    ``ids`` is a staged table of distinct ids. Only texts that a filter of them may hold are
    shuffled.
    """
    words = words_for(max(1, ids.count()), 12)
    held = stages.put(bloom(ids, "id", words, 3, 5), "asked-bits")
    asked = passing(docs, held, slots(F.col("id"), words, 3, 5))
    texts = asked.join(ids, "id", "left_semi").groupBy("id", F.sha2("text", 256).alias("sha"))
    texts = stages.put(texts.agg(F.first("text").alias("text")).select("id", "text"), "texts")
    stages.drop(held)
    return texts


def confirmed(
    stages: Stages, pairs: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """The pairs (a, b) whose full shingle sets link; texts travel, not sets."""
    pairs = stages.put(pairs.select("a", "b").distinct(), "pairs")
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    ids = stages.put(ends.select(F.col("a").alias("id")).distinct(), "pair-ids")
    texts = texts_of(stages, ids, docs)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            linked = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                one = shingle_set(left, width)
                if right not in known:  # pairs come by their second text
                    known = {right: shingle_set(right, width)}
                linked.append(len(one) > 0 and similar(one, known[right], percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                names=["a", "b", "linked"],
            )

    links = both.select("a", "b", "text_a", "text_b").mapInArrow(
        checked, "a long, b long, linked boolean"
    )
    links = stages.put(links.filter("linked").select("a", "b").distinct(), "links")
    stages.drop(texts, ids, pairs)
    return links
