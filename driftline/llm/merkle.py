"""Merkle manifest of a table: digests climb to a root, proofs come back down to every row."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import small_side
from .common import Stages, ship, slices

ship(__name__)

#: Levels of a tree that a task climbs; a block of twice to this power of nodes is held at once.
LEVELS = 12


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height_of(count: int, levels: int) -> int:
    """Levels that the blocks of a tree of so many nodes climb in one round."""
    return min(levels, (count - 1).bit_length())


def sweep_up(digests: list[str], height: int) -> list[list[str]]:
    """Digests of a block by level, time forward.

    A queue ordered by label (level, place) holds what nodes have sent to their parents; all
    that a node was sent stands at the head of the queue when its turn comes.
    """
    levels: list[list[str]] = [[] for _ in range(height + 1)]
    queue = [(0, place, 0, value) for place, value in enumerate(digests)]
    while queue:
        level, place, _, value = heapq.heappop(queue)
        if level:
            while queue and queue[0][:2] == (level, place):
                value += heapq.heappop(queue)[3]
            value = digest(value)
        levels[level].append(value)
        if level < height:
            heapq.heappush(queue, (level + 1, place // 2, place % 2, value))
    return levels


def sweep_down(levels: list[list[str]], suffix: str) -> list[str]:
    """The proof suffix of every leaf of a block, the labels in reverse.

    A step of a proof is L or R and the sibling that stands there, or - for a run of one.
    """
    height, proofs = len(levels) - 1, [""] * len(levels[0])
    queue = [(-height, 0, suffix)]
    while queue:
        level, place, suffix = heapq.heappop(queue)
        level, place = -level, -place
        if not level:
            proofs[place] = suffix
            continue
        below = levels[level - 1][2 * place : 2 * place + 2]
        for side in range(len(below)):
            step = "-" if len(below) == 1 else "RL"[side] + below[1 - side]
            heapq.heappush(queue, (1 - level, -(2 * place + side), step + suffix))
    return proofs


def siblings(proof: str) -> str:
    """All siblings of a proof, without their marks."""
    return proof.translate({ord(mark): None for mark in "LR-"})


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    while at < len(proof):
        mark, sibling = proof[at], proof[at + 1 : at + 65]
        if mark == "-":
            leaf, at = digest(leaf), at + 1
        else:
            leaf, at = digest(sibling + leaf if mark == "L" else leaf + sibling), at + 65
    return leaf


def field_text(column: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def placed(stages: Stages, nodes: DataFrame, order: list[str]) -> DataFrame:
    """Staged nodes with ``place``, counted from 0 within ``tree`` by ``order``, and ``count``.

    Ranges of the order are numbered side by side; the numbers of rows in the ranges before are
    added, one row for each range and tree.
    """
    names = nodes.columns

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in slices(batches):
            places = []
            for tree in batch.column(names.index("tree")).to_pylist():
                at = at + 1 if tree == last else 0
                last = tree
                places.append(at)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(places), pa.int64()), pa.array(places, pa.int64())],
                names=[*names, "part", "at"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    dealt = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = stages.put(dealt.mapInArrow(numbered, f"{schema}, part long, at long"), "numbered")
    counts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    whole, before = W.partitionBy("tree"), W.partitionBy("tree").orderBy("part")
    offsets = counts.select(
        "tree",
        "part",
        (F.sum("n").over(before) - F.col("n")).alias("offset"),
        F.sum("n").over(whole).alias("count"),
    )
    found = dealt.join(small_side(offsets).df, ["tree", "part"])
    found = found.select(*names, (F.col("at") + F.col("offset")).alias("place"), "count")
    return stages.put(found, "placed")


def _by_block(rows: DataFrame, *before: str) -> DataFrame:
    dealt = rows.withColumn("block", F.shiftright("place", LEVELS))
    return dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", *before, "place")


def _climbed(nodes: DataFrame) -> DataFrame:
    """The roots of all blocks as the nodes (tree, place, count, digest) of the next round."""
    levels = LEVELS

    def climbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            tree, block, count = key
            top = sweep_up(held, height_of(count, levels))[-1][0]
            left = -(-count >> levels) if count > 1 << levels else 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tree]), pa.array([block], pa.int64()),
                    pa.array([left], pa.int64()), pa.array([top]),
                ],
                names=["tree", "place", "count", "digest"],
            )

        key, held = None, []
        for batch in slices(batches):
            for tree, block, count, value in zip(*[c.to_pylist() for c in batch.columns]):
                if key is not None and key[:2] != (tree, block):
                    yield out()
                    held = []
                key = (tree, block, count)
                held.append(value)
        if key is not None:
            yield out()

    return _by_block(nodes).select("tree", "block", "count", "digest").mapInArrow(
        climbed, "tree string, place long, count long, digest string"
    )


def climb(stages: Stages, nodes: DataFrame) -> list[DataFrame]:
    """Staged nodes of every round, from the leaves to one node a tree."""
    rounds = [nodes]
    most = nodes.agg(F.max("count")).first()[0] or 0
    while most > 1:
        rounds.append(stages.put(_climbed(rounds[-1]), "nodes"))
        most = -(-most >> LEVELS)
    return rounds


def descend(stages: Stages, rounds: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """Proofs (tree, place, proof) of all leaves, from the suffixes (tree, suffix) of the roots."""
    levels = LEVELS

    def lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            tree, block = key
            proofs = sweep_down(sweep_up(held, height_of(count, levels)), suffix)
            first = block << levels
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * len(proofs), pa.string()),
                    pa.array(range(first, first + len(proofs)), pa.int64()),
                    pa.array(proofs, pa.string()),
                ],
                names=["tree", "place", "proof"],
            )

        key, count, held, suffix = None, 0, [], ""
        for batch in slices(batches):
            for tree, block, n, value, given in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (tree, block):
                    if held:
                        yield out()
                    key, held = (tree, block), []
                if value is None:
                    suffix = given
                else:
                    count = n
                    held.append(value)
        if held:
            yield out()

    given = suffixes.select("tree", F.lit(0).cast("long").alias("place"), F.col("suffix").alias("proof"))
    for nodes in reversed(rounds[:-1]):
        above = given.select(
            "tree",
            F.shiftleft("place", LEVELS).alias("place"),
            F.lit(0).alias("kind"),
            F.lit(None).cast("long").alias("count"),
            F.lit(None).cast("string").alias("digest"),
            F.col("proof").alias("suffix"),
        )
        own = nodes.select(
            "tree", "place", F.lit(1).alias("kind"), "count", "digest", F.lit(None).cast("string").alias("suffix")
        )
        dealt = _by_block(above.unionByName(own), "kind")
        given = stages.put(
            dealt.select("tree", "block", "count", "digest", "suffix").mapInArrow(
                lowered, "tree string, place long, proof string"
            ),
            "proofs",
        )
    return given


def merkle_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: Mapping[str, Column] | None = None,
    where: Column | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """One row per row: id, leaf, subroot, root, proof, proof_sha256, folded_root, verified.

    A leaf is the digest of the row's fields. The leaves of a group ascend by id (nulls first,
    equal ids by leaf) and form a tree of runs of two up to the group's subroot; the subroots,
    by group in byte order with null first, form the tree of the root. ``tampered`` gives new
    values of fields for rows in ``where``; ``folded_root`` is what such a row leads to with the
    original siblings.

    The tree is climbed in rounds of LEVELS levels: Spark's sorted shuffle brings the digests to
    the blocks of the next round in the order of their labels, and within a block a queue in the
    same order delivers them to the parents. The reversed rounds deliver proof suffixes to the
    leaves. Texts are hashed where they are read; only digests move, and no group is held as one.

    Rows sent twice are leaves of their own. A null group is a group. An empty table gives no
    rows. Other columns are not read, whatever their names.
    """
    stages = stages or Stages(docs.sparkSession)
    changed = dict(tampered or {})
    leaf = F.sha2(F.concat(*[field_text(F.col(f"`{f}`")) for f in fields]), 256)
    other = F.sha2(F.concat(*[field_text(changed.get(f, F.col(f"`{f}`"))) for f in fields]), 256)
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("-")).alias("tree"),
        F.col(f"`{id_col}`").alias("id"),
        leaf.alias("digest"),
        F.when(F.lit(False) if where is None else where, other).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = placed(stages, stages.put(leaves, "leaves"), ["id", "digest", "row"])
    rounds = climb(stages, leaves)
    tops = rounds[-1].select("tree", F.col("digest").alias("subroot"))
    heads = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest"))
    heads = placed(stages, heads, ["name"])
    above = climb(stages, heads)
    ends = descend(stages, above, above[-1].select("tree", F.lit("").alias("suffix")))
    suffixes = heads.join(ends.withColumnRenamed("proof", "suffix"), ["tree", "place"])
    suffixes = stages.put(suffixes.select(F.col("name").alias("tree"), "suffix"), "suffixes")
    proofs = descend(stages, rounds, suffixes)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            start, steps = batch.column("start").to_pylist(), batch.column("proof").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("id", "leaf", "subroot", "proof")],
                    pa.array([digest(siblings(p)) for p in steps], pa.string()),
                    pa.array([fold(s, p) for s, p in zip(start, steps)], pa.string()),
                ],
                names=["id", "leaf", "subroot", "proof", "proof_sha256", "folded_root"],
            )

    full = leaves.join(proofs, ["tree", "place"]).join(small_side(tops).df, "tree")
    kind = leaves.schema["id"].dataType.simpleString()
    result = full.select(
        "id", F.col("digest").alias("leaf"), F.coalesce("other", "digest").alias("start"), "subroot", "proof"
    ).mapInArrow(
        folded,
        f"id {kind}, leaf string, subroot string, proof string, proof_sha256 string, folded_root string",
    )
    root = above[-1].select("digest").scalar()
    return result.select(
        F.col("id").alias(id_col), "leaf", "subroot", root.alias("root"), "proof", "proof_sha256",
        "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
