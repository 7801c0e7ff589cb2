"""Links inside clusters of texts, found block against block in tasks; no row is a pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stages, ship, slices
from .components import components
from .shingles import shingle_set, similar, texts_of

ship(__name__)

#: Shingles of a block; a task holds two blocks, 8 bytes a shingle.
BLOCK_SHINGLES = 1 << 20
#: Texts that stand for their components and that every other text is compared with first.
LEADERS = 4


class Forest:
    """Union-find over the components that a task meets."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        up = self.up
        while (above := up.setdefault(node, node)) != node:
            up[node] = up[above]
            node = above
        return node

    def union(self, one: int, two: int) -> bool:
        """Whether the two were apart."""
        one, two = self.root(one), self.root(two)
        self.up[max(one, two)] = min(one, two)
        return one != two


def spanning_links(
    ids: list[int], parts: list[int], sides: list[int], sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links that join the components of a block, or of two blocks, as far as they link at all.

    Texts of equal ``sides`` meet if there is one side only, else those of different sides. Each
    is compared with a few leaders first, which joins near copies at a linear cost. Whatever is
    not in the largest component then scans the inverted lists of the block: a dense array
    counts what it shares with every text, so all pairs of different components are tested.
    """
    forest, links = Forest(), []
    across = len(set(sides)) > 1

    def link(i: int, j: int) -> None:
        if forest.union(parts[i], parts[j]):
            links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))

    leaders: list[int] = []
    for i in range(len(ids)):
        for j in leaders:
            apart = forest.root(parts[i]) != forest.root(parts[j])
            if not apart or similar(sets[i], sets[j], percent):
                link(i, j)
                leaders.remove(j)
                leaders.insert(0, j)
                break
        else:
            leaders = [i, *leaders][:LEADERS]
    roots = np.array([forest.root(p) for p in parts])
    names, sizes = np.unique(roots, return_counts=True)
    if len(names) == 1:
        return links

    lengths = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), lengths)[np.argsort(codes, kind="stable")]
    heads = np.concatenate([[0], np.cumsum(np.bincount(codes))])
    side = np.array(sides)
    for i in np.flatnonzero(roots != names[np.argmax(sizes)]):
        own = codes[starts[i] : starts[i + 1]]
        spans = heads[own + 1] - heads[own]
        places = np.repeat(heads[own] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
        shared = np.bincount(owners[places], minlength=len(sets))
        close = 100 * shared >= percent * (lengths + lengths[i] - shared)
        close[i] = False
        if across:
            close &= side != side[i]
        for j in np.flatnonzero(close):
            link(int(i), int(j))
    return links


def _met(stages: Stages, rows: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """Staged links of tasks: rows (task, side, id, component, text)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([link[end] for link in links], pa.int64()) for end in (0, 1)],
                names=["a", "b"],
            )

        task, held = None, ([], [], [], [])
        for batch in slices(batches):
            for key, side, doc, part, text in zip(*[c.to_pylist() for c in batch.columns]):
                if key != task and held[0]:
                    yield out(spanning_links(*held, percent))
                    held = ([], [], [], [])
                task = key
                for column, value in zip(held, (doc, part, side, shingle_set(text, width))):
                    column.append(value)
        if held[0]:
            yield out(spanning_links(*held, percent))

    dealt = rows.repartition("task").sortWithinPartitions("task", "component", "id")
    dealt = dealt.select("task", "side", "id", "component", "text")
    return stages.put(dealt.mapInArrow(found, "a long, b long").distinct(), name)


def _task(*parts: Column | str) -> Column:
    return F.concat_ws("/", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])


def _blocks(members: DataFrame, keys: list[str]) -> DataFrame:
    """Members with ``blocks``, the number of blocks of their group, and ``block``, their own."""
    sums = members.groupBy(*keys).agg(F.sum("weight").alias("total"))
    counted = sums.select(*keys, F.ceil(F.col("total") / BLOCK_SHINGLES).alias("blocks"))
    return members.join(counted, keys).withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit(11)), F.col("blocks"))
    )


def _joined(stages: Stages, members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the components that the links leave."""
    known = members.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = components(stages, links.select("a", "b").unionByName(known))
    found = found.withColumnRenamed("component", "joined")
    placed = members.join(found, "id", "left")
    placed = placed.withColumn("component", F.coalesce("joined", "component")).drop("joined")
    return stages.put(placed, "joined")


def cluster_links(
    stages: Stages, members: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links (a, b) that join every two linked texts of a cluster, directly or by others.

    ``members`` are staged rows (id, cluster, component, weight): texts already joined share a
    component, ``weight`` is a size near the number of shingles. Clusters are cut into blocks of
    about BLOCK_SHINGLES. First every block is joined in itself, which settles all clusters of
    one block. In the others the components are joined by their smallest texts; then what is
    not in the largest component meets all other blocks, two in a task. So a cluster of near
    copies costs its size, texts that are nearly but not quite alike cost block against block,
    and no text pair becomes a row. Clusters of one component have nothing to test.
    """
    mixed = members.groupBy("cluster").agg(F.min("component") != F.max("component"))
    mixed = mixed.toDF("cluster", "mixed").filter("mixed").select("cluster")
    members = stages.put(members.join(mixed, "cluster", "left_semi"), "members")
    texts = texts_of(stages, stages.put(members.select("id").distinct(), "member-ids"), docs)
    dealt = stages.put(_blocks(members, ["cluster"]), "dealt")
    whole = dealt.join(texts, "id").withColumn("side", F.lit(0))
    links = _met(
        stages, whole.withColumn("task", _task("cluster", "block")), width, percent, "block-links"
    )
    wide = dealt.filter("blocks > 1").select("id", "cluster", "component", "weight")
    if wide.isEmpty():
        return links

    placed = _joined(stages, wide, links)
    heads = placed.groupBy("cluster", "component").agg(F.min(F.struct("id", "weight")).alias("h"))
    heads = heads.select("h.id", "cluster", "component", "h.weight")
    heads = _blocks(heads, ["cluster"]).join(texts, "id").withColumn("side", F.lit(0))
    more = _met(
        stages, heads.withColumn("task", _task("cluster", "block")), width, percent, "head-links"
    )
    links = stages.put(links.unionByName(more), "links")
    placed = _joined(stages, placed, more)

    sizes = placed.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("top")
    )
    top = top.filter("parts > 1").select("cluster", F.col("top.component").alias("top"))
    sorted_out = placed.join(top, "cluster").withColumn("is_top", F.col("component") == F.col("top"))
    cut = stages.put(_blocks(sorted_out.drop("top"), ["cluster", "is_top"]), "cut")
    counts = cut.groupBy("cluster").agg(
        F.coalesce(F.max(F.expr("if(is_top, blocks, 0)")), F.lit(0)).alias("tops"),
        F.max(F.expr("if(is_top, 0, blocks)")).alias("rests"),
    )
    cut = cut.join(counts, "cluster")
    rest, most = cut.filter("NOT is_top"), cut.filter("is_top")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    shapes = [
        rest.withColumn("other", F.explode(upto("rests")))
        .withColumn("task", _task("cluster", F.lit("r"), F.least("block", "other"), F.greatest("block", "other")))
        .withColumn("side", (F.col("block") > F.col("other")).cast("int")),
        rest.filter("tops > 0")
        .withColumn("other", F.explode(upto("tops")))
        .withColumn("task", _task("cluster", F.lit("t"), "block", "other"))
        .withColumn("side", F.lit(0)),
        most.withColumn("other", F.explode(upto("rests")))
        .withColumn("task", _task("cluster", F.lit("t"), "other", "block"))
        .withColumn("side", F.lit(1)),
    ]
    columns = ["task", "side", "id", "component"]
    met = shapes[0].select(*columns)
    for shape in shapes[1:]:
        met = met.unionByName(shape.select(*columns))
    last = _met(stages, met.join(texts, "id"), width, percent, "cross-links")
    return stages.put(links.unionByName(last), "links")
