"""Exact top-k by inner product: term-at-a-time accumulation into dense score arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stages, ship

ship(__name__)

#: Rows of a block of candidates and of queries: a cell of the grid holds one of each.
CANDIDATE_BLOCK = 16_384
QUERY_BLOCK = 4_096
#: Queries scored together; the score array of a cell is CANDIDATE_BLOCK x QUERY_BATCH.
QUERY_BATCH = 32


def integer_vector(vector: Column) -> Column:
    """floor(1024 x) of every component; null for a null vector or one with a null, NaN or
    infinite component. Components beyond a long saturate, scores beyond one wrap around."""
    component = lambda x: F.floor(x.cast("double") * 1024).cast("long")
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(finite, F.transform(vector, component))


def postings(rows: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Term -> (positions of the rows that have it, their weights)."""
    widths = np.fromiter(map(len, rows), np.int64, len(rows))
    weights = np.concatenate(rows) if len(rows) else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), widths)
    term = np.arange(len(weights)) - np.repeat(np.cumsum(widths) - widths, widths)
    held = weights != 0
    row, term, weights = row[held], term[held], weights[held]
    order = np.argsort(term, kind="stable")
    row, term, weights = row[order], term[order], weights[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else []
    ends = np.r_[starts[1:], len(term)] if len(term) else []
    return {int(term[a]): (row[a:b], weights[a:b]) for a, b in zip(starts, ends)}


def score_cell(query_ids, queries, ids, vectors, k: int) -> Iterator[pd.DataFrame]:
    """The k best candidates of one block for each query of one block."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    index = postings([vectors[i] for i in order])
    for start in range(0, len(query_ids), QUERY_BATCH):
        batch = query_ids[start : start + QUERY_BATCH]
        scores = np.zeros((len(ids), len(batch)), np.int64)
        for term, (who, weight) in postings(queries[start : start + QUERY_BATCH]).items():
            if term not in index:
                continue
            rows, values = index[term]
            if len(rows) == len(ids) and len(who) == len(batch):
                scores += values[:, None] * weight[None, :]
            else:
                scores[np.ix_(rows, who)] += values[:, None] * weight[None, :]
        for column, query in enumerate(batch):
            others = np.flatnonzero(ids != query)
            own = scores[others, column]
            if len(own) > k:
                cut = np.partition(own, len(own) - k)[len(own) - k]
                chosen = np.flatnonzero(own >= cut)
            else:
                chosen = np.arange(len(own))
            chosen = chosen[np.lexsort((chosen, -own[chosen]))][:k]
            yield pd.DataFrame(
                {"query_id": query, "vec_id": ids[others[chosen]], "score": own[chosen]}
            )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    stages: Stages | None = None,
) -> DataFrame:
    """For every query the k candidates with the highest integer inner product.

    Returns query_id, rank (from 1), vec_id, score; fewer than k if there are fewer candidates,
    ties to the smaller vec_id. Queries and candidates are dealt to a grid of blocks; a cell
    holds one block of each, accumulates scores term by term from its postings, keeps k per
    query by partition selection, and a window merges what the cells kept. A cell's memory is
    bounded by the block sizes; only narrow rows of k per query and cell are merged.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows
    without an id. Missing trailing components count as zero. All rows with the query's id are
    its own and no candidates; of rows repeating a query's id the smallest vector asks. An empty
    table gives no rows. Other columns are not read.
    """
    stages = stages or Stages(vectors.sparkSession)
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("id"),
        integer_vector(F.col(f"`{vector_col}`")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter("id IS NOT NULL AND vector IS NOT NULL")
    rows = stages.put(rows, "vectors")
    asking = rows.filter("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    n_queries = rows.filter("asks").count()
    query_blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    blocks = max(1, math.ceil(rows.count() / CANDIDATE_BLOCK))

    def block_of(count: int) -> Column:
        return F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(count))

    cell = [F.col("across").alias("across"), F.col("down").alias("down")]
    left = asking.withColumn("down", F.pmod(F.xxhash64("id"), F.lit(query_blocks))).withColumn(
        "across", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    right = rows.withColumn("across", block_of(blocks)).withColumn(
        "down", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))
    )

    def scored(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or candidates.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        found = score_cell(
            queries["id"].to_numpy(np.int64),
            [np.asarray(v, np.int64) for v in queries["vector"]],
            candidates["id"].to_numpy(np.int64),
            [np.asarray(v, np.int64) for v in candidates["vector"]],
            k,
        )
        return pd.concat(found, ignore_index=True)

    kept = (
        left.select("id", "vector", *cell)
        .groupBy("across", "down")
        .cogroup(right.select("id", "vector", *cell).groupBy("across", "down"))
        .applyInPandas(scored, "query_id long, vec_id long, score long")
    )
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        kept.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
