"""A corpus pipeline: toxicity, exact and near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it below the shared
folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.bits import without
from driftline.llm.common import Stages, table
from driftline.llm.exact_dedup import exact_groups, text_digest
from driftline.llm.mixing import cell_columns, mix
from driftline.llm.near_dedup import near_duplicates
from driftline.llm.packing import pack
from driftline.llm.toxicity import score_toxicity
from driftline.runtime import null_safe_join

#: No stage but the mix could be written in SQL alone; tests compare with brute force instead.
ORACLE_SQL = None


#: A row's key besides its id: rows that share an id are told apart by their texts.
DIGEST = "__sha"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic.

    Each row is judged by its own text, also where rows share an id or have none; equal rows go
    together. Null and empty texts are scored like any other. Without labels nothing is learned
    and all documents stay. An empty table gives no rows.
    """
    stages = Stages(spark)
    digest = {DIGEST: text_digest("text")}
    scores = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=digest, stages=stages)
    toxic = stages.put(scores.filter("predicted = 1").select("doc_id", DIGEST), "toxic")
    keyed = docs.withColumns(digest)
    return without(stages, keyed, toxic, ["doc_id", DIGEST], null_safe=True).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id, one row of it.

    Null and empty texts are equal; a null id stays only where no equal text has an id. Of rows
    that repeat id and text one stays, the largest by its other columns. An empty table gives
    no rows.
    """
    stages = Stages(spark)
    key = ["doc_id", DIGEST]
    groups = exact_groups(docs, stages=stages).withColumnRenamed("text_sha256", DIGEST)
    groups = stages.put(groups.filter("group_size > 1").select(*key, "kept"), "groups")
    keyed = docs.withColumn(DIGEST, text_digest("text"))
    copies = stages.put(groups.filter(~F.col("kept")).select(*key), "copies")
    single = without(stages, keyed, copies, key, null_safe=True)
    twice = groups.filter("kept").groupBy(*key).count().filter("count > 1").select(*key)
    twice = stages.put(twice, "twice")
    if twice.isEmpty():
        return single.select(*docs.columns)
    rest = [c for c in docs.columns if c != "doc_id"]
    repeated = null_safe_join(single, twice, key, "left_semi")
    one = repeated.groupBy(*key).agg(F.max(F.struct(*rest)).alias("row")).select("doc_id", "row.*")
    once = without(stages, single, twice, key, null_safe=True)
    return once.select(*docs.columns).unionByName(one.select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near copies: five-word shingles, similarity 0.8.

    Rows that share an id are in one group and stay or go together. Rows with a null id are
    linked with nothing and stay, as do texts without words. An empty table gives no rows.
    """
    stages = Stages(spark)
    found = near_duplicates(docs, width=5, percent=80, stages=stages)
    copies = stages.put(found.filter(~F.col("kept")).select("doc_id"), "copies")
    return without(stages, docs, copies, ["doc_id"])


def sample_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics.

    The draw goes by id: rows that share an id, or have none, and lie in one cell stay or go
    together. Null sources and languages are categories of their own. A text without words is
    drawn by its cell. An empty table gives no rows.
    """
    stages = Stages(spark)
    # a row is named by its id and cell, for rows of one id may lie in several
    cell = ["doc_id", "__source", "__lang", "__topic"]
    drawn = mix(docs, stages=stages).select(
        "doc_id", F.col("source").alias("__source"), F.col("lang").alias("__lang"),
        F.col("topic").alias("__topic"), "kept",
    )
    left = stages.put(drawn.filter(~F.col("kept")).select(*cell), "left-out")
    keyed = docs.withColumns(dict(zip(cell[1:], cell_columns())))
    return without(stages, keyed, left, cell, null_safe=True).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of 2048 tokens: one row per piece of a document.

    Null and empty texts are one piece with the end id alone; rows that share an id, or have
    none, are packed each. An empty table gives no rows.
    """
    return pack(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        carry={"ids_crc32": F.crc32("ids")},
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", sample_mix),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stages = table(spark, sf_dir, "documents"), Stages(spark)
    for name, stage in STAGES:
        docs = stages.put(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
