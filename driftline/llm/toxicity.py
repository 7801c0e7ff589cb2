"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stages, ship, slices, whole_text

ship(__name__)

#: Labelled rows that the model is fitted on at most: the first by a hash of their id.
FIT_ROWS = 20_000
#: Folds of crc32(id) mod 5 for words and trees, and for the calibration; 0 is held out.
TREE_FOLDS, CALIBRATION_FOLDS, HELD_OUT = (1, 2, 3), (4,), 0
#: Lexicon entries at most, and how far above zero a log odds ratio must lie.
LEXICON_TERMS = 2_000
DEVIATIONS, LEAST_ODDS = 2.5, 1.0
#: Entries are whole words or their first letters, since insults are inflected and compounded.
HEADS = (4, 5, 6)
TREES, DEPTH, STEP = 30, 3, 0.2
#: Words between an insult and a second person that count as near.
NEAR = 4

#: Second-person words of the languages covered.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os".split()
)
#: Signs that stand for letters.
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_ODD_INSIDE = re.compile(r"[^\W\d_][\d@$!*]|[\d@$!*][^\W\d_]")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_CAPITALS = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{2,}\b")
_PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")

FEATURES = (
    "log_words hits density heaviest weight_density distinct near_second second capitals "
    "capital_words exclamation punctuation odd_words hidden_hits"
).split()


def bare_words(text: str) -> list[str]:
    """Lower-cased words without signs at their edges."""
    words = text.lower().split()
    return [w if w.isalpha() else _EDGE.sub("", w) for w in words]


def terms_of(word: str) -> list[str]:
    """What a word may stand under in the lexicon; ``*`` marks a beginning."""
    return [word] + [f"{word[:n]}*" for n in HEADS if len(word) > n]


def counted_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic documents, clean documents) of a task's labelled rows."""
    seen = {0: Counter(), 1: Counter()}
    for batch in slices(batches):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(bare_words(text)) - {""}
            seen[toxic].update({term for word in words for term in terms_of(word)})
    terms = list(seen[0] | seen[1])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(terms, pa.string()),
            pa.array([seen[1][t] for t in terms], pa.int64()),
            pa.array([seen[0][t] for t in terms], pa.int64()),
        ],
        names=["term", "toxic", "clean"],
    )


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms whose log odds of toxic documents are surely high, from rows (text, label)."""
    totals = rows.agg(F.sum("label"), F.count("label")).first()
    toxic, clean = totals[0] or 0, (totals[1] or 0) - (totals[0] or 0)
    if not toxic or not clean:
        return {}
    counts = (
        rows.select("text", "label")
        .mapInArrow(counted_terms, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    hit, miss = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(hit / (toxic + 1)) - F.log(miss / (clean + 1))
    sure = odds - DEVIATIONS * F.sqrt(1 / hit + 1 / miss)
    kept = (
        counts.select("term", odds.alias("odds"), sure.alias("sure"))
        .filter(F.col("sure") >= LEAST_ODDS)
        .orderBy(F.desc("sure"), "term")
        .limit(LEXICON_TERMS)
    )
    return {row["term"]: row["odds"] for row in kept.collect()}


class Features:
    """Dense features of a text, given a lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        least = HEADS[0]
        self.heads = {term.rstrip("*")[:least] for term in lexicon}

    def weight(self, word: str) -> float:
        if word[: HEADS[0]] not in self.heads:
            return 0.0
        return max(self.lexicon.get(term, 0.0) for term in terms_of(word))

    def of(self, text: str) -> list[float]:
        raw = text.split()
        if not raw:
            return [0.0] * len(FEATURES)
        words, chars = bare_words(text), len(text)
        heads, least = self.heads, HEADS[0]
        hits = {}
        for at, word in enumerate(words):
            if word[:least] in heads and (weight := self.weight(word)) > 0:
                hits[at] = weight
        odd = hidden = 0
        for at, word in enumerate(words):
            if not word.isalpha() and _ODD_INSIDE.search(word):
                odd += 1
                if at not in hits and self.weight(word.replace("*", "").translate(LOOKALIKE)) > 0:
                    hidden += 1
        second = [at for at, word in enumerate(words) if word in SECOND_PERSON]
        near = 0
        if hits and second:
            spots = set(second)
            near = sum(any(at + d in spots for d in range(-NEAR, NEAR + 1)) for at in hits)
        n = len(raw)
        return [
            math.log1p(n),
            float(len(hits)),
            len(hits) / n,
            max(hits.values(), default=0.0),
            sum(hits.values()) / n,
            float(len({words[at] for at in hits})),
            float(near),
            len(second) / n,
            len(_CAPITAL.findall(text)) / chars,
            len(_CAPITALS.findall(text)) / n,
            text.count("!") / chars,
            len(_PUNCTUATION.findall(text)) / chars,
            odd / n,
            float(hidden),
        ]


def with_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """Rows (id, ..., features) from rows (id, text, ...)."""
    kept = [c for c in docs.columns if c != "text"]

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(lexicon)
        for batch in slices(batches):
            rows = [features.of(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(rows, pa.list_(pa.float64()))],
                names=[*kept, "features"],
            )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.mapInArrow(featured, f"{kinds}, features array<double>")


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    carry: dict[str, Column] | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """One row per document: id, held_out, score, predicted, and the ``carry`` columns of it.

    At most ``fit_rows`` labelled rows outside the held-out fold are used to fit: folds 1 to 3
    give the lexicon and the trees, fold 4 the isotonic calibration; the bound keeps lexicon and
    trees small at any size. All documents are scored over their whole texts in one pass.

    Null and empty texts have zero features and a score like any other. Labels that are null or
    of unknown ids are not used; an id labelled twice counts as toxic if one label says so.
    Without labels of both kinds the score is the share of toxic ones (0 if there are none).
    Rows repeating an id, and null ids, are scored each; a null id is not held out. An empty
    table gives no rows. Other columns are not read.
    """
    stages = stages or Stages(docs.sparkSession)
    own = [column.alias(f"own_{name}") for name, column in (carry or {}).items()]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(text_col).alias("text"), *own)
    fold = F.crc32(F.col("id").cast("string")) % 5
    known = labels.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")
    ).filter("id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("id").agg(F.max("label").alias("label")).withColumn("fold", fold)
    known = known.filter(F.col("fold") != HELD_OUT).orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    known = stages.put(known, "labels")
    # at most fit_rows narrow rows: bounded by a parameter
    labelled = stages.put(rows.select("id", "text").join(F.broadcast(known), "id"), "labelled")

    trees, calibration = labelled.filter(F.col("fold").isin(*TREE_FOLDS)), labelled.filter(
        F.col("fold").isin(*CALIBRATION_FOLDS)
    )
    prior = labelled.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
    seen = {row[0]: row[1] for row in trees.groupBy("label").count().collect()}
    lexicon = learn_lexicon(trees)

    scored = with_features(rows, lexicon).withColumn("features", array_to_vector("features"))
    if len(seen) == 2:
        fit = stages.put(
            with_features(labelled.select("id", "text"), lexicon).join(F.broadcast(known), "id"),
            "features",
        ).select("fold", F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))
        model = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, maxBins=64, cacheNodeIds=False
        ).fit(fit.filter(F.col("fold").isin(*TREE_FOLDS)))
        margin = lambda df: model.transform(df).withColumn(
            "margin", vector_to_array("probability")[1]
        ).drop("rawPrediction", "probability", "prediction", "features")
        scored = margin(scored)
        if calibration.groupBy("label").count().count() == 2:
            isotonic = IsotonicRegression(featuresCol="margin", labelCol="label").fit(
                margin(fit.filter(F.col("fold").isin(*CALIBRATION_FOLDS)))
            )
            scored = isotonic.transform(scored).withColumnRenamed("prediction", "score")
        else:
            scored = scored.withColumnRenamed("margin", "score")
    else:
        scored = scored.withColumn("score", F.lit(float(prior)))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        *[F.col(f"own_{name}").alias(name) for name in carry or {}],
    )
