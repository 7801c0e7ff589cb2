"""Mixing sources to target weights: raked token weights, then sampling by their probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, Stages, whole_text

MARGINS = ("source", "lang", "topic")

#: Target share of a category is its share of tokens to this power, scaled to add up to one.
TARGET_POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
ROUNDS = 12
#: Share of all tokens that the sample is to hold.
KEEP_SHARE = 0.5
SEED = 17

#: Topics by form, first match wins; plain words only, so every engine reads them alike.
TOPIC_MARKS = [("licence", "icense"), ("contact", "@"), ("table", " | "), ("symbols", "%%%")]

#: Up to so many cells the raking runs in one task; beyond, its windows shuffle. Same rows.
ONE_TASK_CELLS = 100_000


def topic_of(text: Column) -> Column:
    topic = F.lit("prose")
    for name, mark in reversed(TOPIC_MARKS):
        topic = F.when(F.contains(text, F.lit(mark)), name).otherwise(topic)
    return topic


def rake(cells: DataFrame, targets: dict[str, float] | dict[str, DataFrame], rounds: int) -> DataFrame:
    """Iterative proportional fitting of ``weight`` to every margin in turn.

    ``cells`` has the margins and ``tokens`` (> 0). A target is either a power of the observed
    share or a table (category, share); categories that it lacks get nothing.
    """
    total = F.sum("tokens").over(W.partitionBy())
    weighted = cells.withColumn("weight", F.col("tokens").cast("double"))
    for margin in MARGINS:
        goal = targets[margin]
        if isinstance(goal, DataFrame):
            given = goal.select(
                F.col(goal.columns[0]).alias(margin), F.col(goal.columns[1]).alias(f"goal_{margin}")
            )
            weighted = weighted.join(given, margin, "left").fillna(0.0, [f"goal_{margin}"])
            continue
        share = F.sum("tokens").over(W.partitionBy(margin)) / total
        power = F.pow(share, F.lit(goal))
        each = power / F.count(F.lit(1)).over(W.partitionBy(margin))
        weighted = weighted.withColumn(f"part_{margin}", each).withColumn(f"power_{margin}", power)
        weighted = weighted.withColumn(
            f"goal_{margin}",
            F.col(f"power_{margin}") / F.sum(f"part_{margin}").over(W.partitionBy()),
        )
    weighted = weighted.withColumn("total", total)
    for _ in range(rounds):
        for margin in MARGINS:
            held = F.sum("weight").over(W.partitionBy(margin))
            fitted = F.col("weight") * F.col(f"goal_{margin}") * F.col("total") / held
            weighted = weighted.withColumn("weight", F.when(held > 0, fitted).otherwise(0.0))
    return weighted.select(*MARGINS, "tokens", "weight")


def inclusion(factors: DataFrame, share: float) -> DataFrame:
    """Add probability = min(1, scale * weight), with the scale that keeps the share of tokens.

    With the i heaviest cells kept whole, the scale for the rest follows from what is left; the
    first i whose next cell then stays at or below 1 is the answer.
    """
    order = W.partitionBy().orderBy(F.desc("weight"), *MARGINS)
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("tokens") * F.col("weight")).over(
        order.rowsBetween(W.currentRow, W.unboundedFollowing)
    )
    everything = W.partitionBy()
    scaled = factors.select(
        *MARGINS,
        "weight",
        F.row_number().over(order).alias("place"),
        F.when(rest > 0, (share * F.sum("tokens").over(everything) - before) / rest).alias("scale"),
    )
    fits = F.when(F.col("scale") * F.col("weight") <= 1, F.struct("place", "scale"))
    scale = F.coalesce(F.min(fits).over(everything)["scale"], F.lit(float("inf")))
    probability = F.when(F.col("weight") > 0, F.least(F.lit(1.0), scale * F.col("weight")))
    return scaled.select(*MARGINS, "weight", F.coalesce(probability, F.lit(0.0)).alias("probability"))


def cell_columns(
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
) -> list[Column]:
    """Source, language and topic of a document, as its cell names them."""
    named = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("(null)")) for c in (source_col, lang_col)
    ]
    return [*named, topic_of(whole_text(text_col)) if topic is None else topic]


def mix(
    docs: DataFrame,
    targets: dict | None = None,
    rounds: int = ROUNDS,
    share: float = KEEP_SHARE,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """One row per document: id, source, lang, topic, n_tokens, weight, probability, kept.

    Tokens (words) are summed per cell of source, language and topic before any shuffle; the
    cells are raked to the three target margins; ``weight`` is the factor that a document's
    tokens get. Probabilities are the weights times the one scale at which the sample is
    expected to hold ``share`` of all tokens, and at most 1. A document is kept if a number in
    [0, 1) drawn from md5(seed:id) is below it, so a run repeats itself on any cluster.

    Null sources and languages are the category ``(null)``. A document without words has
    weight 0 in a cell without tokens and is drawn with probability 0 there, else by its cell.
    Rows repeating an id share their draw; a null id draws as the text ``null``. An empty table
    gives no rows. Other columns are not read.
    """
    stages = stages or Stages(docs.sparkSession)
    text = whole_text(text_col)
    rows = stages.put(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            *[
                column.alias(margin)
                for margin, column in zip(MARGINS, cell_columns(text_col, source_col, lang_col, topic))
            ],
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
        ),
        "mix-rows",
    )
    cells = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0")
    cells = stages.put(cells, "mix-cells")
    if cells.count() <= ONE_TASK_CELLS:
        cells = cells.coalesce(1)
    factors = rake(cells, targets or TARGET_POWERS, rounds).select(
        *MARGINS, "tokens", (F.col("weight") / F.col("tokens")).alias("weight")
    )
    factors = stages.put(inclusion(factors, share), "mix-factors")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / float(1 << 52)
    drawn = rows.join(factors, list(MARGINS), "left").fillna(0.0, ["weight", "probability"])
    return drawn.select(
        F.col("id").alias(id_col),
        "source",
        "lang",
        "topic",
        "n_tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        (draw < F.col("probability")).alias("kept"),
    )
