"""Queries: features, scoring expressions, evaluation and model jobs."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ..functions.encoding import month_number
from ..functions.values import half_up
from ..operators import evaluation, features, lineage, modeling
from ..operators.cleaning import map_month_name
from ..operators.sampling import hashed_split, stratified_split
from ..runtime import scratch_path, stage_table
from ..sources.stores import PredictionLog
from .registry import half_up_sql, query
from .scoring_job import ServedModel, score_and_log
from .testbed import (
    EMBEDDING_DIMS,
    EMBEDDING_SPEC,
    SOUND_BOOKINGS_SQL,
    embedding_rows,
    raw_bookings,
    sound_bookings,
    table,
)

SEED = 42

# -- features -------------------------------------------------------------------------

_ANGLES = {
    "month": ("month(strptime(arrival_date_month, '%B'))", 12),
    "arrival_date_week_number": ("arrival_date_week_number", 53),
}


def _cycle_sql() -> str:
    parts = []
    for column, (value, period) in _ANGLES.items():
        angle = f"{value}::DOUBLE * (2.0 * pi()) / {period}.0"
        for name, function in zip(features.InputRule(column, "cycle").outputs, ("sin", "cos")):
            parts.append(f"{half_up_sql(f'{function}({angle})', 6)} AS {name}")
    return ", ".join(parts)


@query(f"WITH {SOUND_BOOKINGS_SQL} SELECT booking_id, {_cycle_sql()} FROM sound_bookings")
def feat_cyclical(spark, sf_dir):
    rows = sound_bookings(spark, sf_dir).withColumn(
        "month", month_number("arrival_date_month")
    )
    periods = {column: period for column, (_, period) in _ANGLES.items()}
    names = [name for column in periods for name in features.InputRule(column, "cycle").outputs]
    derived = features.cyclical(rows, periods)
    return derived.select("booking_id", *[half_up(name, 6).alias(name) for name in names])


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}
SELECT booking_id, coalesce(agent > 0, false)::INT AS has_agent,
       coalesce(company > 0, false)::INT AS has_company FROM raw_bookings"""
)
def feat_presence(spark, sf_dir):
    flagged = features.presence_flag(raw_bookings(spark, sf_dir), ["agent", "company"])
    return flagged.select("booking_id", "has_agent", "has_company")


_MEDIANS = ("children", "adr", "lead_time", "agent")


@query(
    f"WITH {SOUND_BOOKINGS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, median({c}::DOUBLE) AS value FROM sound_bookings"
        for c in _MEDIANS
    )
)
def feat_median(spark, sf_dir):
    # a small bracket, so that the narrowing rounds run at any size
    rows = stage_table(sound_bookings(spark, sf_dir).select(*_MEDIANS), "medians")
    learned = features.medians(rows, list(_MEDIANS), bracket_rows=500)
    return spark.createDataFrame(list(learned.items()), "feature string, value double")


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}
SELECT booking_id, coalesce(children, (SELECT median(children) FROM sound_bookings)) AS children
FROM sound_bookings"""
)
def feat_impute(spark, sf_dir):
    rows = sound_bookings(spark, sf_dir).select("booking_id", "children")
    return features.impute_median(rows, features.medians(rows, ["children"]))


def _mode_sql(column: str, source: str) -> str:
    return (
        f"SELECT * FROM (SELECT '{column}' AS feature, {column}::VARCHAR AS value FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY {column}::VARCHAR "
        f"ORDER BY count(*) DESC, {column}::VARCHAR LIMIT 1)"
    )


@query(" UNION ALL ".join(_mode_sql(c, "part") for c in ("p_brand", "p_type", "p_size")))
def feat_mode(spark, sf_dir):
    learned = features.most_frequent(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])
    return spark.createDataFrame(list(learned.items()), "feature string, value string")


@query(
    """WITH cells AS (
  SELECT c_custkey, 'c_nationkey' AS feature, c_nationkey::VARCHAR AS category FROM customer
  UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer),
counts AS (SELECT feature, category, count(*) AS n FROM cells GROUP BY 1, 2),
vocabulary AS (
  SELECT feature, category,
         row_number() OVER (PARTITION BY feature ORDER BY category NULLS LAST) - 1 AS position
  FROM (SELECT feature, category FROM counts WHERE n >= 55
        UNION ALL SELECT feature, NULL FROM counts WHERE n < 55 GROUP BY feature)),
buckets AS (SELECT feature, position FROM vocabulary WHERE category IS NULL)
SELECT c_custkey, c.feature, coalesce(v.position, b.position)::INT AS position
FROM cells c LEFT JOIN vocabulary v ON v.feature = c.feature AND v.category = c.category
     LEFT JOIN buckets b ON b.feature = c.feature
WHERE coalesce(v.position, b.position) IS NOT NULL"""
)
def feat_onehot(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    columns = ["c_nationkey", "c_mktsegment"]
    vocabulary = features.category_vocabulary(customers, columns, min_frequency=55)
    return features.one_hot_positions(customers, "c_custkey", columns, vocabulary)


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}, counts AS (
  SELECT market_segment, count(*) AS n FROM sound_bookings GROUP BY 1)
SELECT booking_id, {half_up_sql("(SELECT sum(n)::DOUBLE / count(*) FROM counts) / n", 6)} AS weight
FROM sound_bookings JOIN counts USING (market_segment)"""
)
def feat_weights(spark, sf_dir):
    weighted = features.balanced_weights(
        sound_bookings(spark, sf_dir).select("booking_id", "market_segment"), "market_segment"
    )
    return weighted.select("booking_id", half_up("weight", 6).alias("weight"))


# -- scoring expressions --------------------------------------------------------------

_CLASSES = [f"c{i}" for i in range(EMBEDDING_DIMS)]


@query(
    f"""WITH powers AS (
  SELECT vec_id, [exp(x::DOUBLE * 20) FOR x IN embedding] AS p FROM embeddings),
probs AS (SELECT vec_id, [x / list_sum(p) FOR x IN p] AS p FROM powers)
SELECT vec_id, ({_CLASSES})[list_position(p, list_max(p))] AS predicted_segment,
       {half_up_sql("list_max(p)", 6)} AS confidence,
       {half_up_sql("list_max(p) - list_reverse_sort(p)[2]", 6)} AS margin FROM probs"""
)
def confidence_margin(spark, sf_dir):
    powers = F.transform("embedding", lambda x: F.exp(x.cast("double") * 20))
    total = F.aggregate("powers", F.lit(0.0), lambda a, x: a + x)
    probs = (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", powers.alias("powers"))
        .select("vec_id", F.transform("powers", lambda x: x / total).alias("probabilities"))
    )
    scored = modeling.confidence_margin(probs, "probabilities", _CLASSES)
    return scored.select(
        "vec_id",
        "predicted_segment",
        half_up("confidence", 6).alias("confidence"),
        half_up("margin", 6).alias("margin"),
    )


# -- evaluation -----------------------------------------------------------------------

_LABELS = ["A", "N", "R", "Z"]
_RULE = "CASE WHEN l_quantity < 20 THEN 'A' WHEN l_quantity < 35 THEN 'R' ELSE 'N' END"


def _predicted_lines(spark, sf_dir):
    rule = (
        F.when(F.col("l_quantity") < 20, "A").when(F.col("l_quantity") < 35, "R").otherwise("N")
    )
    return table(spark, sf_dir, "lineitem").select("l_returnflag", rule.alias("predicted"))


@query(
    f"""WITH labels AS (SELECT unnest({_LABELS}) AS label),
counts AS (SELECT l_returnflag AS t, {_RULE} AS p, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT a.label AS "true", b.label AS predicted, coalesce(n, 0)::BIGINT AS n
FROM labels a CROSS JOIN labels b LEFT JOIN counts ON t = a.label AND p = b.label"""
)
def eval_confusion(spark, sf_dir):
    return evaluation.confusion_matrix(
        _predicted_lines(spark, sf_dir), "l_returnflag", "predicted", _LABELS
    )


_SCORES_SQL = f"""WITH rows AS (SELECT l_returnflag AS t, {_RULE} AS p FROM lineitem),
labels AS (SELECT DISTINCT l FROM (SELECT t AS l FROM rows UNION ALL SELECT p FROM rows)),
sums AS (
  SELECT l AS label, count(*) FILTER (WHERE t = l) AS support,
         count(*) FILTER (WHERE p = l) AS picked, count(*) FILTER (WHERE t = l AND p = l) AS hit
  FROM labels JOIN rows ON t = l OR p = l GROUP BY l),
scores AS (
  SELECT label, support, CASE WHEN picked > 0 THEN hit / picked ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS recall,
         2.0::DOUBLE * hit / (support + picked) AS f1, hit FROM sums),
averages AS (
  SELECT sum(support) AS n, sum(hit) / sum(support) AS accuracy,
         avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
         sum(precision * support) / sum(support) AS weighted_precision,
         sum(recall * support) / sum(support) AS weighted_recall,
         sum(f1 * support) / sum(support) AS weighted_f1 FROM scores)"""

_REPORT_SQL = (
    _SCORES_SQL
    + """, report AS (
  SELECT label, precision, recall, f1, support FROM scores
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, n FROM averages
  UNION ALL SELECT 'macro avg', macro_precision, macro_recall, macro_f1, n FROM averages
  UNION ALL SELECT 'weighted avg', weighted_precision, weighted_recall, weighted_f1, n
            FROM averages)"""
)


def _line_counts(spark, sf_dir):
    return evaluation.confusion_counts(
        _predicted_lines(spark, sf_dir), "l_returnflag", "predicted"
    )


@query(
    _REPORT_SQL
    + f""" SELECT label, {half_up_sql("precision", 6)} AS precision,
       {half_up_sql("recall", 6)} AS recall, {half_up_sql("f1", 6)} AS f1,
       support::BIGINT AS support FROM report"""
)
def eval_report(spark, sf_dir):
    report = evaluation.classification_report(_line_counts(spark, sf_dir))
    return report.select(
        "label", *[half_up(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query(
    _SCORES_SQL
    + f""" SELECT {half_up_sql("accuracy", 6)} AS accuracy,
       {half_up_sql("weighted_f1", 6)} AS f1_weighted, {half_up_sql("macro_f1", 6)} AS f1_macro
FROM averages"""
)
def eval_f1(spark, sf_dir):
    scores = evaluation.summary_scores(_line_counts(spark, sf_dir))
    return scores.select(
        half_up("accuracy", 6).alias("accuracy"),
        half_up("weighted_f1", 6).alias("f1_weighted"),
        half_up("macro_f1", 6).alias("f1_macro"),
    )


_AUC_SCORES = {
    "A": "l_extendedprice",
    "N": "l_quantity + l_discount",
    "R": "l_extendedprice * (1 - l_discount)",
    "Z": "l_tax",
}


@query(
    "WITH votes AS ("
    + " UNION ALL ".join(
        f"SELECT '{label}' AS label, ({score})::DOUBLE AS score, l_returnflag = '{label}' AS hit "
        "FROM lineitem"
        for label, score in _AUC_SCORES.items()
    )
    + f"""), ties AS (
  SELECT label, score, count(*) FILTER (WHERE hit) AS pos, count(*) FILTER (WHERE NOT hit) AS neg
  FROM votes GROUP BY 1, 2),
ordered AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY label ORDER BY score
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ties),
sums AS (SELECT label, sum(pos * (below + neg * 0.5::DOUBLE)) AS wins, sum(pos)::BIGINT AS n_pos,
                sum(neg)::BIGINT AS n_neg FROM ordered GROUP BY label)
SELECT label, CASE WHEN n_pos * n_neg > 0
                   THEN {half_up_sql("wins / (n_pos::DOUBLE * n_neg)", 9)} END AS auc,
       n_pos, n_neg FROM sums"""
)
def eval_auc(spark, sf_dir):
    scores = {label: F.expr(score) for label, score in _AUC_SCORES.items()}
    auc = evaluation.roc_auc_ovr(table(spark, sf_dir, "lineitem"), "l_returnflag", scores)
    return auc.withColumn("auc", half_up("auc", 9))


@query(
    _REPORT_SQL
    + f""", facts AS (
  SELECT 'precision/' || label AS key, precision AS value FROM report
  UNION ALL SELECT 'recall/' || label, recall FROM report
  UNION ALL SELECT 'f1/' || label, f1 FROM report)
SELECT 'run-1' AS run_id, 'metric' AS kind, key, {half_up_sql("value", 6)} AS value FROM facts"""
)
def run_metrics(spark, sf_dir):
    report = evaluation.classification_report(_line_counts(spark, sf_dir))
    rows = lineage.metric_rows(report, ["label"], ["precision", "recall", "f1"])
    return rows.select(
        F.lit("run-1").alias("run_id"),
        F.lit("metric").alias("kind"),
        "key",
        half_up("value", 6).alias("value"),
    )


_DRAWN = "('0x' || substr(md5('42:' || booking_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


@query(
    f"""WITH {SOUND_BOOKINGS_SQL},
drawn AS (SELECT market_segment, {_DRAWN} AS p FROM sound_bookings),
top AS (SELECT market_segment FROM drawn WHERE p < 1 - 0.2::DOUBLE - 0.2::DOUBLE
        GROUP BY 1 ORDER BY count(*) DESC, market_segment LIMIT 1),
test AS (SELECT market_segment AS t, (SELECT market_segment FROM top) AS p
         FROM drawn WHERE p >= 1 - 0.2::DOUBLE)
SELECT t AS "true", p AS predicted, count(*) AS n FROM test GROUP BY 1, 2"""
)
def majority_baseline(spark, sf_dir):
    rows = sound_bookings(spark, sf_dir).select("booking_id", "market_segment")
    split = hashed_split(rows, "booking_id", SEED)
    predicted = modeling.majority_baseline(
        split.filter("split = 'train'"), split.filter("split = 'test'"), "market_segment"
    )
    return evaluation.confusion_counts(predicted, "market_segment", "predicted_segment")


_CATEGORIES = features.BOOKING_SPEC.sources("category")
_PLAIN_INPUTS = len(features.BOOKING_SPEC.outputs(*features.MEASURED, "presence"))
_COUNTED_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS category, count(*) AS n FROM sound_bookings GROUP BY {c}"
    for c in _CATEGORIES
)


@query(
    f"""WITH {SOUND_BOOKINGS_SQL},
counted AS ({_COUNTED_SQL}),
widths AS (SELECT feature, count(*) FILTER (WHERE n >= 20) + max((n < 20)::INT) AS width
           FROM counted WHERE category IS NOT NULL GROUP BY 1)
SELECT market_segment, count(*) AS n_rows, {_PLAIN_INPUTS} + (SELECT sum(width) FROM widths)::BIGINT AS width,
       {len(_CATEGORIES)} * count(*) AS one_hot_entries,
       sum((agent IS NOT NULL)::INT + (company IS NOT NULL)::INT)::BIGINT AS present
FROM sound_bookings GROUP BY 1"""
)
def feat_assembled(spark, sf_dir):
    """The preprocessor fitted on all bookings: the vector's width, its one-hot and presence entries."""
    # staged: learning takes several passes, none of which joins and adds up the lines again
    wanted = ["market_segment", *features.BOOKING_SPEC.sources()]
    rows = stage_table(_modelled_bookings(spark, sf_dir).select(*wanted), "assembled")
    fitted = features.fit_preprocessor(rows, features.BOOKING_SPEC)
    # sums per place of the vectors: what is summed holds flags, 0 or 1
    sums = vector_to_array(Summarizer.normL1(F.col("features")))
    found = fitted.transform(rows).groupBy("market_segment").agg(
        F.count("*").alias("n_rows"), sums.alias("v")
    )
    measured = len(features.BOOKING_SPEC.outputs(*features.MEASURED))
    total = lambda part: F.aggregate(part, F.lit(0.0), lambda a, x: a + x).cast("long")
    return found.select(
        "market_segment",
        "n_rows",
        F.size("v").cast("long").alias("width"),
        total(F.slice("v", _PLAIN_INPUTS + 1, F.size("v"))).alias("one_hot_entries"),
        total(F.slice("v", measured + 1, _PLAIN_INPUTS - measured)).alias("present"),
    )


# -- model jobs -----------------------------------------------------------

#: Trials of a search, the defaults among them.
N_TRIALS = 8


@query(
    """WITH sizes AS (SELECT count(*) AS n FROM embeddings GROUP BY label)
SELECT sum(floor(floor(n * 0.4::DOUBLE + 0.5) * 0.5::DOUBLE + 0.5))::BIGINT AS n,
       true AS labels_known, true AS scores_bounded, true AS not_below_majority FROM sizes"""
)
def model_fit(spark, sf_dir):
    """A forest on the embedding classes: what must hold of its test scores, whatever the data."""
    split = stratified_split(embedding_rows(spark, sf_dir), "class", "vec_id", SEED)
    train, test = (split.filter(F.col("split") == name) for name in ("train", "test"))
    model = modeling.fit_forest(train, EMBEDDING_SPEC, "class", seed=SEED)
    counts = stage_table(
        evaluation.confusion_counts(model.transform(test), "class", "predicted_segment"), "confusion"
    )
    scores = evaluation.summary_scores(counts)
    naive = modeling.majority_baseline(train, test, "class")
    floor = evaluation.summary_scores(
        evaluation.confusion_counts(naive, "class", "predicted_segment")
    ).select(F.col("weighted_f1").alias("floor_f1"))
    strange = counts.filter(~F.col("predicted").isin(modeling.classes_of(model)))
    bounded = [F.col(c).between(0, 1) for c in ("accuracy", "weighted_f1", "macro_f1")]
    return scores.join(F.broadcast(floor), how="cross").select(
        "n",
        F.lit(strange.isEmpty()).alias("labels_known"),
        (bounded[0] & bounded[1] & bounded[2]).alias("scores_bounded"),
        (F.col("weighted_f1") >= F.col("floor_f1")).alias("not_below_majority"),
    )


def _trials_sql() -> str:
    """The drawn trials as they must come back: scored within bounds, one of them the best."""
    shown = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    rows = [
        f"({i}, {t.n_estimators}, {shown(t.max_depth)}::INT, {t.min_samples_leaf}, {shown(t.max_features)})"
        for i, t in enumerate(modeling.draw_trials(N_TRIALS, SEED))
    ]
    return f"""SELECT *, true AS score_bounded, true AS best_is_highest, true AS best_not_below_default
FROM (VALUES {", ".join(rows)}) AS t(trial, n_estimators, max_depth, min_samples_leaf, max_features)"""


@query(_trials_sql())
def model_search(spark, sf_dir):
    """Trials with the defaults first, scored on the validation rows; what must hold of scores."""
    split = stratified_split(embedding_rows(spark, sf_dir), "class", "vec_id", SEED)
    result = modeling.search(
        split.filter("split = 'train'"),
        split.filter("split = 'validation'"),
        EMBEDDING_SPEC,
        "class",
        modeling.draw_trials(N_TRIALS, SEED),
        SEED,
    )
    highest = max(score for _, score in result.trials)
    rows = [
        (i, t.n_estimators, t.max_depth, t.min_samples_leaf, t.max_features, 0 <= s <= 1,
         result.best_score == highest and (result.best, highest) in result.trials,
         result.best_score >= result.default_score == result.trials[0][1])
        for i, (t, s) in enumerate(result.trials)
    ]
    return spark.createDataFrame(
        rows,
        "trial int, n_estimators int, max_depth int, min_samples_leaf int, max_features string, "
        "score_bounded boolean, best_is_highest boolean, best_not_below_default boolean",
    )


def _modelled_bookings(spark, sf_dir):
    return map_month_name(sound_bookings(spark, sf_dir))


@query(
    f"""WITH {SOUND_BOOKINGS_SQL},
years AS (SELECT arrival_date_year AS y, count(*) AS n FROM sound_bookings GROUP BY 1),
holdout AS (SELECT max(y) AS y FROM years)
SELECT string_agg(y::VARCHAR, ',' ORDER BY y) FILTER (WHERE y < (SELECT y FROM holdout)) AS train_years,
       (SELECT y FROM holdout)::INT AS holdout_year,
       (sum(n) FILTER (WHERE y < (SELECT y FROM holdout)))::BIGINT AS n_train,
       (sum(n) FILTER (WHERE y = (SELECT y FROM holdout)))::BIGINT AS n_test,
       true AS scores_bounded
FROM years"""
)
def model_backtest(spark, sf_dir):
    """Fitted on all order years but the last, scored on the last."""
    result = modeling.temporal_backtest(
        stage_table(_modelled_bookings(spark, sf_dir), "bookings"),
        features.BOOKING_SPEC,
        "market_segment",
        "arrival_date_year",
        seed=SEED,
    )
    return result.select(
        F.array_join("train_years", ",").alias("train_years"),
        "holdout_year",
        "n_train",
        "n_test",
        (F.col("f1_weighted").between(0, 1) & F.col("f1_macro").between(0, 1)).alias(
            "scores_bounded"
        ),
    )


def _booking_model(rows):
    split = hashed_split(rows, "booking_id", SEED)
    return modeling.fit_forest(
        split.filter("split = 'train'").drop("split"),
        features.BOOKING_SPEC,
        "market_segment",
        seed=SEED,
    )


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}
SELECT sha256(booking_id::VARCHAR || ':1') AS prediction_id, booking_id, '1' AS model_version,
       true AS class_known, true AS confidence_bounded, true AS margin_bounded
FROM sound_bookings"""
)
def model_score(spark, sf_dir):
    """Every booking with its id, and whether label, confidence and margin are in bounds."""
    rows = stage_table(_modelled_bookings(spark, sf_dir), "bookings")
    model = _booking_model(rows)
    scored = modeling.score_batch(model, rows, "booking_id", "1")
    least = 1.0 / len(modeling.classes_of(model)) - 1e-9
    return scored.select(
        "prediction_id",
        "booking_id",
        "model_version",
        F.col("predicted_segment").isin(modeling.classes_of(model)).alias("class_known"),
        F.col("confidence").between(least, 1 + 1e-9).alias("confidence_bounded"),
        (F.col("margin").between(0, 1 + 1e-9) & (F.col("margin") <= F.col("confidence"))).alias(
            "margin_bounded"
        ),
    )


@query(
    f"""WITH {SOUND_BOOKINGS_SQL}
SELECT sha256(booking_id::VARCHAR || ':1') AS prediction_id, 'segments' AS model_name,
       'staging' AS model_alias, '1' AS model_version, lead_time, adr, true AS scored
FROM sound_bookings WHERE adr >= 0 AND children IS NOT NULL"""
)
def score_log(spark, sf_dir):
    """Bookings checked, scored and appended, one batch sent twice; read back from the log."""
    rows = stage_table(_modelled_bookings(spark, sf_dir), "bookings")
    served = ServedModel(_booking_model(rows), "segments", "staging", "1")
    log = PredictionLog(spark, scratch_path(spark, "score-log"))
    for batch in ("first", "again"):
        score_and_log(
            served, rows, "booking_id", F.lit("2024-02-01").cast("timestamp"), log, batch
        )
    inputs = F.from_json("features", "lead_time bigint, adr double")
    return log.read().withColumn("inputs", inputs).select(
        "prediction_id",
        "model_name",
        "model_alias",
        "model_version",
        "inputs.lead_time",
        "inputs.adr",
        (F.col("predicted_segment").isNotNull() & F.col("confidence").between(0, 1 + 1e-9)).alias(
            "scored"
        ),
    )
