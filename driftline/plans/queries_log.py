"""Queries: profiles, drift, prediction log, labels, promotion, lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import ERFC_POLYNOMIAL, critical_z
from ..functions.values import half_up, utc_instant
from ..operators import drift, evaluation, feedback, lineage, promotion
from ..runtime import scratch_path, stage_table
from ..sources.stores import LabelStore, PredictionLog, SummaryStore, purge
from . import registry_job
from .drift_job import day_summaries, run_drift_check, run_summarized_check
from .registry import half_up_sql, query
from .testbed import table

# -- events as a prediction log -------------------------------------------------------

FEATURES = ["k", "value"]
# The profile is taken from the days before this one, the check window ends with the month.
EARLY_UNTIL = "2024-01-20 00:00:00"
AS_OF = "2024-01-31 00:00:00"
WINDOW_HOURS = 168
MIN_PREDICTIONS = 20


def event_log(spark, sf_dir):
    """Events as logged predictions: the event type is the model version."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("prediction_id"),
        F.col("ts").alias("predicted_at"),
        F.col("event_type").alias("model_version"),
        F.concat(F.lit('{"value": '), F.col("value"), F.lit(", "), F.substr("props", F.lit(2)))
        .alias("features"),
    )


def _instant(text: str):
    return F.lit(text).cast("timestamp_ntz")


def event_profiles(spark, sf_dir):
    early = event_log(spark, sf_dir).filter(F.col("predicted_at") < _instant(EARLY_UNTIL))
    flat = drift.flatten_features(early, "features", FEATURES)
    return drift.reference_profile(flat, FEATURES, ["model_version"])


_LOG_SQL = f"""log AS (
  SELECT event_id, ts, event_type AS model_version, value, (props->>'$.k')::DOUBLE AS k
  FROM events),
cells AS (
  SELECT event_id, ts, model_version, 'k' AS feature, k AS x FROM log
  UNION ALL SELECT event_id, ts, model_version, 'value', value FROM log),
profile AS (
  SELECT model_version, feature, avg(x) AS mean, stddev_pop(x) AS std
  FROM cells WHERE ts < TIMESTAMP '{EARLY_UNTIL}' GROUP BY 1, 2),
recent AS (
  SELECT * FROM cells
  WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL {WINDOW_HOURS} HOURS),
batch AS (SELECT model_version, feature, count(*) AS n, avg(x) AS mean FROM recent GROUP BY 1, 2)"""


def p_value_sql(z: str) -> str:
    """The same approximation as two_sided_p, written for the oracle."""
    series = ""
    for coefficient in reversed(ERFC_POLYNOMIAL):
        series = f"({coefficient}::DOUBLE{' + t * ' + series if series else ''})"
    return (
        f"(SELECT least(1.0, t * exp({series} - x * x)) FROM (SELECT x, 1.0::DOUBLE / "
        f"(1.0 + x * 0.5::DOUBLE) AS t FROM (SELECT abs({z}) / sqrt(2.0::DOUBLE) AS x)))"
    )


_CHECKS_SQL = (
    f"WITH {_LOG_SQL}, scored AS ("
    "SELECT model_version, feature, p.mean AS reference_mean, b.mean AS batch_mean, n, "
    "(b.mean - p.mean) / (p.std / sqrt(n::DOUBLE)) AS z "
    "FROM profile p JOIN batch b USING (model_version, feature) WHERE n >= 2), "
    f"checks AS (SELECT *, {p_value_sql('z')} AS p_value, "
    f"CASE WHEN abs(z) > {critical_z(0.05)!r}::DOUBLE THEN 'ALERT' ELSE 'OK' END AS status "
    "FROM scored)"
)


@query(
    """WITH cells AS (
"""
    + " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS feature, "
        f"CASE WHEN l_linenumber <> 3 THEN {c} END AS x FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
    + f""" UNION ALL SELECT l_returnflag, 'constant', 1.0 FROM lineitem)
SELECT l_returnflag, feature, {half_up_sql("avg(x)", 6)} AS mean,
       CASE WHEN stddev_pop(x) = 0 THEN 1e-9::DOUBLE ELSE {half_up_sql("stddev_pop(x)", 6)} END
         AS std,
       {half_up_sql("(count(*) - count(x)) / count(*)", 6)} AS missing_rate, count(*) AS n_rows
FROM cells GROUP BY 1, 2"""
)
def profile_reference(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_discount", "l_tax"]
    gaps = lines.select(
        "l_returnflag",
        *[F.when(F.col("l_linenumber") != 3, F.col(c)).alias(c) for c in names],
        F.lit(1.0).alias("constant"),
        F.lit(None).cast("double").alias("empty"),
        F.col("l_linestatus"),
    )
    profile = drift.reference_profile(
        gaps, [*names, "constant", "empty", "l_linestatus"], ["l_returnflag"]
    )
    std = F.when(F.col("std") == drift.ZERO_STD, F.col("std")).otherwise(half_up("std", 6))
    return profile.select(
        "l_returnflag",
        "feature",
        half_up("mean", 6).alias("mean"),
        std.alias("std"),
        half_up("missing_rate", 6).alias("missing_rate"),
        "n_rows",
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE (props->>'$.k')::DOUBLE END AS k,
       CASE WHEN event_id % 7 = 1 THEN NULL WHEN event_id % 7 = 2 THEN 1.0 ELSE value END
         AS "nested.value",
       NULL::DOUBLE AS absent FROM events"""
)
def log_flatten(spark, sf_dir):
    """Broken JSON, unreadable values, booleans, nested keys and numeric strings."""
    case = F.col("event_id") % 7
    k = F.get_json_object("props", "$.k")
    value = F.when(case == 1, '"n/a"').when(case == 2, "true").otherwise(
        F.col("value").cast("string")
    )
    document = F.concat(
        F.lit('{"k": "'), k, F.lit('", "nested": {"value": '), value, F.lit("}}")
    )
    whole = F.when(
        case == 0,
        F.concat(F.lit('{"k": null, "nested": {"value": '), F.col("value"), F.lit("}}")),
    ).otherwise(document)
    rows = table(spark, sf_dir, "events").select("event_id", whole.alias("features"))
    return drift.flatten_features(rows, "features", ["k", "nested.value", "absent"]).drop(
        "features"
    )


@query(
    f"""WITH recent AS (
  SELECT event_id, event_type,
         row_number() OVER (PARTITION BY event_type
                            ORDER BY ts DESC, md5('0:' || event_id::VARCHAR)) AS r
  FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL {WINDOW_HOURS} HOURS)
SELECT event_id::VARCHAR AS prediction_id, event_type AS model_version FROM recent WHERE r <= 300"""
)
def log_window(spark, sf_dir):
    """The newest 300 predictions per version of the last week."""
    return feedback.recent_predictions(
        event_log(spark, sf_dir), _instant(AS_OF), WINDOW_HOURS, 300, keep=("prediction_id",)
    ).select("prediction_id", "model_version")


@query(
    _CHECKS_SQL
    + f""" SELECT model_version, feature, {half_up_sql("reference_mean", 6)} AS reference_mean,
       {half_up_sql("batch_mean", 6)} AS batch_mean, {half_up_sql("z", 6)} AS z_score,
       {half_up_sql("p_value", 6)} AS p_value, status FROM checks"""
)
def drift_ztest(spark, sf_dir):
    recent = feedback.recent_predictions(
        event_log(spark, sf_dir), _instant(AS_OF), WINDOW_HOURS
    )
    flat = drift.flatten_features(recent, "features", FEATURES)
    batch = drift.batch_statistics(flat, FEATURES, ["model_version"])
    baselines = drift.nest_profile(event_profiles(spark, sf_dir), ["model_version"])
    checks = drift.z_test(batch, baselines, ["model_version"], alpha=0.05)
    numbers = ("reference_mean", "batch_mean", "z_score", "p_value")
    return checks.select(
        "model_version", "feature", *[half_up(c, 6).alias(c) for c in numbers], "status"
    )


_VERDICT_SQL = f""", sizes AS (
  SELECT model_version, count(*) FILTER (WHERE feature = 'k')::BIGINT AS n_rows
  FROM recent GROUP BY 1),
per_version AS (
  SELECT model_version, count(*) AS n_checks, count(*) FILTER (WHERE status = 'ALERT') AS n_alerts,
         string_agg(feature, ', ' ORDER BY feature) FILTER (WHERE status = 'ALERT') AS alerts
  FROM checks GROUP BY 1),
report AS (
  SELECT v.model_version, coalesce(n_rows, 0) AS n_rows, coalesce(n_checks, 0) AS n_checks,
         coalesce(n_alerts, 0) AS n_alerts, alerts,
         v.model_version IN (SELECT model_version FROM profile) AS known
  FROM (SELECT DISTINCT model_version FROM log UNION ALL SELECT 'unserved') v
       LEFT JOIN sizes USING (model_version) LEFT JOIN per_version USING (model_version))
SELECT model_version,
       CASE WHEN NOT known OR n_rows < {MIN_PREDICTIONS} OR n_checks = 0 THEN 'SKIPPED'
            WHEN n_alerts > 0 THEN 'ALERT' ELSE 'OK' END AS status,
       CASE WHEN NOT known THEN 'no profile is stored for version ' || model_version
            WHEN n_rows < {MIN_PREDICTIONS}
              THEN 'too little traffic: ' || n_rows || ' of {MIN_PREDICTIONS}'
            WHEN n_checks = 0 THEN 'profile and batch have no number in common'
            WHEN n_alerts > 0 THEN 'p < 0.05 for ' || alerts
            ELSE 'all means agree with the profile' END AS reason,
       n_rows, n_checks, n_alerts FROM report"""


def _event_report(spark, sf_dir):
    log = event_log(spark, sf_dir)
    versions = log.select("model_version").distinct()
    unserved = spark.createDataFrame([("unserved",)], "model_version string")
    policy = drift.DriftPolicy(window_hours=WINDOW_HOURS, min_predictions=MIN_PREDICTIONS)
    return run_drift_check(
        log,
        event_profiles(spark, sf_dir),
        versions.unionByName(unserved),
        _instant(AS_OF),
        policy,
    )


@query(_CHECKS_SQL + _VERDICT_SQL)
def drift_report(spark, sf_dir):
    return _event_report(spark, sf_dir).select(
        "model_version",
        "status",
        "reason",
        "n_rows",
        F.size("features").cast("long").alias("n_checks"),
        F.size(drift.alerted("features")).cast("long").alias("n_alerts"),
    )


@query(_CHECKS_SQL + _VERDICT_SQL)
def drift_summaries(spark, sf_dir):
    """The drift report from stored day summaries and the rows of the window's first day."""
    log = event_log(spark, sf_dir).withColumn("day", F.to_date("predicted_at"))
    store = SummaryStore(spark, scratch_path(spark, "summaries"))
    store.write(day_summaries(log, FEATURES), "all-days")
    unserved = spark.createDataFrame([("unserved",)], "model_version string")
    report = run_summarized_check(
        log,
        store.read(),
        event_profiles(spark, sf_dir),
        log.select("model_version").distinct().unionByName(unserved),
        _instant(AS_OF),
        drift.DriftPolicy(window_hours=WINDOW_HOURS, min_predictions=MIN_PREDICTIONS),
    )
    return report.select(
        "model_version",
        "status",
        "reason",
        "n_rows",
        F.size("features").cast("long").alias("n_checks"),
        F.size(drift.alerted("features")).cast("long").alias("n_alerts"),
    )


_FACTS_SQL = (
    _CHECKS_SQL
    + _VERDICT_SQL.replace("SELECT model_version,\n       CASE", ", verdicts AS (SELECT "
                           "model_version,\n       CASE", 1)
    + f""")
SELECT model_version AS run_id, 'tag' AS kind, 'drift_status' AS key, status AS value FROM verdicts
UNION ALL SELECT model_version, 'metric', 'n_rows', n_rows::VARCHAR FROM verdicts
UNION ALL SELECT model_version, 'metric', 'n_features_checked', n_checks::VARCHAR FROM verdicts
UNION ALL SELECT model_version, 'metric', 'n_features_alerted', n_alerts::VARCHAR FROM verdicts
UNION ALL SELECT model_version, 'metric', 'z_' || feature,
                 (floor(z * 1000 + 0.5)::BIGINT)::VARCHAR FROM checks"""
)


@query(_FACTS_SQL)
def drift_facts(spark, sf_dir):
    """The recorded facts of the checks; scores as whole thousandths."""
    facts = lineage.check_facts(_event_report(spark, sf_dir), F.col("model_version"))
    thousandths = F.floor(F.col("value").try_cast("double") * 1000 + 0.5).cast("string")
    return facts.withColumn(
        "value", F.when(F.col("key").startswith("z_"), thousandths).otherwise(F.col("value"))
    )


@query(_FACTS_SQL.replace("SELECT model_version AS run_id,", "SELECT 'check-1/' || model_version AS run_id,")
       .replace("UNION ALL SELECT model_version,", "UNION ALL SELECT 'check-1/' || model_version,"))
def drift_stored(spark, sf_dir):
    """The check by alias over stores: versions from the registry, facts read back from the runs."""
    registry = registry_job.Registry(spark, scratch_path(spark, "drift-registry"))
    log = PredictionLog(spark, scratch_path(spark, "drift-log"))
    rows = event_log(spark, sf_dir).select(
        "prediction_id",
        utc_instant("predicted_at").alias("predicted_at"),
        F.lit("events").alias("model_name"),
        F.lit("live").alias("model_alias"),
        "model_version",
        F.lit("x").alias("predicted_segment"),
        *[F.lit(None).cast("double").alias(c) for c in ("confidence", "margin")],
        "features",
    )
    log.append(rows, "0")
    types = stage_table(rows.select("model_version").distinct(), "types")
    types = types.unionByName(spark.createDataFrame([("unserved",)], "model_version string"))
    versions = types.select(
        F.col("model_version").alias("model"),
        F.col("model_version").alias("version"),
        F.concat(F.lit("run-"), "model_version").alias("run_id"),
    )
    registry.register(versions, "000")
    registry.aliases().write(versions.withColumn("alias", F.lit("live")), "000")
    registry.profiles().write(event_profiles(spark, sf_dir), "all-versions")
    policy = drift.DriftPolicy(
        window_hours=WINDOW_HOURS, min_predictions=MIN_PREDICTIONS, fail_on_alert=False
    )
    as_of = utc_instant(F.lit(AS_OF).cast("timestamp_ntz"))
    registry_job.check_aliases(registry, log, "live", as_of, "check-1", policy)
    facts = registry.runs().read().filter("kind <> 'artifact'").drop("batch")
    thousandths = F.floor(F.col("value").try_cast("double") * 1000 + 0.5).cast("string")
    return facts.withColumn(
        "value", F.when(F.col("key").startswith("z_"), thousandths).otherwise(F.col("value"))
    )


@query(
    """WITH batch AS (
  SELECT event_id + CASE WHEN event_id % 3 = 0 THEN 100000000 ELSE 0 END AS id, ts, value * 2 AS value
  FROM events
  UNION ALL SELECT event_id + 100000000, ts - INTERVAL 1 HOUR, -value FROM events
  WHERE event_id % 6 = 0),
fresh AS (
  SELECT id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts) AS r FROM batch)
  WHERE r = 1 AND id NOT IN (SELECT event_id FROM events))
SELECT event_id AS prediction_id, value FROM events UNION ALL SELECT id, value FROM fresh"""
)
def log_append(spark, sf_dir):
    """The events sent again, a third of them under a new id, half of those twice."""
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("prediction_id"), F.col("ts").alias("predicted_at"), "value"
    )
    new_id = F.col("prediction_id") + 100_000_000
    again = log.select(
        F.when(F.col("prediction_id") % 3 == 0, new_id)
        .otherwise(F.col("prediction_id"))
        .alias("prediction_id"),
        "predicted_at",
        (F.col("value") * 2).alias("value"),
    )
    earlier = log.filter(F.col("prediction_id") % 6 == 0).select(
        new_id.alias("prediction_id"),
        (F.col("predicted_at") - F.expr("INTERVAL 1 HOUR")).alias("predicted_at"),
        (-F.col("value")).alias("value"),
    )
    grown = feedback.append_predictions(log, again.unionByName(earlier))
    return grown.select("prediction_id", "value")


# -- documents as predictions, their quality as late labels ---------------------------


def document_predictions(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("prediction_id"),
        F.when(F.col("n_chars") >= 500, "1").otherwise("0").alias("predicted_segment"),
        F.col("lang").alias("model_version"),
    )


def _labels(spark, sf_dir, segment, order: int, offset: int = 0):
    return table(spark, sf_dir, "labels").select(
        (F.col("doc_id") + offset).cast("string").alias("prediction_id"),
        F.col(segment).cast("string").alias("actual_segment"),
        F.lit(order).cast("long").alias("labeled_at"),
        F.lit("audit").alias("label_source"),
    )


def label_batches(spark, sf_dir):
    """(stored labels, batch): corrections of some ids and ids nobody predicted."""
    doc = F.col("prediction_id").cast("long")
    stored = _labels(spark, sf_dir, "toxic", 9).filter(doc % 3 == 0)
    batch = (
        _labels(spark, sf_dir, "quality", 1)
        .filter(doc % 2 == 0)
        .unionByName(_labels(spark, sf_dir, "toxic", 2).filter(doc % 4 == 0))
        .unionByName(_labels(spark, sf_dir, "quality", 1, offset=10_000_000))
    )
    return stored, batch


_PREDICTED_SQL = (
    "predicted AS (SELECT doc_id, CASE WHEN n_chars >= 500 THEN '1' ELSE '0' END AS p, lang "
    "FROM documents)"
)
_UPSERT_SQL = f"""{_PREDICTED_SQL}, stored AS (
  SELECT doc_id, toxic::VARCHAR AS actual, 9 AS seq FROM labels WHERE doc_id % 3 = 0),
batch AS (
  SELECT doc_id, quality::VARCHAR AS actual, 1 AS seq FROM labels WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, toxic::VARCHAR, 2 FROM labels WHERE doc_id % 4 = 0
  UNION ALL SELECT doc_id + 10000000, quality::VARCHAR, 1 FROM labels),
last AS (
  SELECT doc_id, actual, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq DESC) AS r FROM batch)
  WHERE r = 1 AND doc_id IN (SELECT doc_id FROM documents)),
upserted AS (
  SELECT * FROM last
  UNION ALL SELECT * FROM stored WHERE doc_id NOT IN (SELECT doc_id FROM last))"""


@query(
    f"""WITH {_UPSERT_SQL}
SELECT doc_id::VARCHAR AS prediction_id, actual AS actual_segment, seq::BIGINT AS labeled_at
FROM upserted"""
)
def labels_upsert(spark, sf_dir):
    stored, batch = label_batches(spark, sf_dir)
    result = feedback.upsert_labels(document_predictions(spark, sf_dir), stored, batch)
    return result.labels.select("prediction_id", "actual_segment", "labeled_at")


@query(
    f"""WITH {_UPSERT_SQL}
SELECT count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM documents))::BIGINT AS accepted,
       count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents))::BIGINT AS skipped
FROM batch"""
)
def labels_counts(spark, sf_dir):
    stored, batch = label_batches(spark, sf_dir)
    return feedback.upsert_labels(document_predictions(spark, sf_dir), stored, batch).counts


@query(
    f"""WITH {_UPSERT_SQL},
pairs AS (SELECT lang, actual AS t, p FROM upserted JOIN predicted USING (doc_id)),
seen AS (SELECT DISTINCT lang, l FROM (
  SELECT lang, t AS l FROM pairs UNION ALL SELECT lang, p FROM pairs)),
sums AS (
  SELECT s.lang, l, count(*) FILTER (WHERE t = l) AS support,
         2.0::DOUBLE * count(*) FILTER (WHERE t = l AND p = l)
         / (count(*) FILTER (WHERE t = l) + count(*) FILTER (WHERE p = l)) AS f1,
         count(*) FILTER (WHERE t = l AND p = l) AS hit
  FROM seen s JOIN pairs q ON q.lang = s.lang AND (t = l OR p = l) GROUP BY 1, 2)
SELECT lang AS model_version, sum(support)::BIGINT AS n,
       {half_up_sql("sum(hit) / sum(support)", 6)} AS accuracy,
       {half_up_sql("sum(f1 * support) / sum(support)", 6)} AS f1_weighted,
       {half_up_sql("avg(f1)", 6)} AS f1_macro FROM sums GROUP BY 1"""
)
def labels_accuracy(spark, sf_dir):
    predictions = document_predictions(spark, sf_dir)
    stored, batch = label_batches(spark, sf_dir)
    labels = feedback.upsert_labels(predictions, stored, batch).labels
    scores = feedback.labelled_accuracy(predictions, labels, ["model_version"])
    numbers = ("accuracy", "f1_weighted", "f1_macro")
    return scores.select("model_version", "n", *[half_up(c, 6).alias(c) for c in numbers])


@query(
    """SELECT doc_id::VARCHAR AS prediction_id, 'prediction' AS kind FROM documents WHERE lang <> 'fr'
UNION ALL SELECT doc_id::VARCHAR, 'label' FROM labels
WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang <> 'fr')"""
)
def log_purge(spark, sf_dir):
    """A language deleted from the stores, twice under one name; its labels go with it."""
    rows = document_predictions(spark, sf_dir).select(
        "prediction_id",
        F.timestamp_seconds(F.lit(0)).alias("predicted_at"),
        F.lit("m").alias("model_name"),
        F.lit("a").alias("model_alias"),
        "model_version",
        "predicted_segment",
        *[F.lit(None).cast("double").alias(c) for c in ("confidence", "margin")],
        F.lit("{}").alias("features"),
    )
    log = PredictionLog(spark, scratch_path(spark, "purged-log"))
    store = LabelStore(spark, scratch_path(spark, "purged-labels"))
    odd = F.col("prediction_id").cast("long") % 2 == 1
    log.append(rows.filter(odd), "0")
    log.append(rows, "1")
    labels = _labels(spark, sf_dir, "quality", 1)
    store.upsert(log, labels.withColumn("labeled_at", F.timestamp_seconds("labeled_at")), "0")
    for _ in range(2):
        purge(log, store, F.col("model_version") == "fr", "drop-fr")
    kept = log.live().select("prediction_id", F.lit("prediction").alias("kind"))
    return kept.unionByName(store.current().select("prediction_id", F.lit("label").alias("kind")))


# -- promotion ------------------------------------------------------------------------

MIN_F1 = 0.5


def supplier_runs(spark, sf_dir):
    """A run per supplier and ship year: the score is the mean quantity over 50."""
    year = F.year("l_shipdate")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat(F.lit("s"), F.col("l_suppkey")).alias("model"),
            year.cast("long").alias("run_order"),
        )
        .agg((F.avg("l_quantity") / 50).alias("f1"))
        .select(
            "model",
            "run_order",
            F.col("run_order").cast("string").alias("version"),
            F.concat_ws("-", "model", "run_order").alias("run_id"),
            "f1",
            evaluation.gate_verdict("f1", MIN_F1).alias("quality_gate"),
        )
    )


def _registry(spark, sf_dir):
    """(candidates, runs, versions, aliases, profiles): each year against the one before.

    The alias of a year points at the version of the year before; every tenth supplier has
    lost the run ids of its versions, every ninth run its profile.
    """
    runs = supplier_runs(spark, sf_dir)
    supplier = F.substr("model", F.lit(2)).cast("long")
    candidates = runs.select("run_id", "model", F.col("run_order").cast("string").alias("alias"))
    versions = runs.select(
        "model",
        "version",
        "run_id",
        F.when(F.col("run_order") % 3 != 0, (F.col("run_order") - 1).cast("string"))
        .otherwise("none")
        .alias("promoted_from_version"),
    )
    aliases = runs.filter("run_order < 2001").select(
        "model", (F.col("run_order") + 1).cast("string").alias("alias"), "version"
    )
    profiles = runs.filter((supplier + F.col("run_order")) % 9 != 0).select(
        "run_id", F.col("f1").alias("f1_weighted")
    )
    return candidates, runs.select("run_id", "quality_gate"), versions, aliases, profiles


_RUNS_SQL = f"""runs AS (
  SELECT l_suppkey AS s, year(l_shipdate)::BIGINT AS y, avg(l_quantity) / 50 AS f1
  FROM lineitem GROUP BY 1, 2),
judged AS (
  SELECT c.s, c.y, p.y AS py, c.f1 >= {MIN_F1} AS passed,
         CASE WHEN (c.s + c.y) % 9 <> 0 THEN c.f1 END AS f1,
         CASE WHEN (p.s + p.y) % 9 <> 0 THEN p.f1 END AS pf1
  FROM runs c LEFT JOIN runs p ON p.s = c.s AND p.y = c.y - 1),
verdicts AS (
  SELECT *, CASE WHEN NOT passed THEN 'error_gate' WHEN py IS NULL THEN 'bootstrap'
                 WHEN f1 IS NULL OR pf1 IS NULL THEN 'error_profile'
                 WHEN f1 - pf1 < -0.01::DOUBLE THEN 'rejected' ELSE 'accepted' END AS verdict
  FROM judged)"""


@query(
    f"""WITH {_RUNS_SQL}
SELECT 's' || s AS model, y::VARCHAR AS version, py::VARCHAR AS champion_version,
       {half_up_sql("f1 - pf1", 6)} AS gap, verdict FROM verdicts"""
)
def promote_verdict(spark, sf_dir):
    verdicts = promotion.promotion_verdict(*_registry(spark, sf_dir))
    return verdicts.select(
        "model", "version", "champion_version", half_up("gap", 6).alias("gap"), "verdict"
    )


@query(
    f"""WITH {_RUNS_SQL}, moved AS (
  SELECT * FROM verdicts WHERE verdict IN ('bootstrap', 'accepted'))
SELECT 'alias' AS kind, 's' || r.s AS model, r.y::VARCHAR AS name,
       coalesce(m.y, r.y - 1)::VARCHAR AS value
FROM (SELECT s, y + 1 AS y FROM runs WHERE y < 2001 UNION SELECT s, y FROM moved) r
     LEFT JOIN moved m USING (s, y)
UNION ALL
SELECT 'version', 's' || r.s, r.y::VARCHAR,
       CASE WHEN m.s IS NOT NULL THEN coalesce(m.py::VARCHAR, 'none')
            WHEN r.y % 3 <> 0 THEN (r.y - 1)::VARCHAR ELSE 'none' END
FROM runs r LEFT JOIN moved m USING (s, y)"""
)
def promote_apply(spark, sf_dir):
    candidates, runs, versions, aliases, profiles = _registry(spark, sf_dir)
    verdicts = promotion.promotion_verdict(candidates, runs, versions, aliases, profiles)
    tagged, pointed = promotion.apply_promotion(verdicts, versions, aliases)
    return pointed.select(
        F.lit("alias").alias("kind"), "model", F.col("alias").alias("name"),
        F.col("version").alias("value"),
    ).unionByName(
        tagged.select(
            F.lit("version").alias("kind"), "model", F.col("version").alias("name"),
            F.col("promoted_from_version").alias("value"),
        )
    )


@query(
    f"""WITH {_RUNS_SQL}, moved AS (
  SELECT * FROM verdicts WHERE verdict IN ('bootstrap', 'accepted'))
SELECT 'alias' AS kind, 's' || r.s AS model, r.y::VARCHAR AS name,
       coalesce(m.y, r.y - 1)::VARCHAR AS value
FROM (SELECT s, y + 1 AS y FROM runs WHERE y < 2001 UNION SELECT s, y FROM moved) r
     LEFT JOIN moved m USING (s, y)
UNION ALL SELECT 'predecessor', 's' || s, y::VARCHAR, coalesce(py::VARCHAR, 'none') FROM moved
UNION ALL SELECT 'canary', 's' || s, y::VARCHAR, verdict FROM verdicts
WHERE verdict IN ('accepted', 'rejected')"""
)
def promote_stored(spark, sf_dir):
    """The promotions as a job over stores, run twice; aliases, lineage and tags read back."""
    candidates, _, versions, aliases, profiles = (
        stage_table(df, "registry") for df in _registry(spark, sf_dir)
    )
    registry = registry_job.Registry(spark, scratch_path(spark, "registry"))
    gates = stage_table(supplier_runs(spark, sf_dir), "runs").select(
        "run_id", F.lit("tag").alias("kind"), F.lit("quality_gate").alias("key"),
        F.col("quality_gate").alias("value"),
    )
    registry.runs().log(gates, "gates")
    scores = profiles.withColumns({"accuracy": F.lit(None).cast("double"), "n_eval": F.lit(0).cast("long")})
    registry.performance().write(scores, "scores")
    registry.register(versions, "000")
    registry.aliases().write(aliases, "000")
    for _ in range(2):
        registry_job.promote(registry, candidates, "001")
    parts = [
        registry.current_aliases().select(
            F.lit("alias").alias("kind"), "model", F.col("alias").alias("name"), F.col("version").alias("value")
        ),
        registry.current_versions().filter("promoted_from_version IS NOT NULL").select(
            F.lit("predecessor").alias("kind"), "model", F.col("version").alias("name"),
            F.col("promoted_from_version").alias("value"),
        ),
        registry.runs().read().filter("key = 'canary_verdict'").select(
            F.lit("canary").alias("kind"),
            F.split("run_id", "-")[0].alias("model"),
            F.split("run_id", "-")[1].alias("name"),
            "value",
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    f"""WITH {_RUNS_SQL}
SELECT 's' || s AS model, (y + 1)::VARCHAR AS alias, y::VARCHAR AS version,
       CASE WHEN y % 3 <> 0 THEN (y - 1)::VARCHAR END AS previous, y % 3 <> 0 AS ok
FROM runs WHERE y < 2001"""
)
def promote_rollback(spark, sf_dir):
    _, _, versions, aliases, _ = _registry(spark, sf_dir)
    return promotion.rollback_verdict(aliases, versions)


@query(
    f"""WITH RECURSIVE {_RUNS_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY y) AS i FROM runs),
history AS (
  SELECT s, i, y, f1, CASE WHEN f1 >= {MIN_F1} THEN 'bootstrap' ELSE 'error_gate' END AS verdict,
         NULL::BIGINT AS champion, NULL::DOUBLE AS champion_f1,
         CASE WHEN f1 >= {MIN_F1} THEN y END AS next, CASE WHEN f1 >= {MIN_F1} THEN f1 END AS next_f1
  FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.s, n.i, n.y, n.f1, v.verdict, h.next, h.next_f1,
         CASE WHEN v.verdict IN ('bootstrap', 'accepted') THEN n.y ELSE h.next END,
         CASE WHEN v.verdict IN ('bootstrap', 'accepted') THEN n.f1 ELSE h.next_f1 END
  FROM history h JOIN numbered n ON n.s = h.s AND n.i = h.i + 1,
       LATERAL (SELECT CASE WHEN n.f1 < {MIN_F1} THEN 'error_gate'
                            WHEN h.next IS NULL THEN 'bootstrap'
                            WHEN n.f1 - h.next_f1 < -0.01::DOUBLE THEN 'rejected'
                            ELSE 'accepted' END AS verdict) v)
SELECT 's' || s AS model, y AS run_order, verdict, champion::VARCHAR AS champion_version
FROM history"""
)
def promote_history(spark, sf_dir):
    history = promotion.replay_promotions(supplier_runs(spark, sf_dir))
    return history.select("model", "run_order", "verdict", "champion_version")


# -- lineage --------------------------------------------------------------------------

_ROW = (
    "md5(" + " || ".join(
        f"coalesce(length({c}::VARCHAR) || ':' || {c}, '-')"
        for c in ("o_orderkey", "o_custkey", "status", "o_orderpriority")
    ) + ")"
)


@query(
    f"""WITH hashes AS (
  SELECT ('0x' || substr({_ROW}, 1, 8))::BIGINT AS h
  FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders))
SELECT count(*) AS n_rows, sum(h)::BIGINT AS hash_sum, bit_xor(h)::BIGINT AS hash_xor FROM hashes"""
)
def fingerprint(spark, sf_dir):
    return _orders_fingerprint(spark, sf_dir)


@query(
    f"""WITH hashes AS (
  SELECT ('0x' || substr({_ROW}, 1, 8))::BIGINT AS h
  FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders))
SELECT 'run-1' AS run_id, 'tag' AS kind, unnest(['git_commit_hash', 'data_hash', 'container_image_tag', 'table'])
         AS key, unnest(['abc', hash, 'local-dev', 'orders']) AS value
FROM (SELECT bit_xor(h)::BIGINT::VARCHAR AS hash FROM hashes)"""
)
def run_lineage(spark, sf_dir):
    """The lineage tags of a run over the orders, whose fingerprint is the data hash."""
    data_hash = str(_orders_fingerprint(spark, sf_dir).first().hash_xor)
    return lineage.run_tags(spark, "run-1", commit="abc", data_hash=data_hash, table="orders")


def _orders_fingerprint(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "status", F.nullif("o_orderstatus", F.lit("P"))
    )
    columns = ["o_orderkey", "o_custkey", "status", "o_orderpriority"]
    return lineage.dataset_fingerprint(orders, columns).withColumn(
        "hash_sum", F.col("hash_sum").cast("long")
    )
