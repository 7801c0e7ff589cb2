import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import promotion
from driftline.operators.promotion import PromotionError

VERSIONS = "model string, version string, run_id string, promoted_from_version string"
ALIASES = "model string, alias string, version string"


class Registry:
    """Runs promoted one after the other, through the table operators."""

    def __init__(self, spark):
        self.spark = spark
        self.runs, self.scores = [], []
        self.versions = spark.createDataFrame([], VERSIONS)
        self.aliases = spark.createDataFrame([], ALIASES)

    def add(self, f1, gate="passed"):
        n = str(len(self.runs) + 1)
        self.runs.append((f"run{n}", gate))
        self.scores.append((f"run{n}", f1))
        self.versions = self.versions.unionByName(
            self.spark.createDataFrame([("m", n, f"run{n}", None)], VERSIONS)
        )
        return n

    def promote(self, version):
        candidates = self.spark.createDataFrame(
            [(f"run{version}", "m", "staging")], "run_id string, model string, alias string"
        )
        verdicts = promotion.promotion_verdict(
            candidates,
            self.spark.createDataFrame(self.runs, "run_id string, quality_gate string"),
            self.versions,
            self.aliases,
            self.spark.createDataFrame(self.scores, "run_id string, f1_weighted double"),
        )
        row = verdicts.first()
        versions, aliases = promotion.apply_promotion(verdicts, self.versions, self.aliases)
        self.versions = self.spark.createDataFrame(versions.collect(), VERSIONS)
        self.aliases = self.spark.createDataFrame(aliases.collect(), ALIASES)
        return row

    def rollback(self):
        moved = promotion.rollback(self.aliases, self.versions, "m", "staging")
        self.aliases = self.spark.createDataFrame(moved.collect(), ALIASES)

    @property
    def current(self):
        rows = self.aliases.collect()
        return rows[0].version if rows else None

    def predecessor(self, version):
        return self.versions.filter(F.col("version") == version).first().promoted_from_version


def test_bootstrap_better_tolerated_regressed(spark):
    r = Registry(spark)
    assert r.promote(r.add(0.70)).verdict == "bootstrap"
    assert r.current == "1" and r.predecessor("1") == "none"
    assert r.promote(r.add(0.80)).verdict == "accepted" and r.predecessor("2") == "1"
    assert r.promote(r.add(0.795)).verdict == "accepted" and r.current == "3"
    last = r.promote(r.add(0.50))
    assert last.verdict == "rejected" and r.current == "3" and last.gap == pytest.approx(-0.295)


def test_nominal_edge_is_decided_in_doubles(spark):
    r = Registry(spark)
    r.promote(r.add(0.70))
    assert r.promote(r.add(0.69)).verdict == "rejected"


def test_noop_gate_and_missing_profile(spark):
    r = Registry(spark)
    r.promote(r.add(0.7))
    r.promote(r.add(0.8))
    assert r.promote("2").verdict == "noop" and r.predecessor("2") == "1"
    assert r.promote(r.add(0.9, gate="failed")).verdict == "error_gate"
    assert r.promote(r.add(None)).verdict == "error_profile"
    assert r.current == "2"
    r.versions = r.versions.withColumn(
        "run_id", F.when(F.col("version") != "2", F.col("run_id"))
    )
    r.versions = spark.createDataFrame(r.versions.collect(), VERSIONS)
    # the candidate keeps its run, the champion lost it
    assert r.promote("1").verdict == "error_champion_run"
    r.versions = r.versions.unionByName(
        spark.createDataFrame([("m", "9", "run1", None)], VERSIONS)
    )
    assert r.promote("1").verdict == "error_candidate"


def test_rollback(spark):
    r = Registry(spark)
    with pytest.raises(PromotionError):
        r.rollback()
    r.promote(r.add(0.7))
    with pytest.raises(PromotionError):
        r.rollback()
    r.promote(r.add(0.8))
    r.rollback()
    assert r.current == "1"
    assert promotion.resolve_alias(r.aliases, r.versions).first().run_id == "run1"


def fold(runs, tolerance):
    """The history of one model, run after run."""
    champion, out = None, {}
    for order, f1, gate in sorted(runs):
        before = champion
        if gate != "passed":
            verdict = "error_gate"
        elif champion is None:
            verdict, champion = "bootstrap", (order, f1)
        elif f1 - champion[1] < tolerance:
            verdict = "rejected"
        else:
            verdict, champion = "accepted", (order, f1)
        out[order] = (verdict, None if before is None else f"v{before[0]}")
    return out


@pytest.mark.parametrize("tolerance", [-0.01, 0.0, 0.05, -0.3])
def test_history_equals_the_fold(spark, tolerance):
    rng = random.Random(int(tolerance * 100))
    models = {f"m{i}": [] for i in range(12)}
    models["hot"] = []
    for name, runs in models.items():
        n = 400 if name == "hot" else rng.randint(1, 12)
        level = 0.5
        for order in range(n):
            level += rng.uniform(-0.02, 0.021)
            f1 = level if rng.random() < 0.5 else round(rng.random(), 2)
            runs.append((order, f1, "passed" if rng.random() < 0.8 else "failed"))
    # most runs belong to one model, whose history spans many ranges
    rows = [(m, o, f"v{o}", f, g) for m, runs in models.items() for o, f, g in runs]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows, "model string, run_order bigint, version string, f1 double, quality_gate string"
    )
    got = promotion.replay_promotions(df, tolerance, range_runs=30).collect()
    assert len(got) == len(rows)
    want = {m: fold(runs, tolerance) for m, runs in models.items()}
    for r in got:
        assert (r.verdict, r.champion_version) == want[r.model][r.run_order], (r.model, r.run_order)


def plain_replay(scores, tolerance):
    """(champion before, verdict) run after run."""
    champion, found = None, []
    for score in scores:
        verdict = "bootstrap" if champion is None else "accepted" if score - champion >= tolerance else "rejected"
        found.append((champion, verdict))
        champion = champion if verdict == "rejected" else score
    return found


@pytest.mark.parametrize("tolerance", [-0.05, 0.0, 0.03])
@pytest.mark.parametrize("fan", [2, 3])
def test_maps_of_ranges_compose_as_a_tree(tolerance, fan):
    rng = random.Random(fan)
    for trial in range(12):
        rising = trial % 3 == 0
        scores = [round(i / 60 if rising else rng.random(), 2) for i in range(60)]
        chunk_of = [i // 4 for i in range(60)]
        plain = plain_replay(scores, tolerance)
        rows = []
        for chunk in sorted(set(chunk_of)):
            mine = [s for s, c in zip(scores, chunk_of) if c == chunk]
            rows += [("m", chunk, *step) for step in promotion._steps(mine, [str(s) for s in mine], tolerance)]
        columns = ["model", "chunk", "threshold", "last", "last_version"]
        level, steps = [], pd.DataFrame(rows, columns=columns)
        while steps["chunk"].max() >= fan:  # up
            steps["block"] = steps["chunk"] // fan
            level.append(steps)
            steps = pd.concat([promotion._composed(part, tolerance) for _, part in steps.groupby("block")])
        entries = promotion._entries(steps.assign(entry=None, entry_version=None), tolerance)
        for steps in reversed(level):  # down
            above = entries.rename(columns={"chunk": "block"})
            joined = steps.merge(above, on=["model", "block"])
            entries = pd.concat([promotion._entries(part, tolerance) for _, part in joined.groupby("block")])
        for chunk, entry in zip(entries["chunk"], entries["entry"]):
            expected = plain[chunk * 4][0]
            assert (None if pd.isna(entry) else entry) == expected


@pytest.mark.parametrize("tolerance", [-0.01, 0.02])
def test_one_rising_model_is_replayed_by_a_tree_of_ranges(spark, tolerance, monkeypatch):
    monkeypatch.setattr(promotion, "MIN_RANGE_RUNS", 1)
    scores = [i / 400 for i in range(400)]
    rows = [("m", i, str(i), s, "passed") for i, s in enumerate(scores)]
    rows += [(f"n{i}", 1, "1", 0.5, "passed") for i in range(20)]
    df = spark.createDataFrame(rows, "model string, run_order long, version string, f1 double, quality_gate string")
    got = promotion.replay_promotions(df, tolerance, range_runs=20, fan=3).filter("model = 'm'")
    got = [(r.champion_version, r.verdict) for r in got.orderBy("run_order").collect()]
    expected = [(None if c is None else str(scores.index(c)), v) for c, v in plain_replay(scores, tolerance)]
    assert got == expected
