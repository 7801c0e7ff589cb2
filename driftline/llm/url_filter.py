"""URL rules by a Bloom filter cascade that is exact over the corpus's own keys."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import bloom, has_bits, slots, words_for
from .common import Stages, ascii_lower

#: Hosts (with all subdomains) that the method blocks where no rule fits.
BLOCKED_HOSTS = [
    f"{name}.example.{zone}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for zone in ("com", "net", "org")
]

#: A level that has not emptied the false positives by then has keys with equal hashes.
MAX_LEVELS = 64


@dataclass(frozen=True)
class Cascade:
    """Levels of (filter, words, probes, seed); odd levels hold listed keys, even ones their
    false positives."""

    levels: list[tuple[DataFrame, int, int, int]]

    def contains(self, key: Column) -> Column:
        """Exact for listed keys and for every key of the universe it was fitted on."""
        inside = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            held, words, probes, seed = self.levels[depth]
            hit = has_bits(held, slots(key, words, probes, seed))
            inside = F.when(hit, inside).otherwise(F.lit(depth % 2 == 1))
        return F.coalesce(inside, F.lit(False))


def fit_cascade(stages: Stages, listed: DataFrame, universe: DataFrame, n_universe: int) -> Cascade:
    """Build levels until no false positive is left.

    ``listed`` and ``universe`` have one column ``key``. The first level lets through about as
    many false positives as there are listed keys, later ones half; so the size follows the list.
    Of the universe only first-level false positives are ever shuffled.
    """
    inside = stages.put(listed.filter("key IS NOT NULL").distinct(), "listed")
    count = inside.count()
    if count == 0:
        return Cascade([])
    levels = []
    rate = min(0.5, count / (math.sqrt(2) * max(1, n_universe)))
    outside = universe.join(F.broadcast(inside), "key", "left_anti") if count <= 10_000 else (
        universe.join(inside, "key", "left_anti")
    )
    while True:
        probes = max(1, round(math.log2(1 / rate)))
        words = words_for(count, 1.45 * probes)
        seed = len(levels) + 1
        held = stages.put(bloom(inside, "key", words, probes, seed), "cascade")
        levels.append((held, words, probes, seed))
        hit = has_bits(held, slots(F.col("key"), words, probes, seed))
        wrong = stages.put(outside.filter(hit).distinct(), "false-positives")
        count, rate = wrong.count(), 0.5
        if count == 0:
            return Cascade(levels)
        if len(levels) == MAX_LEVELS:
            raise ValueError("the cascade does not end: different keys share all hashes")
        inside, outside = wrong, inside


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower case, path up to ``?`` or ``#``; else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (
        ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    blocked_hosts: list[str],
    id_col: str = "page_id",
    url_col: str = "url",
    stages: Stages | None = None,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    ``rules`` are (verdict, host, path): a rule fits its host and all subdomains where the path
    starts with the rule's; the longest that fits wins. Where none fits, the method decides: a
    host is blocked if it or a parent is in ``blocked_hosts``. Keys are host suffix + path
    prefix, of the depths and lengths that occur in the lists, so a url has a bounded number of
    keys however long it is. Three cascades (allow, block, hosts) answer membership exactly and
    without a join on the pages.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed.
    Repeated pages are judged each; an empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    stages = stages or Stages(spark)
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))

    labels = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit(""))) + 1

    def key(depth: int, length: int) -> Column:
        fits = (F.col("host") != "") & (labels >= depth) & (F.length("path") >= length)
        name = F.substring_index("host", ".", -depth)
        return F.when(fits, F.concat(name, F.substring("path", 1, length)))

    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    depths = sorted({h.count(".") + 1 for h in blocked_hosts})
    keys = [key(d, n) for d, n in shapes]
    names = [key(d, 0) for d in depths]

    def listed(values: list[str]) -> DataFrame:
        return spark.createDataFrame([(v,) for v in values], "key string")

    def cascade(values: list[str], candidates: list[Column]) -> Cascade:
        if not values:
            return Cascade([])
        universe = rows.select(F.explode(F.array(*candidates)).alias("key")).filter("key IS NOT NULL")
        size = universe.agg(F.approx_count_distinct("key")).first()[0]
        return fit_cascade(stages, listed(values), universe, size)

    allow = cascade([h + p for verdict, h, p in rules if verdict == "allow"], keys)
    block = cascade([h + p for verdict, h, p in rules if verdict == "block"], keys)
    hosts = cascade(blocked_hosts, names)

    def best(members: Cascade) -> Column:
        """The longest key in a list; the empty text if none."""
        if not members.levels:
            return F.lit("")
        fits = [
            F.when(members.contains(k), F.struct(F.length(k).alias("n"), k.alias("key"))) for k in keys
        ]
        return F.coalesce(F.array_max(F.array(*fits))["key"], F.lit(""))

    judged = rows.select("id", "host", "path", best(allow).alias("ok"), best(block).alias("no"))
    by_rule = F.greatest(F.length("ok"), F.length("no")) > 0
    refuse = F.length("no") >= F.length("ok")
    listed_host = F.lit(False)
    for name in names if hosts.levels else []:
        listed_host = listed_host | hosts.contains(name)
    blocked = F.when(by_rule, refuse).otherwise(listed_host)
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.when(by_rule, F.when(refuse, F.col("no")).otherwise(F.col("ok"))).alias("rule"),
        F.when(blocked, "block").otherwise("allow").alias("verdict"),
    )
