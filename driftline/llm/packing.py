"""Best-fit packing: a configuration linear program over the length histogram."""

from __future__ import annotations

import re
import sys
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stages, ship, slices, whole_text, worker_state

ship(__name__)

CAPACITY = 2048
#: Phases of the multiplicative weights; each brings every length to its share of coverage.
PHASES = 8
#: Knapsack tables per phase: every so-many-th length shares one.
REPRICED = 12
#: How fast the price of a length falls with its coverage ahead of the phase.
RATE = 0.2


# -- tokens ---------------------------------------------------------------------------


class TokenBytes:
    """Token ids of a text as little-endian unsigned 32-bit numbers.

    The rank file is the tokenizer's vocabulary in a library that encodes it five times as fast;
    texts that hold one of the tokenizer's special strings go to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.quick = self._by_ranks(ranks) if ranks else self._ids

    @staticmethod
    def _by_ranks(path: str):
        import base64

        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return coder.encode_ordinary

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        ids = array("I", self._ids(text) if self.special.search(text) else self.quick(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def cut(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first is shorter than the capacity."""
    start, first = 0, length % capacity or min(length, capacity)
    while start < length:
        yield start, first
        start, first = start + first, capacity


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, ranks: str | None, end_id: int, capacity: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows (id, piece, start, length, ids, part, place): ids are little-endian unsigned 32-bit,
    place numbers the pieces of equal length inside the task ``part``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(text_col).alias("text"))
    end = np.asarray([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_state(f"ids:{tokenizer}:{ranks}", lambda: TokenBytes(tokenizer, ranks))
        part, places = TaskContext.get().partitionId(), Counter()
        for batch in slices(batches):
            found = defaultdict(list)
            row = []
            for position, text in enumerate(batch.column(1).to_pylist()):
                ids = tokens.encode(text) + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    row.append(position)
                    found["piece"].append(piece)
                    found["start"].append(start)
                    found["length"].append(length)
                    found["ids"].append(ids[4 * start : 4 * (start + length)])
                    found["place"].append(places[length])
                    places[length] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(found["piece"], pa.int32()),
                    pa.array(found["start"], pa.int64()),
                    pa.array(found["length"], pa.int64()),
                    pa.array(found["ids"], pa.binary()),
                    pa.array([part] * len(row), pa.int64()),
                    pa.array(found["place"], pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids", "part", "place"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        encoded,
        f"id {kind}, piece int, start long, length long, ids binary, part long, place long",
    )


# -- configurations -------------------------------------------------------------------


def price_table(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: best value of each room, and the last length taken there (or 0)."""
    value = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        fits = lengths[: np.searchsorted(lengths, room, "right")]
        if len(fits) == 0:
            continue
        gains = value[room - fits] + prices[: len(fits)]
        best = int(gains.argmax())
        if gains[best] > value[room - 1] + 1e-15:
            value[room], last[room] = gains[best], fits[best]
        else:
            value[room] = value[room - 1]
    return value, last


def completion(seed: int, last: np.ndarray, capacity: int) -> tuple[tuple[int, int], ...]:
    """The best-priced configuration that holds the seed length."""
    taken, room = Counter({seed: 1}), capacity - seed
    while room > 0:
        if last[room]:
            taken[int(last[room])] += 1
            room -= int(last[room])
        else:
            room -= 1
    return tuple(sorted(taken.items(), reverse=True))


def fractional_configurations(
    counts: dict[int, int], capacity: int, phases: int = PHASES, rate: float = RATE
) -> dict[tuple[tuple[int, int], ...], float]:
    """A cover of the histogram by configurations, by multiplicative weights.

    A length's price starts at its share of the capacity and falls exponentially with coverage
    ahead of the phase. One knapsack table prices the completions of many lengths at once; in each
    phase every length is brought to the phase's share by its best-priced configuration.
    """
    lengths = np.array(sorted(counts))
    wanted = np.array([counts[n] for n in lengths], float)
    slot = {int(n): i for i, n in enumerate(lengths)}
    covered = np.zeros(len(lengths))
    chosen: dict[tuple[tuple[int, int], ...], float] = defaultdict(float)
    for phase in range(1, phases + 1):
        level = phase / phases
        for part in range(REPRICED):
            ahead = np.maximum(covered / wanted - level + 1 / phases, 0.0) * phases
            prices = lengths / capacity * np.exp(-rate * ahead)
            _, last = price_table(prices, lengths, capacity)
            for i in range(len(lengths) - 1 - part, -1, -REPRICED):
                short = level * wanted[i] - covered[i]
                if short <= 1e-9:
                    continue
                config = completion(int(lengths[i]), last, capacity)
                amount = short / dict(config)[int(lengths[i])]
                chosen[config] += amount
                for length, times in config:
                    covered[slot[length]] += amount * times
    return chosen


def rounded_configurations(
    counts: dict[int, int],
    capacity: int,
    fractional: dict[tuple[tuple[int, int], ...], float],
) -> dict[tuple[tuple[int, int], ...], int]:
    """Whole numbers of configurations that hold every piece exactly once.

    Only configurations without a gap are used. Fractions are carried from one configuration to the next like it, never beyond what is left;
    what remains goes, longest first, into the open sequence where it fits best. Sequences of equal
    content move together, so the work follows the histogram and not the number of pieces.
    """
    left = Counter(counts)
    bins: Counter[tuple[tuple[int, int], ...]] = Counter()
    whole = sum(n * k for n, k in counts.items()) / capacity
    scale = min(1.0, whole / max(1e-9, sum(fractional.values())))
    carried = 0.0
    for config in sorted(fractional, reverse=True):
        if sum(n * k for n, k in config) < capacity:
            continue
        carried += fractional[config] * scale
        times = min([int(carried), *(left[n] // k for n, k in config)])
        if times > 0:
            carried -= times
            bins[config] += times
            for n, k in config:
                left[n] -= k * times
        carried -= int(carried)
    gaps: dict[int, Counter] = defaultdict(Counter)
    for config, times in bins.items():
        gaps[capacity - sum(n * k for n, k in config)][config] += times
    open_gaps = sum(1 << gap for gap in gaps)
    for length in sorted((n for n in left if left[n] > 0), reverse=True):
        while left[length] > 0:
            roomy = open_gaps >> length
            if roomy == 0:
                gap, config, times = capacity, (), left[length]
            else:
                gap = length + (roomy & -roomy).bit_length() - 1
                config, there = next(iter(gaps[gap].items()))
                times = min(there, left[length])
                gaps[gap][config] -= times
                if gaps[gap][config] == 0:
                    del gaps[gap][config]
                if not gaps[gap]:
                    open_gaps &= ~(1 << gap)
            if config == ():
                each = min(capacity // length, left[length])
                times = left[length] // each
            else:
                each = 1
            held = Counter(dict(config))
            held[length] += each
            left[length] -= each * times
            now = gap - each * length
            gaps[now][tuple(sorted(held.items(), reverse=True))] += times
            open_gaps |= 1 << now
    packed: Counter[tuple[tuple[int, int], ...]] = Counter()
    for held in gaps.values():
        packed.update(held)
    return packed


def segments(packed: dict[tuple[tuple[int, int], ...], int]) -> np.ndarray:
    """Rows (length, first rank, sequence of it, pieces per sequence, offset), sorted."""
    ranks: Counter[int] = Counter()
    rows, sequence = [], 0
    for config in sorted(packed, reverse=True):
        offset = 0
        for length, times in config:
            rows.append((length, ranks[length], sequence, times, offset))
            ranks[length] += times * packed[config]
            offset += length * times
        sequence += packed[config]
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = 0,
    carry: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    stages: Stages | None = None,
) -> DataFrame:
    """One row per piece: id, piece, start, length, the carried columns, sequence_id, offset.

    A document is its token ids and ``end_id``; only longer ones than ``capacity`` are cut, the
    first piece taking the remainder. ``carry`` are columns of the pieces (id, piece, start,
    length, ids) to return with them; by default ``ids`` (little-endian unsigned 32-bit).

    The histogram of lengths (at most ``capacity`` rows) decides the configurations on the
    driver; the pieces stay distributed. Each gets its rank among those of equal length from its
    task and the counts of the tasks before, and the rank alone tells sequence and offset. A
    length that most pieces have is spread over the tasks that read them.

    Null and empty texts are one piece with the end id alone. Repeated rows and null ids are
    packed each; texts of any length are read whole. An empty table gives no rows. Other columns
    are not read.
    """
    stages = stages or Stages(docs.sparkSession)
    pieces = tokenized_pieces(docs, tokenizer, ranks, end_id, capacity, id_col, text_col)
    carry = {"ids": F.col("ids")} if carry is None else carry
    carried = [column.alias(name) for name, column in carry.items()]
    base = ["id", "piece", "start", "length", "part", "place"]
    pieces = stages.put(pieces.select(*base, *carried), "pieces")
    held = stages.put(
        pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts"
    )
    counts = {row["length"]: row["n"] for row in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    packed = rounded_configurations(counts, capacity, fractional_configurations(counts, capacity))
    table = segments(packed)
    keys = (table[:, 0] << 44) + table[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            within = rank - at[:, 1]
            columns = [batch.column(c) for c in names] + [
                pa.array(at[:, 2] + within // at[:, 3]),
                pa.array(at[:, 4] + within % at[:, 3] * length),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = held.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from"))
    ranked = pieces.join(starts, ["part", "length"]).withColumn("rank", F.col("from") + F.col("place"))
    names = ["id", "piece", "start", "length", *carry]
    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names)
    return (
        ranked.select(*names, "rank")
        .mapInArrow(placed, f"{kinds}, sequence_id long, offset long")
        .withColumnRenamed("id", id_col)
    )
