"""Token counts by a two-tier lookup of pre-tokens: broadcast lengths, then worker caches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages, ship, slices, whole_text, worker_state

ship(__name__)

#: Entries of a task's own count of pre-tokens; the rarest half goes when it is full.
TASK_ENTRIES = 20_000
#: What a task reports of them, and entries of the broadcast table: a proven bound of its size.
TASK_REPORT = 2_000
TABLE_ENTRIES = 40_000
#: Longer pre-tokens are neither counted for the table nor cached.
LONGEST_KEY = 64
#: Entries of a worker's cache; a full one starts anew.
CACHE_ENTRIES = 300_000

#: A blank in the model's own alphabet: a text that holds it is encoded whole.
MARK = "▁"


def split_lines(text: str) -> list[list[str]] | None:
    """Words of each line; None if some white space needs the library's own view.

    With single blanks between words, no piece of the vocabulary reaches over the start of a
    word or over a line break, so a text's count is the sum over its words and breaks.
    """
    if "  " in text or MARK in text or text[:1] == " " or text[-1:] == " ":
        return None
    lines = [line.split(" ") for line in text.split("\n")]
    return None if any(len(line) > 1 and "" in line for line in lines) else lines


def pieces_of(model: str):
    import sentencepiece

    return worker_state(f"pieces:{model}", lambda: sentencepiece.SentencePieceProcessor(model_file=model))


def can_split(model: str) -> bool:
    """Whether no piece has a blank after another sign, or a line break: then words are apart."""
    pieces = pieces_of(model)
    plain = (pieces.id_to_piece(i).lstrip(MARK) for i in range(pieces.get_piece_size()))
    return not any(MARK in piece or "\n" in piece for piece in plain)


def frequent_words(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The commonest words of a task's texts, from a count of bounded size."""
    seen: Counter[str] = Counter()
    for batch in slices(texts):
        for text in batch.column(0).to_pylist():
            for line in split_lines(text) or []:
                seen.update(line[1:])
            if len(seen) > TASK_ENTRIES:
                seen = Counter(dict(seen.most_common(TASK_ENTRIES // 2)))
    top = [(w, n) for w, n in seen.most_common(TASK_REPORT) if 0 < len(w) <= LONGEST_KEY]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
        names=["word", "n"],
    )


class WordLengths:
    """Pieces of ' word' (inside a line) and of a line's first word, cached within bounds."""

    def __init__(self, model: str, table: dict[str, int]):
        self.pieces = pieces_of(model)
        self.table = table
        # dummy prefix: a word alone is encoded as if after a blank, so breaks are cut off again
        self.inner: dict[str, int] = {}
        self.first: dict[str, int] = {}

    def _cached(self, cache: dict[str, int], word: str, count: Callable[[str], int]) -> int:
        n = cache.get(word)
        if n is None:
            n = count(word)
            if len(word) <= LONGEST_KEY:
                if len(cache) >= CACHE_ENTRIES:
                    cache.clear()
                cache[word] = n
        return n

    def after_blank(self, word: str) -> int:
        n = self.table.get(word)
        return self._cached(self.inner, word, self._whole) if n is None else n

    def _whole(self, word: str) -> int:
        return len(self.pieces.encode(word))

    def _after_break(self, word: str) -> int:
        return len(self.pieces.encode("\n" + word)) - len(self.pieces.encode("\n"))

    def count(self, text: str) -> int:
        if not text:
            return 0
        lines = split_lines(text)
        if lines is None:
            return self._whole(text)
        total = len(lines) - 1
        for position, line in enumerate(lines):
            if position == 0:
                total += self._whole("\n") - 1 if line[0] == "" else self.after_blank(line[0])
            elif line[0]:
                total += self._cached(self.first, line[0], self._after_break)
            if len(line) > 1:
                lengths = list(map(self.table.get, line[1:]))
                if None in lengths:
                    missed = [w for w, n in zip(line[1:], lengths) if n is None]
                    total += sum(n for n in lengths if n is not None)
                    total += sum(map(self.after_blank, missed))
                else:
                    total += sum(lengths)
        return total


def word_table(texts: DataFrame, model: str) -> dict[str, int]:
    """Lengths of the words that are commonest over all texts: at most TABLE_ENTRIES.

    Tasks report bounded summaries; pre-tokens themselves are never shuffled.
    """
    reports = texts.mapInArrow(frequent_words, "word string, n long")
    top = (
        reports.groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(TABLE_ENTRIES)
        .toArrow()
    )
    words = top.column("word").to_pylist()
    encoded = pieces_of(model).encode(words, num_threads=1) if words else []
    return {word: len(ids) for word, ids in zip(words, encoded)}


def count_tokens(
    docs: DataFrame,
    model: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    stages: Stages | None = None,
) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``model`` is the path of a sentencepiece model, readable on every executor. First tier: the
    lengths of frequent words, broadcast. Second: a cache per worker, filled by the library.
    Texts whose white space is not single blanks and breaks go to the library whole, as do all
    texts if the vocabulary has pieces that reach over words. Tables only save time: any table
    gives the same counts.

    Null texts count as empty: 0 bytes, 0 tokens. Any length is read whole. Rows are counted
    each, repeated or with a null id; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(text_col).alias("text"))
    spark = docs.sparkSession
    apart = can_split(model)
    lengths = spark.sparkContext.broadcast(word_table(rows.select("text"), model) if apart else {})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_state(f"words:{model}", lambda: WordLengths(model, {}))
        words.table = lengths.value
        count = words.count if apart else (lambda text: len(words.pieces.encode(text)))
        for batch in slices(batches):
            found = pa.array(map(count, batch.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), found], names=["id", "n_bytes", "n_tokens"]
            )

    id_type = rows.schema["id"].dataType.simpleString()
    counts = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(
        counted, f"id {id_type}, n_bytes long, n_tokens long"
    )
    return counts.select(
        F.col("id").alias(id_col),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
