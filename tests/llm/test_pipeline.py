"""Every stage of the corpus pipeline on awkward rows, and the whole of it, against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from driftline.llm.mixing import mix
from driftline.llm.toxicity import score_toxicity
from test_join import brute_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"word{k}" for k in range(400)]
    made = []
    for i in range(240):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(30, 60)))
        if i % 6 == 0:
            text = text.replace("word1", "you vile rotten scum", 3) + " you vile rotten scum!!"
        made.append((i, text, rng.choice(["en", "de", None]), rng.choice(["web", "book", None]), len(text)))
    for i in range(60):  # exact copies, other letters, near copies
        _, text, lang, source, n = made[rng.randrange(120)]
        if i % 3 == 1:
            text = text.upper()
        if i % 3 == 2:
            text += f" tail{i}"
        made.append((300 + i, text, lang, source, n))
    odd = [
        (None, made[1][1], "en", "web", 1), (None, None, None, None, None), (400, None, "en", "web", None),
        (401, "", "de", "web", 0), (402, " \n ", "en", "book", 3), (403, "x " * 9_000, "en", "web", 18_000),
        (None, "no id at all", "en", "web", 3), (None, "no id at all", "en", "web", 3),
        (404, "shared id, first text of it", "en", "web", 2), (404, "quite another text of this id", "de", None, 2),
        (None, "you vile rotten scum!! " * 9, "en", "web", 9), (405, "you vile rotten scum!! " * 8, "en", "web", 9),
        (405, "a clean text that has the id of a toxic one", "en", "web", 9),
    ]
    return made + odd + made[5:8]  # rows sent twice


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 6 == 0)) for i in range(240) if i % 2 == 0 or i % 3 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def tuples(df):
    return Counter(tuple(r) for r in df.collect())


def test_toxic_rows_go_whatever_their_id(spark, rows, folder):
    docs = spark.createDataFrame(rows, DOCS)
    scores = score_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet"), carry={"text": docs.text})
    toxic = {(r.doc_id, r.text) for r in scores.collect() if r.predicted}
    kept = tuples(pipeline.drop_toxic(spark, docs, folder))
    assert kept == Counter(r for r in rows if (r[0], r[1]) not in toxic)
    texts = {(i, t) for i, t, *_ in kept}
    assert not any(t and "vile rotten scum" in t for _, t in texts)
    assert (405, "a clean text that has the id of a toxic one") in texts
    assert sum(kept.values()) >= 0.75 * len(rows)


def brute_exact(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[hashlib.sha256(_lower(row[1]).encode()).hexdigest()].append(row)
    kept = Counter()
    for group in groups.values():
        top = max((r for r in group), key=lambda r: (r[0] is not None, r[0] or 0))[0]
        kept[max((r for r in group if r[0] == top), key=lambda r: [(v is not None, v or "") for v in r[1:3]])[0:1]] += 1
    return kept


def test_one_row_of_equal_texts_stays(spark, rows, folder):
    kept = tuples(pipeline.drop_exact_copies(spark, spark.createDataFrame(rows, DOCS), folder))
    assert Counter((r[0],) for r in kept.elements()) == brute_exact(rows)
    assert len({_lower(r[1]) for r in kept}) == sum(kept.values()) and not kept - Counter(rows)


def test_one_text_of_near_copies_stays(spark, rows, folder):
    kept = tuples(pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS), folder))
    expected = brute_components([(r[0], r[1]) for r in rows if r[0] is not None], 5, 80)
    assert kept == Counter(r for r in rows if r[0] is None or expected[r[0]] == r[0])


def test_rows_not_drawn_go(spark, rows, folder):
    docs = spark.createDataFrame(rows, DOCS)
    drawn = {(r.doc_id, r.source, r.lang, r.topic): r.kept for r in mix(docs).collect()}
    by_cell = defaultdict(set)
    for (i, source, lang, _), keep in drawn.items():
        by_cell[i, source, lang].add(keep)
    kept = tuples(pipeline.sample_mix(spark, docs, folder))
    assert not kept - Counter(rows)
    for row in set(rows):
        choices = by_cell[row[0], row[3] or "(null)", row[2] or "(null)"]
        if len(choices) == 1:
            assert kept[row] == (Counter(rows)[row] if True in choices else 0)


def test_all_rows_are_packed(spark, rows, folder):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = pipeline.pack_sequences(spark, spark.createDataFrame(rows, DOCS), folder).collect()
    lengths = Counter(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(r.length for r in packed) == sum(n * k for n, k in lengths.items())
    by_sequence = defaultdict(list)
    for r in packed:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_tables_pass_through(spark, folder):
    none = spark.createDataFrame([], DOCS)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_the_stages_follow_each_other(spark, rows, folder):
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in pipeline.STAGES:
        before = docs
        made = stage(spark, docs, folder)
        docs = spark.createDataFrame(made.collect(), made.schema)
        if name != "pack":
            assert docs.columns == before.columns
            assert not tuples(docs) - tuples(before)
    found = {tuple(r[c] for c in ("doc_id", "piece", "length")) for r in pipeline.run(spark, folder).collect()}
    assert found == {tuple(r[c] for c in ("doc_id", "piece", "length")) for r in docs.collect()}
