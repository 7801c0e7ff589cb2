"""The training-data operators against brute force, on small and awkward tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from driftline.llm import chat_format as chat
from driftline.llm import extraction, mixing, near_dedup, packing, token_count, topk, toxicity
from driftline.llm.bits import without
from driftline.llm.common import Stages
from driftline.llm.components import components
from driftline.llm.exact_dedup import exact_groups
from driftline.llm.url_filter import BLOCKED_HOSTS, judge_urls

#: Extra columns have names that operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept int, id string, sha int"


@pytest.fixture(scope="module")
def odd_docs(spark):
    long_text = " ".join(f"w{i % 977}x" for i in range(9_000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta"), (2, "ALPHA beta gamma delta epsilon zeta"),
        (2, "ALPHA beta gamma delta epsilon zeta"), (3, None), (4, ""), (5, " \n\t "),
        (6, "one"), (7, "ONE"), (8, "É é"), (9, long_text), (10, long_text + " end"),
        (11, "a <|endoftext|> b  c\u3000d"), (None, "one"), (12, "x " * 3_000), (13, "é É"),
    ]
    filled = [(i, t, None if i == 4 else "en", None if i == 6 else "s", 1, 0, "x", 9) for i, t in rows]
    return spark.createDataFrame(filled, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def _lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_exact_groups(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    groups = defaultdict(list)
    for i, text in rows:
        groups[hashlib.sha256(_lower(text).encode()).hexdigest()].append(i)
    expected = sorted(
        (str(i), max((j for j in ids if j is not None), default=None), len(ids), sha)
        for sha, ids in groups.items() for i in ids
    )
    found = exact_groups(odd_docs).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)
    assert exact_groups(no_docs).count() == 0


def _shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(spark, odd_docs, no_docs, width):
    rng = random.Random(width)
    base = [[f"v{rng.randrange(10**6)}" for _ in range(60)] for _ in range(6)]
    texts = []
    for number in range(90):
        words = list(base[number % 6])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(60)] = "edit" + str(rng.randrange(1000))
        texts.append(" ".join(words))
    rows = [(100 + i, t, None, None, 0, 0, None, 0) for i, t in enumerate(texts)]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, DOCS))
    known = {}
    for r in docs.filter("doc_id IS NOT NULL").collect():
        known[r.doc_id] = _shingles(r.text, width)
    parent = {i: i for i in known}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in known:
        for b in known:
            both = len(known[a] & known[b])
            if a < b and both and 100 * both >= 80 * len(known[a] | known[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    found = near_dedup.near_duplicates(docs, width).collect()
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(known[r.doc_id]), root(r.doc_id))
            assert r.kept == (r.doc_id == r.component_id)
    assert near_dedup.near_duplicates(no_docs, width).count() == 0


def test_estimates_are_freed_of_chance(spark):
    rng = np.random.default_rng(1)
    one = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
    for shared in (0, 500, 1000):
        two = np.concatenate([one[:shared], rng.integers(0, 2**63, 1000 - shared).astype(np.uint64)])
        df = spark.createDataFrame(
            [(near_dedup.sketch(one)[0].tolist(), near_dedup.sketch(two)[0].tolist())],
            "x array<bigint>, y array<bigint>",
        )
        found = df.select(near_dedup.estimate("x", "y")).first()[0]
        assert abs(found - shared / (2000 - shared)) < near_dedup.MARGIN


@pytest.mark.parametrize("common, left, right", [(4, 1, 0), (8, 2, 0), (8, 1, 1)])
def test_short_texts_at_the_bound_are_linked(spark, common, left, right):
    rows, pairs = [], 300
    for i in range(pairs):  # words of the common text, then words that only one text has
        words = [f"p{i}w{k}" for k in range(common + 4)]
        for j, extra in enumerate((left, right)):
            text = words + [f"p{i}t{j}x{k}" for k in range(extra)]
            rows.append((2 * i + j, " ".join(text)))
    texts = dict(rows)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    components = {r.doc_id: r.component_id for r in found.collect()}
    for i in range(pairs):
        one, two = (_shingles(texts[2 * i + j], 5) for j in (0, 1))
        assert 100 * len(one & two) == 80 * len(one | two)
        assert components[2 * i + 1] == 2 * i


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, j) for j in range(101, 160)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.id: r.component for r in components(Stages(spark), df).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {j: 100 for j in range(100, 160)}
    assert components(Stages(spark), df.limit(0)).count() == 0


def test_without_keeps_nulls_and_extra_columns(spark, odd_docs):
    gone = spark.createDataFrame([(2,), (9,), (None,)], "doc_id long")
    left = without(Stages(spark), odd_docs, gone, ["doc_id"])
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(r.doc_id) for r in odd_docs.collect() if r.doc_id not in (2, 9)
    )


def test_top_k(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.5, 0.0, 0.0, 0.25, 1e-4, 2.0]) for _ in range(6)]) for i in range(60)]
    rows += [(60, None), (70, [1.0, None]), (80, [float("nan")]), (90, [float("inf")]), (None, [1.0])]
    rows += [(100, []), (61, rows[0][1]), (61, rows[0][1]), (62, [0.5])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    fit = [
        (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    expected = set()
    for q, v in {i: v for i, v in fit if i % 10 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fit if i != q)[:5]
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    found = topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 9)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    test_top_k(spark)


MODEL = P.path("piece_bpe_32k.model")


def test_token_counts(odd_docs, no_docs):
    pieces = token_count.pieces_of(MODEL)
    found = token_count.count_tokens(odd_docs, MODEL, 100).collect()
    expected = []
    for r in odd_docs.collect():
        n = len(pieces.encode(r.text or ""))
        expected.append((str(r.doc_id), len((r.text or "").encode()), n, n > 100))
    assert sorted((str(r.doc_id), *r[1:]) for r in found) == sorted(expected)
    assert token_count.count_tokens(no_docs, MODEL).count() == 0


def test_word_sums_equal_whole_texts():
    words = token_count.WordLengths(MODEL, {})
    rng = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "①", "▁", "<s>", "</s>", "\r", ");", "\u3000", "😀", "\x00"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert words.count(text) == len(words.pieces.encode(text)), repr(text)


def test_ranks_and_tokenizer_agree():
    coder = packing.TokenBytes(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(6)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "'s", "12", "<|endoftext|>", "\r", "\u3000", "😀", "\x85"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert coder.encode(text) == np.asarray(coder._ids(text), "<u4").tobytes(), repr(text)


def test_packing_is_exact_and_tight(odd_docs, no_docs):
    ranks, capacity = P.path("byte_bpe_50k.tiktoken"), 64
    packed = packing.pack(odd_docs, P.path("byte_bpe_50k.json"), ranks, capacity).collect()
    coder = packing.TokenBytes(P.path("byte_bpe_50k.json"), None)
    texts = sorted((str(r.doc_id), coder.encode(r.text or "") + bytes(4)) for r in odd_docs.collect())
    pieces, rebuilt = defaultdict(list), []
    for r in packed:
        pieces[r.doc_id].append(r)
    for doc, rows in pieces.items():
        # repeated rows have the same pieces twice
        for n in range(sum(r.piece == 0 for r in rows)):
            mine = sorted(rows, key=lambda r: (r.piece, r.sequence_id, r.offset))
            parts = [[r for r in mine if r.piece == k][n] for k in range(max(r.piece for r in rows) + 1)]
            assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
            assert all(p.length == capacity for p in parts[1:])
            rebuilt.append((str(doc), b"".join(bytes(p.ids) for p in parts)))
    assert sorted(rebuilt) == texts
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    least = -(-sum(r.length for r in packed) // capacity)
    assert len(sequences) <= least + 1
    assert packing.pack(no_docs, P.path("byte_bpe_50k.json"), ranks, capacity).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_configurations_hold_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 100): rng.randint(1, 60) for _ in range(rng.randint(1, 40))}
    packed = packing.rounded_configurations(counts, 100, packing.fractional_configurations(counts, 100))
    held = defaultdict(int)
    for config, times in packed.items():
        assert sum(n * k for n, k in config) <= 100
        for n, k in config:
            held[n] += k * times
    assert held == counts


def test_common_positions_is_a_longest_common_subsequence():
    rng = random.Random(7)
    for _ in range(400):
        one = [rng.randrange(5) for _ in range(rng.randint(0, 9))]
        two = [rng.randrange(5) for _ in range(rng.randint(0, 9))]
        best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
        for i in range(len(one)):
            for j in range(len(two)):
                best[i + 1][j + 1] = (
                    best[i][j] + 1 if one[i] == two[j] else max(best[i][j + 1], best[i + 1][j])
                )
        found = extraction.common_positions(one, two)
        assert len(found) == best[-1][-1] and found == sorted(set(found))
        rest = iter(two)
        assert all(one[i] in rest for i in found)


def test_extraction(spark):
    def page(body):
        return f"<html><head><title>t</title><script>'</p>'</script></head><body>{body}</body></html>"

    menu = "<nav><ul><li>Home<li>About</ul></nav>"
    article = "<article><h1>T &amp; U</h1><p><b>One\n two.<br><p>Three&nbsp;x<div class='ad'>Buy</div></article>"
    plain = lambda own: menu + f"<div>Shared line</div><div>{own}</div><div>Bottom line</div>"
    rows = [
        (1, "http://a.com/x/1", page(menu + article + "<footer>f</footer>")),
        (2, "http://b.com/x/1", page(plain("first"))), (3, "http://B.com/x/2", page(plain("second"))),
        (4, "http://b.com/x/2", page(plain("second"))), (5, "http://c.com/", page(plain("alone"))),
        (6, None, None), (7, "x", ""), (8, None, "just text < 3"), (8, None, "just text < 3"),
        (9, "http://d.com/", "<p>cut<div"), (None, "http://d.com/a", page("<main>" + "<p>y" * 3000)),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    found = defaultdict(list)
    for r in extraction.extract_text(df).collect():
        found[r.page_id].append(r.text)
    assert found[1] == ["T & U\nOne two.\nThree x"]
    assert (found[2], found[3], found[4]) == (["first"], ["second"], ["second"])
    assert found[5] == ["Shared line\nalone\nBottom line"]
    assert found[6] == [""] and found[7] == [""] and found[8] == ["just text < 3"] * 2
    assert found[None] == ["\n".join(["y"] * 3000)]
    assert found[9][0].startswith("cut")
    assert extraction.extract_text(df.limit(0)).count() == 0


def test_url_rules(spark):
    rules = [("allow", "com", "/"), ("block", "x.com", "/en/"), ("allow", "w.x.com", "/en/"), ("block", "net", "/es/")]
    urls = [
        "http://x.com/en/1", "https://w.x.com/en/?q", "HTTP://A.W.X.COM/en/", "http://x.com", "http://x.com/EN/",
        "http://a.net/es/#f", "http://net/es/", "http://a.net/es", "http://spam-farm.example.org/a",
        "http://xspam-farm.example.org/a", "none", "", None, "://", "a://b://c/d", "http://a.net/es/1\n2",
    ] + [f"http://h{i}.org/p{i}" for i in range(3000)]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for r in judge_urls(df, rules, BLOCKED_HOSTS).collect():
        url = urls[r.page_id]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = _lower(host)
        inside = lambda h: host == h or host.endswith("." + h)
        fits = [(len(h + p), h + p, v) for v, h, p in rules if inside(h) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "block" if any(map(inside, BLOCKED_HOSTS)) else "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), url
    assert judge_urls(df.limit(0), rules, []).count() == 0


def test_mixing_meets_its_margins(spark, odd_docs, no_docs):
    rng = random.Random(8)
    rows = [
        (i, "w " * rng.randint(1, 30), rng.choice("ab"), rng.choice("pqq"), 0, 0, None, 0) for i in range(400)
    ]
    found = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    total = sum(r.n_tokens for r in found)
    assert abs(sum(r.n_tokens * r.probability for r in found) / total - mixing.KEEP_SHARE) < 0.01
    held, seen = defaultdict(float), defaultdict(int)
    for r in found:
        held[r.source] += r.n_tokens * r.weight / total
        seen[r.source] += r.n_tokens
    powers = {s: (n / total) ** mixing.TARGET_POWERS["source"] for s, n in seen.items()}
    for source, power in powers.items():
        assert abs(held[source] - power / sum(powers.values())) < 1e-3
    assert {r.source for r in mixing.mix(odd_docs).collect()} == {"s", "(null)"}
    assert mixing.mix(odd_docs).count() == odd_docs.count() and mixing.mix(no_docs).count() == 0


def test_toxicity_on_held_out_rows(spark, no_docs):
    rng = random.Random(9)
    bad, rows, labels = ["awfulone", "nastytwo", "grimthree"], [], []
    for i in range(900):
        words = [f"calm{rng.randrange(300)}" for _ in range(40)]
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            words[rng.randrange(40)] = rng.choice(bad) + rng.choice(["", "!", "er"])
        rows.append((i, " ".join(words), None, None, 0, 0, None, 0))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows + [(5000, None, None, None, 0, 0, None, 0)], DOCS)
    table = spark.createDataFrame([*labels, (7, None), (None, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, table).collect()}
    for i, toxic in labels:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= found[i].score <= 1 and found[i].predicted == int(found[i].score >= 0.5)
    held = [(found[i].predicted, y) for i, y in labels if found[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert found[5000].predicted == 0
    assert toxicity.score_toxicity(no_docs, table).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, table.limit(0)).collect()} == {0.0}


def test_template_round_trips():
    rng = random.Random(10)
    parts = [*chat.CONTROL, "\\", "\n", "<", "|", ">", "a", "<|", "[", "]", "turn", "é", ""]
    for _ in range(3_000):
        turns = [("".join(rng.choices(parts, k=3)), "".join(rng.choices(parts, k=6))) for _ in range(3)]
        made = [chat.format_turn(*t) for t in turns]
        assert chat.read_turns("".join(m[0] for m in made)) == turns
        for (role, text), (formatted, start, end) in zip(turns, made):
            assert chat.unescape(formatted[start:end]) == text
            assert not any(c in formatted[start:end] for c in chat.CONTROL)


def test_layouts_become_the_same_turns(spark):
    said = [
        '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"value": "a", "from": "gpt"}]}',
        '{"response": "a", "prompt": "q"}', '{"prompt": "q", "completion": "a"}',
        '{"instruction": "q", "output": "a"}',
    ]
    rows = [(i, 0, r, "x") for i, r in enumerate(said)] + [
        (9, 1, '{"role": "assistant", "text": "a"}', "x"), (9, None, '{"role": "user", "text": "q"}', "x"),
        (20, 0, None, "x"), (21, 0, "no json", "x"), (22, 0, '{"other": 1}', "x"), (23, 0, "[1]", "x"),
        (24, 0, '{"role": null, "text": null}', "x"), (None, 0, said[2], "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, record string, formatted string")
    found = {r.conv_id: r for r in chat.chat_digests(chat.format_chats(df)).collect()}
    assert set(found) == {*range(5), 9, 24, None}
    turns = hashlib.sha256(b"user\nq\nassistant\na\n").hexdigest()
    for key in [*range(5), 9, None]:
        assert (found[key].n_turns, found[key].turns_sha256, found[key].loss_chars) == (2, turns, 1)
        assert found[key].loss_sha256 == hashlib.sha256(b"a").hexdigest()
    assert found[24].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert chat.format_chats(df.limit(0)).count() == 0
