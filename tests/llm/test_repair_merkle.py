"""Conversation repair and the Merkle manifest against plain recursions, on awkward tables."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from driftline.llm import merkle, repair
from driftline.llm.queries import damaged

BLANK = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string, kind int, code string, digest string"
NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def faults_of(rows):
    seen, found = set(), []
    for _, role, text in rows:
        stripped = text.rstrip(BLANK)
        if not stripped:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif stripped[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, edits, repaired turns), all edits tried; a string compares by cost, then ASCII."""
    faults = faults_of(rows)

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserts < 2:
            cost, edits, turns = best(i, NEXT[state][0], inserts + 1)
            options.append((cost + 5, "I" + edits, ((NEXT[state], ""), *turns)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, edits, turns = best(i + 1, state, 0)
            options.append((cost + 2, "D" + edits, turns))
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                first = role[:1]
                if (first == "s" and state == "") or first == NEXT[state][0]:
                    cost, edits, turns = best(i + 1, first, 0)
                    options.append((cost + more, "K" + edits, ((role, text), *turns)))
                cost, edits, turns = best(i + 1, NEXT[state][0], 0)
                options.append((cost + more + 1, "R" + edits, ((NEXT[state], text), *turns)))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def brute_repair(rows):
    """rows (conv_id, turn, role, text) -> reports by conversation."""
    groups, reports = {}, {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        groups.setdefault(conv, []).append((turn, role, text))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for conv, lines in groups.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[2])))
        faults, cost_edits = faults_of(lines), cheapest(tuple(lines))
        numbers = [t for t, _, _ in lines if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(
            a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:])
        )
        cost, edits, turns = cost_edits
        reports[conv] = (
            gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            illegal, cost, edits, digest("\n".join(f"{r}:{t}" for r, t in turns)), turns,
        )
    return reports


def check_repair(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TURNS)
    expected = brute_repair(rows)
    found = {r.conv_id: tuple(r)[1:] for r in repair.repair_conversations(frame).collect()}
    assert found == {conv: report[:-1] for conv, report in expected.items()}
    turns = {}
    for r in repair.repair_conversations(frame, turns=True).orderBy("place").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {c: list(report[-1]) for c, report in expected.items() if report[-1]}


def random_rows(rng, conversations, longest):
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", None, "Yes.", "É.", "end. "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Ugh"]
    return [
        (conv, rng.choice([turn, turn, turn, turn // 2, None]), rng.choice(roles), f"{rng.choice(texts) or ''}"
         if rng.random() < 0.7 else rng.choice(texts))
        for conv in range(conversations) for turn in range(rng.randrange(longest))
    ]


def test_repair_of_random_conversations(spark):
    check_repair(spark, random_rows(random.Random(1), 150, 9))


@pytest.mark.parametrize("segment", [1, 7])
def test_repair_across_segments(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    rows = random_rows(random.Random(segment), 30, 40) + [(None, 1, "user", "Hi."), (None, 2, None, None)]
    check_repair(spark, rows * 2)  # every row sent twice


def test_repair_of_a_hot_conversation_with_long_texts(spark):
    rng = random.Random(4)
    roles = ["user", "assistant"]
    rows = [(7, t, roles[(t + (rng.random() < 0.1)) % 2], f"Turn {t}{'.' if rng.random() < 0.9 else ''}") for t in range(2_500)]
    rows += [(7, 2_500, "user", "long " * 60_000 + "."), (8, 0, "user", "Once.")] + [(9, 5, "user", "Same.")] * 300
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TURNS)
    found = {r.conv_id: r for r in repair.repair_conversations(frame).collect()}
    assert found[9].duplicate == 299 and found[9].illegal == 299 and found[9].audit == "D" * 300
    assert found[8].audit == "D" and found[7].gaps == 0
    state, cost = {"": 0}, 0  # least cost forward, without the edits
    for (_, _, role, _), fault in zip(rows[:2_501], faults_of([r[1:] for r in rows[:2_501]])):
        for k in ("u", "a", "u"):
            before = {"u": ("", "a"), "a": ("u",)}[k]
            state[k] = min([state.get(k, 10**9)] + [state[b] + 5 for b in before if b in state])
        new = {k: c + 2 for k, c in state.items()}
        for k, c in state.items():
            then, more = NEXT[k][0], 5 if fault else 0
            new[then] = min(new.get(then, 10**9), c + more + (role[0] != then))
        state = new
    cost = min(state[""], state["a"], state["u"] + 5)
    assert found[7].cost == cost


def test_conversations_without_rows_and_an_empty_table(spark):
    none = spark.createDataFrame([], TURNS)
    every = spark.createDataFrame([(1,), (None,)], "conv_id long")
    assert repair.repair_conversations(none).count() == 0
    found = repair.repair_conversations(none, every).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r) for r in found} == {(c, 0, 0, 0, 0, 0, 0, "", empty) for c in (1, None)}


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in (0, 1, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: "One Two"}.get(kind, text)
        expected += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(str, (tuple(r) for r in damaged(frame).collect()))) == sorted(map(str, expected))


# -- manifest -------------------------------------------------------------

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, id int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(leaves):
    """(root, siblings of every leaf, root from a changed leaf), one level after the other."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])

    def path(i, value):
        others = ""
        for level in levels[:-1]:
            sibling = level[i ^ 1] if i ^ 1 < len(level) else ""
            value = sha(value + sibling if i % 2 == 0 else sibling + value)
            others, i = others + sibling, i // 2
        return value, others

    return levels[-1][0], path


def brute_manifest(rows):
    tampered = lambda r: (*r[:3], r[3] + 1, r[4])
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = brute_tree([leaf_of(r) for r in groups[lang]])
    root, above = brute_tree([trees[lang][0] for lang in langs])
    found = []
    for k, lang in enumerate(langs):
        subroot, path = trees[lang]
        _, upper = above(k, subroot)
        for i, row in enumerate(groups[lang]):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            start, lower = path(i, leaf_of(tampered(row) if bad else row))
            folded, _ = above(k, start)
            found.append(
                (row[0], leaf_of(row), subroot, root, sha(lower + upper), folded, folded == root)
            )
    return found


def check_manifest(spark, rows):
    frame = spark.createDataFrame([(*r, "t", 3, 4) for r in rows], DOCS)
    found = merkle.merkle_manifest(
        frame,
        tampered={"n_chars": F.col("n_chars") + 1},
        where=F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
    )
    got = [tuple(r) for r in found.drop("proof").collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_manifest(rows)))


def some_rows(rng, number, langs):
    return [
        (i, rng.choice(["s", None]), rng.choice(langs), rng.choice([None, 3, 70]), rng.choice(["é x", "", None, f"t{i}"]))
        for i in rng.sample(range(10 * number), number)
    ]


@pytest.mark.parametrize("levels", [1, 12])
def test_manifest_in_blocks_of_any_size(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng = random.Random(levels)
    rows = some_rows(rng, 43, ["en", "de", None, "", "é", "z", "only"]) + [(10**6, "a", "lone", 1, "x")]
    check_manifest(spark, rows)


def test_manifest_of_repeated_rows_and_null_ids(spark):
    rows = some_rows(random.Random(9), 9, ["en"])
    check_manifest(spark, rows * 3 + [(None, None, None, None, None)] * 2 + [(None, "s", "en", 1, "x " * 50_000)])


def test_manifest_of_one_row_and_none(spark):
    check_manifest(spark, [(7, "a", "en", 2, "hi")])
    assert merkle.merkle_manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_untouched_rows_verify_and_proofs_fold(spark):
    frame = spark.createDataFrame([(*r, "t", 3, 4) for r in some_rows(random.Random(2), 20, ["a", "b"])], DOCS)
    for r in merkle.merkle_manifest(frame).collect():
        assert r.verified and merkle.fold(r.leaf, r.proof) == r.root
        assert merkle.fold(sha("other"), r.proof) != r.root
