"""Pages and records that once stopped a task."""

import time

import pytest

from driftline.llm import chat_format as chat
from driftline.llm.extraction import page_lines

KNOWN = chat.by_fingerprint(chat.MAPPINGS)


@pytest.mark.parametrize(
    "part, number, end",
    [("<a ", 330_000, ""), ("<div>", 100_000, "</b>" * 100_000), ('<a "', 250_000, ">"), ("<!", 500_000, ""),
     ("<script>", 120_000, ""), ("<", 1_000_000, ""), ('<a"', 300_000, "'>")],
)
def test_a_page_of_a_megabyte_is_read_at_once(part, number, end):
    start = time.perf_counter()
    page_lines(part * number + end)
    assert time.perf_counter() - start < 10  # minutes to hours before


def test_tags_end_where_they_should():
    lines = page_lines("<p>a <b title='x > y'>bold</b> c</p><nav>menu</nav><p>1 < 2</p></i></p><p>end")
    assert [text for text, _ in lines] == ["a bold c", "menu", "1 < 2", "end"]


def test_records_that_are_no_chats_give_a_reason():
    cases = {
        '{"messages[].content": "x", "messages[].role": "y"}': chat.NO_MAPPING,
        '{"messages": [], "role.x": 1}': chat.NO_MAPPING,
        "[" * 100_000: chat.NO_JSON,
        '{"a":' * 100_000: chat.NO_JSON,
        "{": chat.NO_JSON, "": chat.NO_JSON, "3": chat.NO_OBJECT, "[1]": chat.NO_OBJECT, None: chat.NULL_RECORD,
        '{"\\ud800": 1}': chat.NO_MAPPING,
    }
    for record, reason in cases.items():
        assert chat.read_record(record, KNOWN) == ([], reason)
    assert chat.read_record('{"role": "user", "text": "a\\ud800b"}', KNOWN) == ([("user", "a�b")], None)


def test_rejected_records_come_back(spark):
    records = [
        (1, 0, '{"role": "user", "text": "hi"}', "x"), (1, 1, '{"who": "user", "text": "hi"}', "x"),
        (None, 2, None, "x"), (2, None, "no json", "x"), (3, 0, '{"prompt": "p\\ud800", "response": null}', "x"),
    ]
    df = spark.createDataFrame(records, "conv_id long, turn long, record string, reason string")
    found = {tuple(r) for r in chat.rejected_records(df).collect()}
    assert found == {
        (1, 1, '{"who": "user", "text": "hi"}', chat.NO_MAPPING), (None, 2, None, chat.NULL_RECORD),
        (2, None, "no json", chat.NO_JSON),
    }
    shuffled = chat.format_chats(df).repartition(7, "formatted")
    digests = {r.conv_id: r.n_turns for r in chat.chat_digests(shuffled).collect()}
    assert digests == {1: 1, 3: 2}
    assert chat.rejected_records(df.limit(0)).count() == 0


def test_layouts_of_one_conversation_may_differ(spark):
    records = [
        '{"role": "system", "content": "s"}', '{"messages": [{"role": "user", "content": "u"}]}',
        '{"conversations": [{"from": "gpt", "value": "a"}, {"from": "human", "value": "v"}]}',
        '{"text": "b", "role": "assistant"}',
    ]
    df = spark.createDataFrame([(1, i, r) for i, r in enumerate(records)], "conv_id long, turn long, record string")
    text = "".join(r.formatted for r in chat.format_chats(df).orderBy("position").collect())
    assert chat.read_turns(text) == [
        ("system", "s"), ("user", "u"), ("assistant", "a"), ("user", "v"), ("assistant", "b")]
