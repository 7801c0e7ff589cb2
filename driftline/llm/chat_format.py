"""Chat formatting: schema fingerprints pick the mapping of a record, a template marks its turns."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, slices

ship(__name__)

# -- layouts --------------------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    """How records of one layout become turns.

    ``paths`` are the nested field paths that the layout may have, ``[]`` standing for the items
    of a list. ``turns`` are (role, path) in order: the role is a word, or ``@`` and the path of
    a field holding it. Where ``items`` names a list, the paths of ``turns`` are inside its items.
    """

    name: str
    paths: tuple[tuple[str, ...], ...]
    turns: tuple[tuple[str, str], ...]
    items: str | None = None


#: Names of roles in the layout that says ``from``.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

MAPPINGS = (
    Mapping("turn", (("role", "text"),), (("@role", "text"),)),
    Mapping("turn-content", (("role", "content"),), (("@role", "content"),)),
    Mapping(
        "prompt",
        (("prompt", "response"), ("prompt", "response", "system")),
        (("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
    Mapping(
        "completion", (("completion", "prompt"),), (("user", "prompt"), ("assistant", "completion"))
    ),
    Mapping(
        "instruction",
        (("instruction", "output"), ("input", "instruction", "output")),
        (("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Mapping(
        "messages",
        (("messages[].content", "messages[].role"),),
        (("@role", "content"),),
        "messages",
    ),
    Mapping(
        "conversations",
        (("conversations[].from", "conversations[].value"),),
        (("@from", "value"),),
        "conversations",
    ),
)


def path_name(key: str) -> str:
    """A key as it stands in a path: signs that paths use themselves are escaped."""
    return re.sub(r"[\\.\[\]\n]", lambda sign: "\\" + sign[0], key)


def field_paths(value) -> set[str]:
    """Paths of all fields that hold no object or list; nulls count, empty lists have none."""
    found, left = set(), [("", value)]
    while left:
        prefix, inner = left.pop()
        if isinstance(inner, dict):
            dot = f"{prefix}." if prefix else ""
            left += [(dot + path_name(k), v) for k, v in inner.items()]
        elif isinstance(inner, list):
            left += [(f"{prefix}[]", v) for v in inner]
        else:
            found.add(prefix)
    return found


def fingerprint(paths) -> str:
    """Hash of a set of field paths: equal for records of equal layout, in any field order."""
    return hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def by_fingerprint(mappings) -> dict[str, Mapping]:
    return {fingerprint(paths): m for m in mappings for paths in m.paths}


def _text(value) -> str:
    """A value as text; half of a surrogate pair, which no text can hold, becomes U+FFFD."""
    if value is None:
        return ""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    try:
        text.encode()
    except UnicodeEncodeError:
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


#: Why a record gives no turns.
NULL_RECORD, NO_JSON, NO_OBJECT, NO_MAPPING = "null", "no JSON", "no object", "unknown layout"


def read_record(
    record: str | None, known: dict[str, Mapping]
) -> tuple[list[tuple[str, str]], str | None]:
    """(turns, None) of one JSON record, or no turns and the reason.

    Null texts are empty; optional fields that the record lacks give no turn. A record nested
    deeper than the parser goes counts as no JSON.
    """
    if record is None:
        return [], NULL_RECORD
    try:
        value = json.loads(record)
    except (ValueError, RecursionError):
        return [], NO_JSON
    if not isinstance(value, dict):
        return [], NO_OBJECT
    mapping = known.get(fingerprint(field_paths(value)))
    if mapping is None:
        return [], NO_MAPPING
    turns = []
    for item in value[mapping.items] if mapping.items else [value]:
        for role, path in mapping.turns:
            if path not in item:
                continue
            name = _text(item.get(role[1:])) if role[0] == "@" else role
            name = ROLE_NAMES.get(name, name) if role == "@from" else name
            turns.append((name, _text(item[path])))
    return turns, None


def canonical_turns(record: str | None, known: dict[str, Mapping]) -> list[tuple[str, str]]:
    """(role, text) of one JSON record; none where ``read_record`` gives a reason."""
    return read_record(record, known)[0]


# -- template -------------------------------------------------------------------------

OPEN, CLOSE = "<|turn|>", "<|end|>"
#: Strings that steer models; inside texts a backslash after the first sign breaks them.
CONTROL = [OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>"]
ESCAPE = "\\"
_CONTROLS = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    doubled = text.replace(ESCAPE, ESCAPE * 2)
    return _CONTROLS.sub(lambda found: found[0][0] + ESCAPE + found[0][1:], doubled)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda found: found[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where in it the text begins and ends."""
    head = f"{OPEN}{escape(role).replace(chr(10), ESCAPE + chr(10))}\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) back from a formatted conversation."""
    turns = []
    for part in formatted.split(OPEN)[1:]:
        body = part[: part.rindex(CLOSE)]
        at = re.search(r"(?<!\\)(?:\\\\)*\n", body).end() - 1
        turns.append((unescape(body[:at]), unescape(body[at + 1 :])))
    return turns


# -- tables ---------------------------------------------------------------------------


def format_chats(
    records: DataFrame,
    mappings: tuple[Mapping, ...] = MAPPINGS,
    id_col: str = "conv_id",
    order_col: str = "turn",
    record_col: str = "record",
    trained_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """Rows (id, position, formatted, loss_start, loss_end): a conversation's turns in order.

    A record is JSON of any layout with a mapping: a whole conversation or some turns of it; the
    mapping is picked by the fingerprint of its field paths. Records of an id follow each other
    by ``order_col``, ties by the record's text. The conversation's text is its rows'
    ``formatted`` in order of position; loss_start and loss_end bound, inside the row, what is
    trained on (null: nothing). Rows of an id come together and in order, one task streaming
    through them, so a conversation of any number of turns is never held whole.

    Null records, records that are no JSON and those of unknown layout give no turns
    (``rejected_records`` has them with the reason); repeated records give each their turns; null ids are one conversation, a null order comes first. An
    empty table gives no rows. Other columns are not read.
    """
    rows = records.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{order_col}`").alias("place"),
        F.col(f"`{record_col}`").alias("record"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    known = by_fingerprint(mappings)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position = object(), 0
        for batch in slices(batches):
            out: list[tuple] = []
            for name, record in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if name != current:
                    current, position = name, 0
                for role, text in canonical_turns(record, known):
                    turn, start, end = format_turn(role, text)
                    trained = role in trained_roles
                    span = (start, end) if trained else (None, None)
                    out.append((name, position, turn, *span))
                    position += 1
            columns = list(zip(*out)) or [()] * 5
            kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["id", "position", "formatted", "loss_start", "loss_end"],
            )

    return (
        rows.repartition("id")
        .sortWithinPartitions("id", "place", "record")
        .mapInArrow(
            formatted,
            f"id {kind}, position long, formatted string, loss_start long, loss_end long",
        )
        .withColumnRenamed("id", id_col)
    )


def rejected_records(
    records: DataFrame,
    mappings: tuple[Mapping, ...] = MAPPINGS,
    id_col: str = "conv_id",
    order_col: str = "turn",
    record_col: str = "record",
) -> DataFrame:
    """Rows (id, order, record, reason) of the records that give no turns, as they were sent."""
    rows = records.select(f"`{id_col}`", f"`{order_col}`", F.col(f"`{record_col}`").alias(record_col))
    known = by_fingerprint(mappings)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            reasons = pa.array([read_record(r, known)[1] for r in batch.column(2).to_pylist()], pa.string())
            whole = pa.RecordBatch.from_arrays(
                [*batch.columns, reasons], names=[*batch.schema.names, "reason"]
            )
            yield whole.filter(reasons.is_valid())

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(judged, f"{kinds}, reason string")


def chat_digests(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Read formatted conversations back, one row each: id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.

    The rows of ``format_chats`` may come in any order; they are brought together by id and read
    by position. A null id is a conversation. An empty table gives no rows.
    """
    kind = chats.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        current, state = object(), None
        for batch in slices(batches):
            kinds[0] = batch.schema.field(0).type
            done = []
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4)]
            for name, text, start, end in zip(*columns):
                if state is None or name != current:
                    if state is not None:
                        done.append(summary(current, state))
                    current, state = name, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(text)
                for role, said in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if start is not None:
                    trained = unescape(text[start:end])
                    state[2] += len(trained)
                    state[3].update(trained.encode())
            yield table(done, names, kinds)
        if state is not None:
            yield table([summary(current, state)], names, kinds)

    def summary(name, state) -> tuple:
        turns, turn_hash, chars, loss_hash, formatted = state
        return (name, turns, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), formatted)

    def table(rows, names, kinds) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=names
        )

    rows = chats.select(id_col, "position", "formatted", "loss_start", "loss_end")
    ordered = rows.repartition(id_col).sortWithinPartitions(id_col, "position")
    return ordered.mapInArrow(
        read,
        f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    ).withColumnRenamed("id", id_col)
