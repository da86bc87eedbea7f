"""Chat formatting: layouts found by fingerprint, canonical turns, a reversible template.

A record is JSON. Its schema fingerprint is the hash of its sorted nested field
paths; a table of declarative mappings, one for each known set of paths, says
where turns, roles and texts lie. What comes out is one row a turn, whatever
the layout was. The template writes a turn as one segment, so a conversation of
any length is never held as one text: its formatted text is its segments in
order, and its loss mask is spans of them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import batches

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = ("assistant",)

# Roles under the names that layouts give them; fixed values.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Mapping:
    """Where the turns of one layout lie.

    ``turns`` names a list of turns with their ``role`` and ``text`` fields
    (``text`` may be a list of parts, joined). Without it, ``fields`` gives
    (role, path, also) for turns made of the record's own fields, where
    ``also`` is a field added after an empty line if it is not empty; or
    ``role`` and ``text`` name fields of a record that is itself one turn.
    """

    name: str
    paths: tuple[str, ...]
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str, str], ...] = ()
    order: str = ""


def _instruction(name: str, user: str, more: str, answer: str, system: str) -> Iterable[Mapping]:
    for has_more in (False, True) if more else (False,):
        for has_system in (False, True) if system else (False,):
            paths = [user, answer] + [more] * has_more + [system] * has_system
            fields = (("system", system, ""),) * has_system + (("user", user, more if has_more else ""), ("assistant", answer, ""))
            yield Mapping(f"{name}{'+input' * has_more}{'+system' * has_system}", tuple(paths), fields=fields)


def _messages(name: str, turns: str, role: str, text: str) -> Iterable[Mapping]:
    yield Mapping(name, (f"{turns}[].{role}", f"{turns}[].{text}"), turns, role, text)
    yield Mapping(f"{name} parts", (f"{turns}[].{role}", f"{turns}[].{text}[].text", f"{turns}[].{text}[].type"), turns, role, text)
    yield Mapping(f"{name} mixed", (f"{turns}[].{role}", f"{turns}[].{text}", f"{turns}[].{text}[].text", f"{turns}[].{text}[].type"), turns, role, text)


#: Every known layout. Field paths: names joined by dots, ``[]`` after a list.
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("turn row", ("role", "text", "turn"), role="role", text="text", order="turn"),
    *_messages("messages", "messages", "role", "content"),
    *_messages("conversations", "conversations", "from", "value"),
    *_messages("conversation", "conversation", "role", "content"),
    *_messages("dialog", "dialog", "speaker", "text"),
    *_instruction("instruction output", "instruction", "input", "output", "system"),
    *_instruction("instruction response", "instruction", "context", "response", "system"),
    *_instruction("prompt completion", "prompt", "", "completion", "system"),
    *_instruction("prompt response", "prompt", "", "response", "system"),
    *_instruction("question answer", "question", "context", "answer", "system"),
    *_instruction("query response", "query", "", "response", "system"),
    *_instruction("input target", "inputs", "", "targets", ""),
)


def field_paths(value: object, ignored: frozenset[str] = frozenset(), at: str = "") -> set[str]:
    """Paths of all leaves; an empty list is a leaf of its own, so is a null."""
    if isinstance(value, dict):
        found = (field_paths(v, ignored, f"{at}.{k}" if at else k) for k, v in value.items() if at or k not in ignored)
        return set().union(*found)
    if isinstance(value, list):
        return set().union(*(field_paths(v, ignored, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


@cache
def mappings_by_fingerprint() -> dict[str, Mapping]:
    found = {fingerprint(m.paths): m for m in MAPPINGS}
    # A list of turns may be empty.
    found |= {fingerprint([f"{m.turns}[]"]): m for m in MAPPINGS if m.turns}
    # So may a list of parts, and a part may be a text itself: beside parts that
    # are records, beside texts, or alone.
    for m in MAPPINGS:
        if m.turns:
            bare = f"{m.turns}[].{m.text}[]"
            found.setdefault(fingerprint([*m.paths, bare]), m)
            found.setdefault(fingerprint([f"{m.turns}[].{m.role}", bare]), m)
    return found


@cache
def _read_names() -> frozenset[str]:
    """The names that some mapping reads: of fields, and of a turn's fields after their list's."""
    names = {m.turns for m in MAPPINGS} | {p.split("[]")[0] for m in MAPPINGS for p in m.paths}
    return frozenset(names | {f"{m.turns}[].{name}" for m in MAPPINGS if m.turns for name in (m.role, m.text)})


_PLAIN_FIELD = re.compile(r"([^\[\].]+)(?:\.[^\[\]]+)?(?:\[\])?")
_PLAIN_IN_TURN = re.compile(r"([^\[\].]+)\[\]\.([^\[\].]+)(?:\[\])?")


@lru_cache(4096)
def _passed_over(path: str) -> bool:
    """If a field of no mapping may stand beside the turns: a plain value or a
    list of them, of the record, of a record in it, or of a turn. Deeper values
    (tool calls, pictures, other turns) may be part of what is said."""
    if m := _PLAIN_FIELD.fullmatch(path):
        return m[1] not in _read_names()
    m = _PLAIN_IN_TURN.fullmatch(path)
    return bool(m) and m[1] in _read_names() and f"{m[1]}[].{m[2]}" not in _read_names()


def layout_of(record: dict) -> Mapping | None:
    """The mapping of a record's paths, whatever plain fields it has besides."""
    return mappings_by_fingerprint().get(fingerprint(p for p in field_paths(record) if not _passed_over(p)))


def _as_text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, list):
        return "".join(_as_text(part.get("text") if isinstance(part, dict) else part) for part in value)
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record: dict, mapping: Mapping) -> Iterator[tuple[int, str, str]]:
    """(number, role, text) of the record's turns."""
    if mapping.turns:
        turns = ((k, turn.get(mapping.role), turn.get(mapping.text)) for k, turn in enumerate(record.get(mapping.turns) or []))
    elif mapping.fields:
        turns = (
            (k, role, _as_text(record.get(path)) + (f"\n\n{_as_text(record[also])}" if also and record.get(also) else ""))
            for k, (role, path, also) in enumerate(mapping.fields)
        )
    else:
        turns = iter([(record.get(mapping.order), record.get(mapping.role), record.get(mapping.text))])
    for number, role, text in turns:
        role = _as_text(role)
        # A row that is itself a turn is canonical already: its role stays.
        yield number, role if mapping.order else ROLES.get(role, role), _as_text(text)


_TURNS = "id {id}, number long, role string, text string, layout string"


def _id_type(df: DataFrame, id: str) -> str:
    """Whole numbers become long; ids of other types stay as they are."""
    kind = df.schema[id].dataType
    return "long" if isinstance(kind, T.IntegralType) else kind.simpleString()


def _turn_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = []
    for id, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        try:
            record = json.loads(source or "null")
        except ValueError:
            record = None
        mapping = layout_of(record) if isinstance(record, dict) else None
        if mapping is None:
            rows.append((id, None, None, source, None))
        else:
            rows += [(id, number, role, text, mapping.name) for number, role, text in canonical(record, mapping)]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    kinds = (batch.schema.field("id").type, pa.int64(), pa.string(), pa.string(), pa.string())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=["id", "number", "role", "text", "layout"])


def canonical_turns(records: DataFrame, id: str = "id", record: str = "record") -> DataFrame:
    """(id, number, role, text, layout) from JSON records of any known layout.

    Plain fields that no layout reads (an id, a source, a turn's name or weight)
    are passed over. A record that is not JSON, or whose other paths are not
    known, becomes one row with a null layout and the record as text, so nothing
    that may be a turn is lost without a trace.
    Null texts and roles are empty. An empty list of turns gives no rows. Ids of
    any type are kept, whole numbers as long. Roles under the names of other
    layouts become system, user and assistant; those of turn rows stay.
    """
    kind = _id_type(records, id)
    named = records.select(F.col(id).cast(kind).alias("id"), F.col(record).cast("string").alias("record"))
    return named.mapInArrow(batches(_turn_batch), _TURNS.format(id=kind))


# --- the template -------------------------------------------------------------

_TO_ESCAPE, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: each ``<``, backslashes, ``|`` gets one backslash more."""
    return _TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A turn's part of the formatted text, and the span of its text in it."""
    head = f"{START}{_role_line(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def _segment_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = []
    for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
        formatted, start, end = segment(role or "", text or "")
        rows.append((formatted, start, end) if role in TRAINED else (formatted, None, None))
    columns = zip(*rows, strict=True)
    arrays = [batch.column("id"), batch.column("number"), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True))]
    yield pa.RecordBatch.from_arrays(arrays, names=["id", "number", "segment", "loss_start", "loss_end"])


def format_turns(turns: DataFrame) -> DataFrame:
    """(id, number, segment, loss_start, loss_end), a row a turn.

    The formatted conversation is its segments in order of number, then of
    segment where numbers repeat; a null number comes last. Spans count
    characters in the segment and cover the escaped text of trained roles.
    """
    rows = f"id {_id_type(turns, 'id')}, number long, segment string, loss_start long, loss_end long"
    return turns.select("id", "number", "role", "text").mapInArrow(batches(_segment_batch), rows)


_SEGMENT = re.compile(rf"{re.escape(START)}(?P<role>[^\n]*)\n(?P<text>.*?){re.escape(END)}\n", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    found, place = [], 0
    while place < len(formatted):
        m = _SEGMENT.match(formatted, place)
        if m is None:
            raise ValueError(f"no turn at character {place}")
        found.append((_role_of(m["role"]), unescape(m["text"])))
        place = m.end()
    return found


_DIGEST = "conv_id {id}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Running:
    """Digests of one conversation, a segment at a time."""

    def __init__(self, id: object):
        self.id, self.turns, self.loss_chars, self.chars = id, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        for role, text in read_back(formatted):
            self.turns += 1
            self.said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.chars += len(formatted)
        if start is not None:
            trained = unescape(formatted[start:end])
            self.loss_chars += len(trained)
            self.loss.update(trained.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.id, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digest_stream(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _DIGEST.split(", ")]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    now: _Running | None = None
    for batch in stream:
        id_type = batch.schema.field("id").type
        done = []
        for id, formatted, start, end in zip(*(batch.column(c).to_pylist() for c in ("id", "segment", "loss_start", "loss_end")), strict=True):
            if now is None or now.id != id:
                if now is not None:
                    done.append(now.row())
                now = _Running(id)
            now.add(formatted, start, end)
        if done:
            yield rows(done)
    if now is not None:
        yield rows([now.row()])


def digests(segments: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from their segments.

    A conversation's segments stream through one task in order; the task holds
    one segment and two running hashes, however long the conversation is.
    """
    placed = segments.repartition("id").sortWithinPartitions("id", F.col("number").asc_nulls_last(), "segment")
    return placed.mapInArrow(_digest_stream, _DIGEST.format(id=_id_type(segments, "id")))


CONTROL = f"{END}{START}assistant ok"


def conversation_records(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The table's rows as records of the turn layout, and conversation -1 in the message layout."""
    row = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    extra = json.dumps({"messages": [{"role": role, "content": CONTROL} for role in ("user", "assistant")]})
    kind = _id_type(conversations, "conv_id")
    own = conversations.select(F.col("conv_id").cast(kind).alias("id"), row.alias("record"))
    return own.union(spark.createDataFrame([(-1, extra)], "id long, record string").select(F.col("id").cast(kind), "record"))


def conversation_digests(conversations: DataFrame) -> DataFrame:
    records = conversation_records(conversations.sparkSession, conversations)
    return digests(format_turns(canonical_turns(records)))
