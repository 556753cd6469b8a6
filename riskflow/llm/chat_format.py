"""Chat records of several layouts, as one reversible training format.

A record is a JSON text.  Its schema fingerprint is a hash of the sorted nested
field paths that any layout knows (``messages[].role`` and the like; other
fields are ignored).  The fingerprint selects a declarative layout, which says
where the turns are; nothing else about a record is guessed.

A turn is written as ``<open mark><text></s>``.  Texts cannot be taken for marks:
a backslash is doubled, and a control string gets a backslash after its first
character, so reading back is exact.  The loss mask of a turn is the span, in
code points, of an assistant's text.

Formatting looks at one record at a time and needs no shuffle.  Reading a
conversation's digest back is sequential by nature: its turns are sorted on disk
and hashed as a stream, so memory does not grow with a conversation.

Defined cases: null or absent role and text count as empty; a role without a
mark of its own is written out; a record that is null, is not a JSON object, is nested
too deeply to be read, has a turn that is no object or matches no layout gives one row
without text and with ``layout`` null, and a conversation of such records is read back
with no turns; half a surrogate pair becomes U+FFFD; turns with the same number are
ordered by their formatted text; repeated rows are repeated turns; a null conversation
id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import written

# Fixed values of the format.
OPEN = {"system": "[SYS]", "user": "[INST]", "assistant": "[ANS]"}
CLOSE = "</s>"
CONTROL = r"</?s>|\[/?(?:SYS|INST|ANS|ROLE)\]"

_ESCAPED = re.compile(rf"\\|{CONTROL}")
_HALF_PAIR = re.compile("[\ud800-\udfff]")
_BACKSLASH = re.compile(r"\\(.)", re.DOTALL)
_PART = re.compile(r"(?:\[(SYS|INST|ANS)\]|\[ROLE\](.*?)\[/ROLE\])(.*?)</s>\Z", re.DOTALL)
_ROLE_OF = {mark.strip("[]"): role for role, mark in OPEN.items()}


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    With ``items`` the record has a list of turns, each with the fields ``role``
    and ``text``; without, each of ``turns`` names a role and the fields whose
    texts, joined by an empty line, are its turn; beside ``items``, these turns come
    first.  ``optional`` fields may lack.
    """

    name: str
    items: str | None = None
    role: str | None = None
    text: str | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    roles: Mapping[str, str] = field(default_factory=dict)

    def paths(self) -> set[str]:
        named = {name for _, names in self.turns for name in names}
        if self.role is None:
            return named
        prefix = f"{self.items}[]." if self.items else ""
        return named | {prefix + self.role, prefix + self.text}


_SYSTEM = ("system", ("system",))
LAYOUTS = (
    Layout("turn", role="role", text="text", optional=("role", "text")),
    Layout("messages", "messages", "role", "content", (_SYSTEM,), ("messages[].content", "system")),
    Layout(
        "conversations",
        "conversations",
        "from",
        "value",
        (_SYSTEM,),
        ("conversations[].value", "system"),
        {"human": "user", "gpt": "assistant"},
    ),
    Layout(
        "prompt_completion",
        turns=(_SYSTEM, ("user", ("prompt",)), ("assistant", ("completion",))),
        optional=("system",),
    ),
    Layout(
        "prompt_response",
        turns=(_SYSTEM, ("user", ("prompt",)), ("assistant", ("response",))),
        optional=("system", "response"),
    ),
    Layout(
        "instruction",
        turns=(
            _SYSTEM,
            ("user", ("instruction", "input")),
            ("assistant", ("output",)),
        ),
        optional=("system", "input"),
    ),
)
KNOWN_PATHS = frozenset().union(*(layout.paths() for layout in LAYOUTS))


def _hash(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _registry() -> dict[str, Layout]:
    """Each layout under the fingerprint of every combination of its optional fields."""
    known: dict[str, Layout] = {}
    for layout in LAYOUTS:
        for n in range(len(layout.optional) + 1):
            for absent in combinations(layout.optional, n):
                if paths := layout.paths() - set(absent):
                    known[_hash(paths)] = layout
    return known


BY_FINGERPRINT = _registry()


def field_paths(value: object, prefix: str = "") -> set[str]:
    """Nested paths of the fields that are not null; list elements share the path ``[]``."""
    if isinstance(value, dict):
        found = (field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items())
    elif isinstance(value, list):
        found = (field_paths(v, f"{prefix}[]") for v in value)
    else:
        return {prefix} if value is not None else set()
    return set().union(*found)


def fingerprint(record: object) -> str:
    return _hash(field_paths(record) & KNOWN_PATHS)


def canonical_turns(record: dict, layout: Layout) -> list[tuple[str, str]] | None:
    """Role and text of each turn; None if one of the turns is no object."""

    def as_text(value: object) -> str:
        if value is None:
            return ""
        text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
        return _HALF_PAIR.sub("\ufffd", text)

    turns = []
    for role, names in layout.turns:
        texts = [as_text(record[name]) for name in names if record.get(name) is not None]
        if texts:
            turns.append((role, "\n\n".join(t for t in texts if t)))
    if layout.role is None:
        return turns
    items = record[layout.items] if layout.items else [record]
    if not all(isinstance(item, dict) for item in items):
        return None
    pairs = [(as_text(i.get(layout.role)), as_text(i.get(layout.text))) for i in items]
    return turns + [(layout.roles.get(role, role), text) for role, text in pairs]


def escape(text: str) -> str:
    def mark(m: re.Match) -> str:
        found = m[0]
        return "\\\\" if found == "\\" else f"{found[0]}\\{found[1:]}"

    return _ESCAPED.sub(mark, text)


def unescape(text: str) -> str:
    return _BACKSLASH.sub(r"\1", text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and start and end of its loss mask (both 0 if it has none)."""
    head = OPEN.get(role) or f"[ROLE]{escape(role)}[/ROLE]"
    body = escape(text)
    span = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
    return f"{head}{body}{CLOSE}", *span


def read_turn(part: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    mark, role, body = _PART.match(part).groups()
    return _ROLE_OF[mark] if mark else unescape(role), unescape(body)


def format_chats(
    records: DataFrame,
    id_column: str = "conv_id",
    order_column: str = "turn",
    record_column: str = "record",
) -> DataFrame:
    """One row per turn: id, order, position in the record, layout, part, loss_start, loss_end.

    The parts of a conversation in order, one after the other, are its formatted text.
    """
    id_type = records.schema[id_column].dataType.simpleString()
    order_type = records.schema[order_column].dataType.simpleString()

    def turns_of(text: str | None) -> tuple[str | None, list[tuple[str, str]]]:
        try:
            record = json.loads(text) if text is not None else None
            layout = BY_FINGERPRINT.get(fingerprint(record)) if isinstance(record, dict) else None
            turns = canonical_turns(record, layout) if layout is not None else None
        except (ValueError, RecursionError):
            return None, []
        return (None, []) if turns is None else (layout.name, turns)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, rows = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                name, turns = turns_of(text)
                for k, (role, said) in enumerate(turns):
                    source.append(i)
                    rows.append((k, name, *write_turn(role, said)))
                if not turns:
                    source.append(i)
                    rows.append((0, name, None, 0, 0))
            take = pa.array(source, pa.int64())
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    *[pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ],
                [id_column, order_column, "position", "layout", "part", "loss_start", "loss_end"],
            )

    return records.select(id_column, order_column, record_column).mapInArrow(
        formatted,
        f"`{id_column}` {id_type}, `{order_column}` {order_type}, position int, layout string, "
        "part string, loss_start bigint, loss_end bigint",
    )


class _Conversation:
    """Running digests of one conversation."""

    def __init__(self, key: object):
        self.key = key
        self.turns = self.loss = self.chars = 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, part: str | None, start: int, end: int) -> None:
        if part is None:
            return  # of a record without a turn
        role, text = read_turn(part)
        self.turns += 1
        self.chars += len(part)
        self.said.update(f"{role}\n{text}\n".encode())
        learned = unescape(part[start:end])
        self.loss += len(learned)
        self.learned.update(learned.encode())

    def row(self) -> tuple:
        digests = self.said.hexdigest(), self.loss, self.learned.hexdigest()
        return (self.key, self.turns, *digests, self.chars)


def read_back(formatted: DataFrame, id_column: str = "conv_id", order_column: str = "turn") -> DataFrame:
    """Per conversation, those without turns too: id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    id_type = formatted.schema[id_column].dataType.simpleString()
    names = [id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type, current = None, None

        def rows(done: list[_Conversation]) -> pa.RecordBatch:
            columns = list(zip(*[c.row() for c in done], strict=True))
            types = (key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            key_type, done = batch.schema.field(0).type, []
            for key, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or key != current.key:
                    if current is not None:
                        done.append(current)
                    current = _Conversation(key)
                current.add(*turn)
            if done:
                yield rows(done)
        if current is not None:
            yield rows([current])

    return (
        formatted.repartition(id_column)
        .sortWithinPartitions(id_column, order_column, "position", "part")
        .select(id_column, "part", "loss_start", "loss_end")
        .mapInArrow(
            digests,
            f"`{id_column}` {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
            "loss_sha256 string, formatted_chars bigint",
        )
    )


def conversation_records(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as JSON records of the one-turn layout."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    record = F.to_json(F.struct(text("role").alias("role"), text("text").alias("text")))
    return conversations.select("conv_id", "turn", record.alias("record"))


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """Format a table of turns, write the result, and read its digests back."""
    return read_back(written(format_chats(conversation_records(conversations)), "chats"))
