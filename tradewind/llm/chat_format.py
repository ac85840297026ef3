"""Chat formatting: turns to text segments with a loss flag each.

A declarative :class:`Template` names, per role, the marker before and after the
text and whether the text is trained on. A finite-state machine over the roles
checks the order of a conversation's turns; a turn that it does not allow is
formatted all the same, with ``allowed`` false and the machine's state kept, so
that the caller decides what happens to such conversations.

Texts cannot forge a marker. Every marker starts with ``<`` or ``[`` and has
these characters nowhere else, and the escape character follows each of them
inside a text, so a marker never occurs there. Taking it out again gives the
text back exactly, and :func:`read_back` does so with the markers as its only
guide.

Rows are dealt by conversation and sorted by turn inside Spark; tasks then
stream over them with one state, so a conversation of any length needs the
memory of one Arrow batch. All turns of a conversation do pass through one task,
because its order, and the digests of :func:`conversation_digests`, are
sequential.

Defined results: a null text is empty; a null role is the empty role, which like
every unknown role is formatted by the template's generic form; rows that tie on
the turn are ordered by role and text, a null turn comes first; a null
conversation id is a conversation of its own; repeated rows are repeated turns;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"
_LEADS = "<["


@dataclass(frozen=True)
class Turn:
    """Markers around a role's text, and whether the text is trained on."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How conversations look. ``follows`` maps a state to the roles allowed next;
    the state after a role is the role itself, and ``start`` the first one."""

    turns: dict[str, Turn]
    follows: dict[str, tuple[str, ...]]
    other: tuple[str, str, str] = ("[ROLE]", "[SAYS]", "[END]")
    opening: str = "<s>"
    start: str = "start"
    markers: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = {m for t in self.turns.values() for m in (t.before, t.after)} | {*self.other, self.opening}
        for mark in marks:
            if mark[:1] not in tuple(_LEADS) or any(c in mark[1:] for c in _LEADS) or ESCAPE in mark:
                raise ValueError(f"marker {mark!r} must start with < or [ and hold them nowhere else")
        befores = [t.before for t in self.turns.values()] + [self.other[0]]
        if len(set(befores)) < len(befores):
            raise ValueError("every role needs a first marker of its own")
        object.__setattr__(self, "markers", tuple(sorted(marks, key=len, reverse=True)))


INSTRUCT = Template(
    turns={
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<a>", "</s>", loss=True),
    },
    follows={
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
)

SEGMENTS = "array<struct<text: string, loss: boolean>>"


def escape(text: str) -> str:
    for lead in _LEADS:
        text = text.replace(lead, lead + ESCAPE)
    return text


def unescape(text: str) -> str:
    for lead in _LEADS:
        text = text.replace(lead + ESCAPE, lead)
    return text


def segments_of(template: Template, role: str, text: str, first: bool) -> list[tuple[str, bool]]:
    """A turn's segments in order; together they are its formatted text."""
    opening = template.opening if first else ""
    if turn := template.turns.get(role):
        return [(opening + turn.before, False), (escape(text), turn.loss), (turn.after, False)]
    begin, says, end = template.other
    return [(opening + begin + escape(role) + says, False), (escape(text), False), (end, False)]


def read_back(template: Template, formatted: str) -> list[tuple[str, str, bool]]:
    """Role, text and loss flag of every turn of a formatted text."""
    pieces = re.split("(" + "|".join(map(re.escape, template.markers)) + ")", formatted)
    opened = {t.before: (role, t.loss) for role, t in template.turns.items()}
    turns, role, loss, text = [], None, False, ""
    closing = {t.after for t in template.turns.values()} | {template.other[2]}
    named = False
    for index, piece in enumerate(pieces):
        if index % 2 == 0:
            text += piece
        elif piece in opened:
            (role, loss), text = opened[piece], ""
        elif piece == template.other[0]:
            named, loss, text = True, False, ""
        elif piece == template.other[1] and named:
            role, text, named = unescape(text), "", False
        elif piece in closing and role is not None:
            turns.append((role, unescape(text), loss))
            role, text = None, ""
    return turns


def format_chats(
    conversations: DataFrame,
    template: Template = INSTRUCT,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per turn, in order within each partition: ``conv_id, turn, role,
    allowed, segments``. A conversation's formatted text is all its segments joined."""
    rows = conversations.select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), template.start
        for batch in batches:
            allowed, segments = [], []
            ids, roles, texts = (batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))
            for conv, who, said in zip(ids, roles, texts):
                first = conv != current
                if first:
                    current, state = conv, template.start
                ok = who in template.follows.get(state, ())
                state = who if ok else state
                allowed.append(ok)
                segments.append([{"text": t, "loss": f} for t, f in segments_of(template, who, said, first)])
            kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("conv_id", "turn", "role")), pa.array(allowed, pa.bool_()), pa.array(segments, kind)],
                names=["conv_id", "turn", "role", "allowed", "segments"],
            )

    return ordered.mapInArrow(run, f"conv_id long, turn long, role string, allowed boolean, segments {SEGMENTS}")


def conversation_digests(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digests of each conversation, read back from the segments of :func:`format_chats`.

    Takes its result as it is: rows of a conversation in order in one partition.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "allowed"]
    schema = pa.schema(
        zip(names, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_, done = None, False, []
        n = chars = size = 0
        allowed, turns, loss = True, hashlib.sha256(), hashlib.sha256()

        def close():
            done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size, allowed))

        for batch in batches:
            ids, oks, all_segments = (batch.column(c).to_pylist() for c in ("conv_id", "allowed", "segments"))
            for conv, ok, segments in zip(ids, oks, all_segments):
                if open_ and conv != current:
                    close()
                if not open_ or conv != current:
                    current, open_, allowed = conv, True, True
                    n = chars = size = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                written = "".join(s["text"] for s in segments)
                size += len(written)
                allowed &= ok
                for who, said, _ in read_back(template, written):
                    n += 1
                    turns.update(f"{who}\n{said}\n".encode("utf-8", "surrogatepass"))
                for s in segments:
                    if s["loss"]:
                        said = unescape(s["text"])
                        chars += len(said)
                        loss.update(said.encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done.clear()
        if open_:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, allowed boolean",
    )
