"""Chat formatting: a finite-state machine over roles and a declarative template.

Turns are dealt by conversation and sorted inside their partition; the machine and the template
then run as a stream over the rows, so a conversation of any length needs only its current turn
in memory. Each turn yields its text segments with a loss flag. A text that spells a control
string of the template is escaped, and reading back undoes it.

Null texts are empty, a null role is the empty role, rows with a null conversation form one
conversation. Turns with the same number follow by role, then text; repeated rows are repeated
turns. Roles outside the template are formatted with the generic marks, without loss, and make a
conversation invalid. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows

ESCAPE = "␛"


@dataclass(frozen=True)
class RoleMarks:
    """What opens and closes a turn of a role, and whether its text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Marks by role, allowed successors by state (the empty state starts), and states in which a conversation may end."""

    roles: dict[str, RoleMarks] = field(
        default_factory=lambda: {
            "system": RoleMarks("<<SYS>>", "<</SYS>>"),
            "user": RoleMarks("[INST]", "[/INST]"),
            "assistant": RoleMarks("<s>", "</s>", loss=True),
        }
    )
    other: tuple[str, str, str] = ("[TURN]", "[:]", "[/TURN]")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    ends: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        """All control strings, longest first."""
        marks = {m for r in self.roles.values() for m in (r.open, r.close)} | set(self.other)
        return sorted(marks, key=lambda m: (-len(m), m))


class Codec:
    """Escaping, rendering and reading back for one template."""

    def __init__(self, template: ChatTemplate) -> None:
        self.template = template
        controls = template.controls()
        self.code = {ESCAPE: ESCAPE * 2} | {c: f"{ESCAPE}{i}." for i, c in enumerate(controls)}
        self.plain = {v: k for k, v in self.code.items()}
        self.find = re.compile("|".join(map(re.escape, [*controls, ESCAPE])))
        self.undo = re.compile(f"{ESCAPE}(?:{ESCAPE}|[0-9]+\\.)")
        self.mark = re.compile("|".join(map(re.escape, controls)))
        self.opens = {m.open: r for r, m in template.roles.items()}

    def escape(self, text: str) -> str:
        return self.find.sub(lambda m: self.code[m[0]], text)

    def unescape(self, text: str) -> str:
        return self.undo.sub(lambda m: self.plain[m[0]], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """A turn as (string, loss flag) segments."""
        marks = self.template.roles.get(role)
        if marks:
            return [(marks.open, False), (self.escape(text), marks.loss), (marks.close, False)]
        a, b, c = self.template.other
        return [(f"{a}{self.escape(role)}{b}", False), (self.escape(text), False), (c, False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a formatted string."""
        out, at = [], 0
        a, b, _ = self.template.other
        while at < len(formatted):
            opened = self.mark.match(formatted, at)
            start, end = opened.end(), self.mark.search(formatted, opened.end())
            role = self.opens.get(opened[0])
            if opened[0] == a and role is None:
                role = self.unescape(formatted[start : end.start()])
                start, end = end.end(), self.mark.search(formatted, end.end())
            out.append((role, self.unescape(formatted[start : end.start()])))
            at = end.end()
        return out


SEGMENTS = "segments array<struct<text:string,loss:boolean>>"


def format_turns(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per turn, in order: (conv_id, nth, role, segments, ok).

    ``ok`` tells whether the role may follow the previous one. Rows of a conversation are
    consecutive in one partition.
    """
    template = template or ChatTemplate()

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        codec, conv, nth, state = Codec(template), object(), 0, ""
        for conv_id, _, role, text in rows:
            if conv_id != conv:
                conv, nth, state = conv_id, 0, ""
            role = role or ""
            yield conv_id, nth, role, codec.segments(role, text or ""), role in template.follows.get(state, ())
            nth, state = nth + 1, role

    turns = conversations.select("conv_id", "turn", "role", "text")
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_rows(turns, run, f"conv_id long, nth long, role string, {SEGMENTS}, ok boolean")


def chat_digest(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Read formatted turns back; one row per conversation with counts and digests.

    ``turns`` is what ``format_turns`` returns, in its order. ``valid`` is true if every turn
    may follow its predecessor and the conversation ends where the template allows it.
    """
    template = template or ChatTemplate()

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        codec, conv, out = Codec(template), object(), None

        def closed():
            key, n, all_turns, chars, loss, size, ok, last = out
            return key, n, all_turns.hexdigest(), chars, loss.hexdigest(), size, ok and last in template.ends

        for conv_id, segments, ok in rows:
            if conv_id != conv:
                if out:
                    yield closed()
                conv, out = conv_id, [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, ""]
            formatted = "".join(s["text"] for s in segments)
            for role, text in codec.read(formatted):
                out[1] += 1
                out[2].update(f"{role}\n{text}\n".encode())
                out[7] = role
            trained = codec.unescape("".join(s["text"] for s in segments if s["loss"]))
            out[3] += len(trained)
            out[4].update(trained.encode())
            out[5] += len(formatted)
            out[6] = out[6] and ok
        if out:
            yield closed()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    return map_rows(turns.select("conv_id", "segments", "ok"), run, schema)


def format_conversations(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Formatted text and loss spans by conversation: (conv_id, formatted, segments, valid)."""
    template = template or ChatTemplate()
    turns = format_turns(conversations, template)
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("nth", "segments", "ok", "role"))).alias("t"))
    segments = F.flatten(F.col("t.segments"))
    return rows.select(
        "conv_id",
        F.array_join(F.transform(segments, lambda s: s["text"]), "").alias("formatted"),
        segments.alias("segments"),
        (F.forall(F.col("t.ok"), lambda x: x) & F.element_at("t.role", -1).isin(*template.ends)).alias("valid"),
    )
