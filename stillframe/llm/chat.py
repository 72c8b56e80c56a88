"""Chat formatting with a template that is known only by what it renders.

Successive prefixes of a conversation are rendered. Where each output begins
with the one before, what it adds is the span of its last turn; where one does
not, the template rewrites history and has no spans.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

Template = Callable[[list[tuple[str, str]]], str]


def _escaped(text: str) -> str:
    return re.sub(r"[\\#<:]", r"\\\g<0>", text)


#: Successive prefixes render the same texts again; these many short ones are remembered.
_remembered = lru_cache(1 << 16)(_escaped)


def escape(text: str) -> str:
    return _remembered(text) if len(text) <= 1024 else _escaped(text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turn_template(turns: list[tuple[str, str]]) -> str:
    """``### role: text</turn>`` and a line feed for each turn; backslashes, #, < and : in roles and texts have a backslash before them."""
    return "".join(f"### {escape(role)}: {escape(text)}</turn>\n" for role, text in turns)


_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<])*)</turn>\n", re.DOTALL)


def read_turn(span: str) -> tuple[str, str]:
    """Role and text of a span of turn_template."""
    m = _TURN.fullmatch(span)
    if not m:
        raise ValueError("not a rendered turn")
    return unescape(m[1]), unescape(m[2])


def locate(turns: list[tuple[str, str]], render: Template) -> tuple[str, list[int] | None]:
    """The rendered conversation and where each turn ends in it, or None if the template rewrites history.

    Every prefix is rendered, whatever the number of turns, and must begin with
    the one before.
    """
    ends, last = [], ""
    for i in range(1, len(turns) + 1):
        out = render(turns[:i])
        if not out.startswith(last):
            return render(turns), None
        ends.append(len(out))
        last = out
    return last, ends


def format_conversations(conversations: DataFrame, render: Template = turn_template, read: Callable[[str], tuple[str, str]] = read_turn, loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, turn_ends, loss_spans, rewrites_history.

    Rows are ordered by turn, ties by role and text, nulls first; a null text or
    role is empty; rows of a null conversation form one conversation. Repeated
    rows are repeated turns. loss_spans holds begin and end pairs of the turns
    of ``loss_roles``, as read back from the output; empty if history is
    rewritten. Rows are streamed in order, so a task holds one conversation.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, own in groupby(rows, key=lambda r: r[0]):
            turns = [(role or "", text or "") for _, _, role, text in own]
            out, ends = locate(turns, render)
            spans = []
            for begin, end in zip([0, *(ends or [])], ends or []):
                if read(out[begin:end])[0] in loss_roles:
                    spans += [begin, end]
            yield conv, out, ends or [], spans, ends is None

    d = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["conv"].dataType.simpleString()
    d = d.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return map_rows(d, ["conv", "turn", "role", "text"], f"conv_id {kind}, formatted string, turn_ends array<int>, loss_spans array<int>, rewrites_history boolean", run)


def digests(formatted: DataFrame, read: Callable[[str], tuple[str, str]] = read_turn) -> DataFrame:
    """What the formatted text says, read back from its spans: turns and the text under the loss mask, as counts and SHA-256."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, out, ends, spans in rows:
            turns, loss, chars = sha256(), sha256(), 0
            for begin, end in zip([0, *ends], ends):
                role, text = read(out[begin:end])
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for begin, end in zip(spans[::2], spans[1::2]):
                text = read(out[begin:end])[1]
                loss.update(text.encode("utf-8", "surrogatepass"))
                chars += len(text)
            yield conv, len(ends), turns.hexdigest(), chars, loss.hexdigest(), len(out)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return map_rows(formatted, ["conv_id", "formatted", "turn_ends", "loss_spans"], f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", run)
