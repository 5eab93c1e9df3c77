"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a text.  Prefixes of a
conversation of growing length are rendered; what the next prefix adds is that
turn's span, and a prefix that does not start with the one before means that
the template rewrites history.  Inside a span, two renderings with stand-in
texts show which characters before and after the text belong to the template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.session import ship_package

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# Control strings of the template; in texts and roles they are written after a backslash
MARK, END, QUOTE = "###", "</turn>", "\\"
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_QUOTED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)
# Stand-ins for a text: two characters that no template writes
_STAND_INS = ("\ue000", "\ue001")


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: QUOTE + m[0], text)


def unescape(text: str) -> str:
    return _QUOTED.sub(r"\1", text)


@lru_cache(maxsize=100_000)
def _turn(role: str, text: str) -> str:
    return f"{MARK} {escape(role, _ROLE)}: {escape(text)}{END}\n"


def turn_template(turns: list[Turn]) -> str:
    """``### role: text</turn>`` per turn."""
    return "".join([_turn(r, t) for r, t in turns])


def read_back(formatted: str) -> list[Turn]:
    """The turns of a text that ``turn_template`` wrote."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


@dataclass
class Rendered:
    text: str
    spans: list[tuple[int, int]]      # of each turn
    contents: list[tuple[int, int]]   # of each turn's text, escaped
    rewrites: list[int]               # turns whose rendering changed what stood before


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def render_incrementally(turns: list[Turn], template: Template) -> Rendered:
    """Render prefix by prefix and locate each turn and its text.

    After a rewrite the turn's span starts at the first changed character and
    spans of earlier turns end there at the latest.
    """
    before, spans, contents, rewrites = "", [], [], []
    for k, (role, _) in enumerate(turns):
        after = template(turns[:k + 1])
        start = len(before)
        if not after.startswith(before):
            rewrites.append(k)
            start = _common(before, after)
            spans = [(min(a, start), min(b, start)) for a, b in spans]
            contents = [(min(a, start), min(b, start)) for a, b in contents]
        one, two = (template([*turns[:k], (role, s)])[start:] for s in _STAND_INS)
        head = _common(one, two)
        tail = len(one) - head - 1
        spans.append((start, len(after)))
        contents.append((start + head, max(start + head, len(after) - tail)))
        before = after
    return Rendered(before, spans, contents, rewrites)


def format_chats(conversations: DataFrame, *, template: Template = turn_template,
                 loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, spans, loss, rewrites``.

    ``spans``: start and end (code points) of each turn; ``loss``: of the texts
    of ``loss_roles``, the loss mask; ``rewrites``: indexes of turns at which the
    template changed earlier output.

    Defined cases: rows are ordered by turn (null first), then role, then text,
    so ties and repeated rows have one order and all count; a null role or text
    is empty; null conversation ids form one conversation; an empty table gives
    an empty result; other input columns are ignored.  A conversation is one
    text and is formatted in one task.
    """
    ship_package(conversations.sparkSession)
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def as_spans(pairs: list[tuple[int, int]]) -> list[dict]:
        return [{"start": a, "end": b} for a, b in pairs]

    def one(table: pa.Table) -> pa.Table:
        turn, role, text = (table.column(c).to_pylist() for c in ("turn", "role", "text"))
        order = sorted(range(len(turn)), key=lambda i: (turn[i] is not None, turn[i] if turn[i] is not None else 0,
                                                        role[i], text[i]))
        turns = [(role[i], text[i]) for i in order]
        out = render_incrementally(turns, template)
        loss = [c for c, (r, _) in zip(out.contents, turns) if r in loss_roles]
        return pa.table({"conv_id": table.column("conv_id").slice(0, 1), "formatted": [out.text],
                         "spans": pa.array([as_spans(out.spans)], span), "loss": pa.array([as_spans(loss)], span),
                         "rewrites": pa.array([out.rewrites], pa.list_(pa.int32()))})

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.groupBy("conv_id").applyInArrow(
        one, f"conv_id {kind}, formatted string, spans array<struct<start:bigint,end:bigint>>, "
             "loss array<struct<start:bigint,end:bigint>>, rewrites array<int>")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: turns, loss text and lengths as digests."""
    ship_package(formatted.sparkSession)
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                turns = read_back(text)
                learned = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                            hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    rows = formatted.select("conv_id", "formatted", "loss")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                 "loss_sha256 string, formatted_chars bigint")
