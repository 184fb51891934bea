"""Chat formatting by incremental black-box rendering.

A template is only asked to render lists of turns. Successive prefixes of a
conversation are rendered, and what an output adds to the one before it is the
new turn's span. A trailer that moves to the end is allowed for; anything else
that changes what was there is a template that rewrites history, and is
reported. Assistant texts are found within their spans by rendering the turn
once more without its text.

Prefixes begin some turns back, not with the whole conversation, so that the
work follows its length. That gives what the whole would give if a turn does
not depend on what lies further back; each stretch is rendered behind half of
those turns too, and a template for which that differs is reported.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import width, written

#: Turns that are rendered on from the same place; turns before them that each prefix begins with; turn numbers whose turns one task renders.
WINDOW, CONTEXT, SPAN = 128, 128, 512


class TurnTemplate:
    """``### role: text </turn>``; backslash, ``#`` and ``<`` in texts, and ``:`` in roles, get a backslash before them."""

    _text, _role, _escaped = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]"), re.compile(r"\\(.)", re.S)
    _turn = re.compile(r"### ((?:[^\\:]|\\.)*?): ((?:[^\\<]|\\.)*) </turn>\n", re.S)

    def escape(self, text: str) -> str:
        return self._text.sub(r"\\\g<0>", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def render(self, turns: list[tuple[str, str]]) -> str:
        return "".join(f"### {self._role.sub(r'\\\g<0>', role)}: {self.escape(text)} </turn>\n" for role, text in turns)

    def parse(self, out: str) -> list[tuple[str, str]]:
        """The turns that ``out`` was rendered from."""
        turns, at = [], 0
        while at < len(out):
            got = self._turn.match(out, at)
            if got is None:
                raise ValueError(f"no turn at {at}")
            turns.append((self.unescape(got[1]), self.unescape(got[2])))
            at = got.end()
        return turns


def _shared(a: str, b: str, lo: int = 0) -> int:
    """Length of the common prefix, of which ``lo`` characters are known."""
    if b.startswith(a):
        return len(a)
    return lo + len(os.path.commonprefix([a[lo:], b[lo:]]))


def render_turns(template, turns: list[tuple[str, str]], learn: str = "assistant", context: list[tuple[str, str]] | None = None) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]], bool]:
    """The whole output, each turn's span, the spans of the texts to learn, and whether the template rewrites history.

    Spans are in characters of the output. When history is rewritten, a turn's
    span begins where the outputs first differ, and texts behind that place that
    were found before are not learnt. ``context`` has turns that come before;
    they are in the output, but have no spans.
    """
    past = list(context or ())
    spans, loss, rewrites, before = [], [], False, template.render(past) if past else ""
    for i, (role, text) in enumerate(turns):
        out = template.render([*past, *turns[: i + 1]])
        lo = _shared(before, out)
        trailer = len(before) - lo
        if trailer:
            if spans:
                spans[-1] = (spans[-1][0], lo)
            if not out.endswith(before[lo:]):
                rewrites, trailer, loss = True, 0, [x for x in loss if x[1] <= lo]
        spans.append((lo, len(out) - trailer))
        if role == learn and text:
            content = template.escape(text)
            bare = template.render([*past, *turns[:i], (role, "")])
            end = _shared(bare, out, min(lo, len(bare)) if bare[:lo] == out[:lo] else 0)
            at = out.find(content, max(lo, end - len(content)))
            if at >= 0:
                loss.append((at, at + len(content)))
        before = out
    return before, spans, loss, rewrites


def render_stretch(template, past: list[tuple[str, str]], turns: list[tuple[str, str]], more: bool, learn: str = "assistant"):
    """``(text, spans, loss, rewrites, local)`` of some turns after ``past``: what they add to the output, spans within that.

    Without ``more`` turns to come the text has what stands at the end. ``local``
    is whether half of ``past`` gives the same.
    """
    out, spans, loss, rewrites = render_turns(template, turns, learn, past)
    start, end, local = spans[0][0] if past else 0, len(out), True
    if past:
        local = template.render([*past[len(past) // 2 + 1 :], *turns]).endswith(out[start:])
    if more:
        after = template.render([*past, *turns, turns[-1]])
        end = _shared(out, after)
        spans[-1] = spans[-1][0], end
    inside = lambda some: [(max(a, start) - start, min(b, end) - start) for a, b in some if a >= start or b > start]
    return out[start:end], inside(spans), inside(loss), rewrites, local


def format_conversations(rows: DataFrame, template=None, window: int = WINDOW, learn: str = "assistant", context: int = CONTEXT, span: int = SPAN) -> DataFrame:
    """``(conv_id, block, part, formatted, spans, loss, rewrites, local)``: each conversation's output in pieces, in order of ``block`` and ``part``.

    Turns are ordered by ``turn`` (nulls first), then role and text; null roles
    and texts are empty, and repeated rows are repeated turns. ``conv_id`` is
    cast to long; a null one is a conversation like any other. Conversations of
    fewer than ``span`` turns and ``window`` turns are one piece. Of a longer one
    each ``span`` turn numbers are a task's, with the turns before them sent
    along, and are rendered ``window`` turns at a time behind ``context`` others,
    so no task holds a whole conversation. ``rewrites`` and ``local`` say what
    was seen of the template in a piece.
    """
    template = template or TurnTemplate()
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, part, past, turns, more, out = None, 0, [], [], False, []

        def close(follow: bool):
            nonlocal part, past, turns
            text, *found, rewrites, local = render_stretch(template, past, turns, follow, learn)
            out.append((*here, part, text, *([{"a": a, "b": b} for a, b in some] for some in found), rewrites, local))
            part, past, turns = part + 1, [*past, *turns][-context:], []

        def flush():
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.string(), kind, kind, pa.bool_(), pa.bool_()
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "block", "part", "formatted", "spans", "loss", "rewrites", "local"])
            out.clear()
            return got

        for batch in batches:
            for c, b, before, role, text, goes_on in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "block", "before", "role", "text", "more")), strict=True):
                if (c, b) != here:
                    if turns:
                        close(more)
                    here, part, past, turns = (c, b), 0, [], []
                elif len(turns) >= window:
                    close(True)
                more = goes_on
                if before:
                    past = [*past, (role, text)][-context:]
                else:
                    turns.append((role, text))
            if out:
                yield flush()
        if turns:
            close(more)
            yield flush()

    block = F.coalesce(F.floor(F.col("turn") / span).cast("long"), F.lit(-(1 << 63)))
    kept = rows.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), block.alias("block"))
    order = Window.partitionBy("conv_id").orderBy("block")
    blocks = kept.groupBy("conv_id", "block").count().select("conv_id", "block", F.lag("block").over(order).alias("previous"), F.lead("block").over(order).isNotNull().alias("more"))
    blocks = written(blocks.filter("more OR previous IS NOT NULL"), "chat-blocks")
    side = blocks.filter("previous IS NOT NULL").select(F.col("conv_id").alias("__wl_c"), F.col("previous").alias("__wl_p"), F.col("block").alias("__wl_b"))
    early = kept.join(side, F.col("conv_id").eqNullSafe(F.col("__wl_c")) & (F.col("block") == F.col("__wl_p"))).select("conv_id", F.col("__wl_b").alias("block"), F.lit(True).alias("before"), "turn", "role", "text")
    flag = blocks.filter("more").select(F.col("conv_id").alias("__wl_c"), F.col("block").alias("__wl_b"), F.lit(True).alias("more"))
    every = kept.select("conv_id", "block", F.lit(False).alias("before"), "turn", "role", "text").unionByName(early)
    every = every.join(flag, F.col("conv_id").eqNullSafe(F.col("__wl_c")) & (F.col("block") == F.col("__wl_b")), "left").withColumn("more", F.coalesce("more", F.lit(False)))
    dealt = every.repartition(width(rows.sparkSession), "conv_id", "block").sortWithinPartitions("conv_id", "block", F.desc("before"), "turn", "role", "text")
    return dealt.select("conv_id", "block", "before", "role", "text", "more").mapInArrow(run, "conv_id long, block long, part int, formatted string, spans array<struct<a:int,b:int>>, loss array<struct<a:int,b:int>>, rewrites boolean, local boolean")


def digest(rows: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites`` of each conversation and of -7, read back from what they were formatted as."""
    trial = rows.sparkSession.createDataFrame([(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")], "conv_id long, turn long, role string, text string")
    template = TurnTemplate()
    done = format_conversations(rows.select("conv_id", "turn", "role", "text").unionByName(trial), template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []

        def close():
            out.append((conv, state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["all"], state["rewrites"]))

        def flush():
            kinds = pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"])
            out.clear()
            return got

        for batch in batches:
            for c, text, loss, rewrites in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "formatted", "loss", "rewrites")), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        close()
                    conv, state = c, {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0, "rewrites": False}
                state["rewrites"] |= rewrites
                for role, said in template.parse(text):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{said}\n".encode())
                learnt = "".join(template.unescape(text[s["a"] : s["b"]]) for s in loss)
                state["chars"] += len(learnt)
                state["loss"].update(learnt.encode())
                state["all"] += len(text)
            if out:
                yield flush()
        if state is not None:
            close()
            yield flush()

    dealt = done.select("conv_id", "block", "part", "formatted", "loss", "rewrites").repartition(width(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "block", "part")
    return dealt.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean")
