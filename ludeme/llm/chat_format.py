"""Chat formatting by incremental rendering of a black-box template.

A template is a function from a list of messages to a string; nothing else is
known of it.  Successive prefixes of a conversation are rendered, and each
output is compared with the one before: what it adds is the new turn's span.
An output that does not start with the one before rewrites history and is
reported (``rewrites``: turns at which that happens).

A conversation of any length is cut into blocks of ``block_turns`` turns, so a
block's work and memory are bounded and one conversation spreads over many tasks.
A block is rendered behind the conversation's leading system turns and its
``context_turns`` turns before.  To find templates that need more, the whole block
is also rendered behind 4, 8, 16 ... up to ``block_turns`` turns before and behind the
conversation's first ``first_turns`` turns: where it adds something else then, its
turns are compared one by one, and those that differ count as rewrites.  What stays
undetected is a dependence only on turns that are neither among the first ones nor
among the ``block_turns`` before the block.

The template that is given here marks turns and escapes control strings:
a backslash is doubled and ``<|`` in a text becomes ``<\\|``, so no text can
hold a mark, and reading back undoes it.

Defined cases: a null text or role is empty; rows of equal turn are ordered by
role, then text; null turns come last; a null conversation id is one
conversation; equal rows are turns of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Template = Callable[[list[dict]], str]

START, END, PROBE = "<|im_start|>", "<|im_end|>", "\ue000"
_READ = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
_UNDO = re.compile(r"\\(\\|n)|<\\\|")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    return _UNDO.sub(lambda m: "<|" if m[0][0] == "<" else "\n" if m[1] == "n" else "\\", text)


def chatml(messages: list[dict]) -> str:
    return "".join(f"{START}{escape(m['role']).replace(chr(10), chr(92) + 'n')}\n"
                   f"{escape(m['content'])}{END}\n" for m in messages)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a formatted string."""
    return [(unescape(r), unescape(t)) for r, t in _READ.findall(formatted)]


@dataclass(frozen=True)
class Format:
    block_turns: int = 32
    context_turns: int = 2
    first_turns: int = 8         # of the conversation, compared with; leading system turns among
    trained_role: str = "assistant"
    system_role: str = "system"


def turn_spans(messages: list[dict], context: int, template: Template,
               role: str) -> tuple[str, list, list, list]:
    """What the messages after the first ``context`` add, and in it their spans,
    the spans of the texts of ``role``, and the numbers of the turns where the
    output before is not the new one's beginning.

    A text's place is found by rendering its turn with a probe for the text."""
    before = template(messages[:context]) if context else ""
    begin, spans, loss, rewrites = len(before), [], [], []
    for k in range(context + 1, len(messages) + 1):
        now, last = template(messages[:k]), messages[k - 1]
        if not now.startswith(before):
            rewrites.append(k - 1 - context)
        a = min(len(before), len(now))
        if last["role"] == role and last["content"]:
            probed = template([*messages[:k - 1], {**last, "content": PROBE}])
            if (at := probed.rfind(PROBE)) >= a:
                loss.append((at - begin, len(now) - (len(probed) - at - 1) - begin))
        spans.append((a - begin, len(now) - begin))
        before = now
    return before[begin:], spans, loss, rewrites


def _ranked(rows: DataFrame, step: int) -> DataFrame:
    """Adds ``at``, a row's place in its conversation from 0.  Places are counted
    within runs of turn numbers, and the runs' sizes summed up, so a long
    conversation is not sorted in one task."""
    run = F.coalesce(F.floor(F.col("turn") / step), F.lit((1 << 62))).cast("long")
    x = rows.withColumn("_run", run)
    sizes = x.groupBy("conv_id", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_run").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv_id").alias("_c"), F.col("_run").alias("_r"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    own = Window.partitionBy("conv_id", "_run").orderBy(F.asc_nulls_last("turn"), "role", "text")
    x = x.withColumn("_own", F.row_number().over(own) - 1)
    return x.join(sizes, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_run") == F.col("_r"))) \
        .select("conv_id", "role", "text", (F.col("_before") + F.col("_own")).alias("at"), "n_turns")


def format_conversations(conversations: DataFrame, f: Format = Format(),
                         template: Template = chatml) -> DataFrame:
    """Per block: conv_id, block, first (its first turn's place), formatted,
    ``spans`` of its turns and ``loss`` spans (start, end in the block, code
    points, end exclusive) and ``rewrites`` (turns of the block)."""
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    n = f.block_turns
    x = _ranked(rows, 8 * n)
    block = F.floor(F.col("at") / n)
    last = F.floor((F.col("n_turns") - 1) / n)
    # A block is the next one's context; the first turns are every block's.
    blocks = F.when(F.col("at") < f.first_turns, F.sequence(block, last)).otherwise(
        F.sequence(block, F.least(block + 1, last)))
    x = x.select("conv_id", F.explode(blocks).alias("block"), "at", "role", "text")
    pair = "array<struct<start:long,end:long>>"
    schema = f"conv_id {kind}, block long, first long, formatted string, spans {pair}, " \
        f"loss {pair}, rewrites array<long>"

    def render(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        messages = [{"role": r, "content": b} for r, b in zip(
            t.column("role").to_pylist(), t.column("text").to_pylist(), strict=True)]
        number = t.column("block")[0].as_py()
        at = t.column("at").to_numpy()
        begin = number * n
        own = messages[int(np.searchsorted(at, begin)):]
        lead = 0
        while lead < min(f.first_turns, begin) and messages[lead]["role"] == f.system_role:
            lead += 1

        def context(before, first=0):
            """The leading system turns, the first ones and those right before the block."""
            return [m for m, k in zip(messages, at, strict=True)
                    if k < begin and (k < max(lead, first) or k >= begin - before)]

        def behind(some):
            return turn_spans([*some, *own], len(some), template, f.trained_role)
        base = context(f.context_turns)
        out, spans, loss, bad = behind(base)
        steps = [2 ** k for k in range(2, 63) if 2 ** k < n] + [n]
        others = [context(k) for k in steps] + [context(f.context_turns, f.first_turns)]
        seen = [base]
        for some in others:
            if some in seen:
                continue
            seen.append(some)
            before, whole = template(some) if some else "", template([*some, *own])
            if whole.startswith(before) and whole[len(before):] == out:
                continue
            more, places, _, worse = behind(some)
            bad = sorted({*bad, *worse, *(k for k, (p, q) in enumerate(
                zip(spans, places, strict=True)) if out[slice(*p)] != more[slice(*q)])})

        def structs(pairs):
            return pa.array([[{"start": a, "end": z} for a, z in pairs]], pa.list_(pa.struct(
                [("start", pa.int64()), ("end", pa.int64())])))
        return pa.table({
            "conv_id": t.column("conv_id").slice(0, 1).combine_chunks(),
            "block": pa.array([number], pa.int64()), "first": pa.array([number * n], pa.int64()),
            "formatted": pa.array([out], pa.string()), "spans": structs(spans),
            "loss": structs(loss), "rewrites": pa.array([bad], pa.list_(pa.int64()))})
    return x.groupBy("conv_id", "block").applyInArrow(render, schema)


def digest(blocks: DataFrame) -> DataFrame:
    """Per conversation, read back from its blocks in order: n_turns, hashes of
    the turns and of the text under the loss mask, and lengths.  Blocks stream
    through a task one by one; only the running hashes are held."""
    kind = blocks.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
             "n_rewrites"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, " \
        "loss_sha256 string, formatted_chars long, n_rewrites long"
    types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        conv, seen, state, of = None, False, None, None

        def rows(done):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t or of) for c, t in zip(zip(*done, strict=True), types, strict=True)],
                names=names)

        def closed():
            n, turns, chars, loss, total, bad = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, bad
        for b in batches:
            done, of = [], b.schema.field("conv_id").type
            for row in b.to_pylist():
                if not seen or row["conv_id"] != conv:
                    if seen:
                        done.append(closed())
                    conv, seen = row["conv_id"], True
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                text = row["formatted"]
                for role, body in read_back(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for s in row["loss"]:
                    body = unescape(text[s["start"]:s["end"]])
                    state[2] += len(body)
                    state[3].update(body.encode())
                state[4] += len(text)
                state[5] += len(row["rewrites"])
            if done:
                yield rows(done)
        if seen:
            yield rows([closed()])
    x = blocks.select("conv_id", "block", "formatted", "loss", "rewrites")
    return x.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, schema)
