"""Best-fit packing of token pieces by the linear grouping scheme.

1. Documents are tokenised in tasks and cut into pieces of at most ``capacity``.
2. Only the number of pieces of each length (at most ``capacity`` numbers)
   reaches the driver, which plans on it alone.  Large lengths are put into
   groups of equal cardinality and rounded up to their group's largest; the
   fractional optimum over configurations of these few sizes is found by column
   generation and rounded down.  The actual lengths are then substituted: slots
   of a configuration take the next pieces of their group, so runs of sequences
   get the same actual lengths.  What is left of the large pieces and all small
   ones are placed by best fit, longest first, into the room that is truly left.
3. The plan says, for runs of ranks within a length, the first sequence of the
   run and the offset in it.  Pieces are ranked within their length by parallel
   windows over (length, bucket) and each looks its place up.

The plan's size depends on ``capacity`` and ``groups`` only, never on the rows.

Defined cases: a null or empty text is the end token alone; repeated rows are
packed one by one; a null id is kept; an empty table gives an empty result;
columns other than id and text are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludeme.llm.text import split_words, text_slices
from ludeme.plans.session import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    large: int = 384            # lengths from here on are planned by configurations
    groups: int = 96
    rooms: tuple[int, ...] = (0, 2, 8, 32, 2048)  # see plan_lengths
    end_id: int = 0
    bucket_rows: int = 50_000   # pieces that one window task ranks, about
    cached_words: int = 600_000
    slice_bytes: int = 16 << 20


# ------------------------------------------------------------------ planning

def _best_configuration(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per size with the largest total value that fits (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for i in np.argsort(-values / sizes):
        if values[i] <= 1e-12:
            continue
        size = int(sizes[i])
        for _ in range(capacity // size):
            more = best[:-size] + values[i]
            better = more > best[size:] + 1e-12
            if not better.any():
                break
            best[size:][better] = more[better]
            last[size:][better] = i
    counts, at = np.zeros(len(sizes), dtype=np.int64), capacity
    while at > 0:
        if last[at] < 0 or best[at] <= best[at - 1] + 1e-12:
            at -= 1
            continue
        counts[last[at]] += 1
        at -= int(sizes[last[at]])
    return counts


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                    rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Configurations and multiplicities: the basic optimum of the fractional
    covering problem, found by column generation, rounded down."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        x = inverse @ demand
        new = _best_configuration(np.maximum(inverse.sum(axis=0), 0), sizes, capacity)
        if inverse.sum(axis=0) @ new <= 1 + 1e-7:
            break
        step = inverse @ new
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.where(up, np.maximum(x, 0) / np.where(up, step, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = new
    x = np.linalg.solve(basis, demand)
    left, out = demand.astype(np.int64).copy(), []
    for j in range(k):
        config = np.rint(basis[:, j]).astype(np.int64)
        times = int(np.floor(x[j] + 1e-9))
        used = config > 0
        times = min([times, *(left[used] // config[used])])
        if times > 0:
            left -= config * times
            out.append((config, times))
    return out


def _grouped_runs(counts: dict[int, int], p: Packing) -> list[tuple[int, list[int]]]:
    """Runs (number of sequences, their actual lengths) that the configurations
    over equal-cardinality groups of the large lengths give after substitution."""
    lengths = sorted((x for x in counts if p.large <= x < p.capacity), reverse=True)
    total = sum(counts[x] for x in lengths)
    k = min(p.groups, total)
    if not k:
        return []
    bounds = [total * (g + 1) // k for g in range(k)]
    queues: dict[int, list[list[int]]] = {}  # rounded length: [length, count], longest first
    g = at = 0
    largest = None
    for x in lengths:
        n = counts[x]
        while n:
            largest = largest or x
            take = min(n, bounds[g] - at)
            if take:
                queues.setdefault(largest, []).append([x, take])
            n, at = n - take, at + take
            if at == bounds[g]:
                g, largest = g + 1, None
    sizes = np.array(list(queues))
    demand = np.array([sum(n for _, n in q) for q in queues.values()], dtype=float)
    out = []
    for config, times in _configurations(sizes, demand, p.capacity):
        slots = []
        for i in np.flatnonzero(config):
            queue = queues[int(sizes[i])]
            for _ in range(config[i]):
                need, runs = times, []
                while need:
                    take = min(need, queue[0][1])
                    runs.append((queue[0][0], take))
                    queue[0][1] -= take
                    need -= take
                    if not queue[0][1]:
                        queue.pop(0)
                slots.append(runs)
        ends = [np.cumsum([n for _, n in runs]) for runs in slots]
        cuts = sorted({0, times, *(int(c) for e in ends for c in e)})
        for a, z in zip(cuts, cuts[1:], strict=False):
            out.append((z - a, [runs[int(np.searchsorted(e, a, side="right"))][0]
                                for runs, e in zip(slots, ends, strict=True)]))
    return out


class _Plan:
    def __init__(self, counts: dict[int, int], p: Packing):
        self.p, self.left = p, dict(counts)
        self.rank = defaultdict(int)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.used = 0

    def open(self, n: int) -> int:
        self.used += n
        return self.used - n

    def place(self, length: int, n: int, first: int, offset: int) -> None:
        self.rows.append((length, self.rank[length], n, first, offset))
        self.rank[length] += n
        self.left[length] -= n

    def take_run(self, n: int, lengths: list[int]) -> None:
        first, offset = self.open(n), 0
        for x in lengths:
            self.place(x, n, first, offset)
            offset += x
        if offset < self.p.capacity:
            self.rooms[self.p.capacity - offset].append((first, n))

    def best_fit(self) -> None:
        c = self.p.capacity
        full = np.zeros(c + 1, dtype=bool)
        for r, runs in self.rooms.items():
            full[r] = bool(runs)
        for length in sorted((x for x, n in self.left.items() if n), reverse=True):
            while n := self.left[length]:
                fits = np.flatnonzero(full[length:])
                if not len(fits):
                    need = -(-n // (c // length))
                    self.rooms[c].append((self.open(need), need))
                    full[c] = True
                    continue
                r = length + int(fits[0])
                first, count = self.rooms[r].pop()
                take = min(n, count)
                if take < count:
                    self.rooms[r].append((first + take, count - take))
                full[r] = bool(self.rooms[r])
                self.place(length, take, first, c - r)
                if r > length:
                    self.rooms[r - length].append((first, take))
                    full[r - length] = True


def plan_lengths(counts: dict[int, int], p: Packing = Packing()) -> tuple[pd.DataFrame, int]:
    """The plan (length, rank, n, sequence, offset) and the number of sequences
    for so many pieces of each length.

    Rounding up can leave room that no small piece fills.  A substituted run
    with more room than a tolerance is taken apart again and its pieces join
    the best-fit phase; of the tolerances ``p.rooms`` the one with the fewest
    sequences counts."""
    runs, best = _grouped_runs(counts, p), None
    for most in p.rooms:
        plan = _Plan(counts, p)
        if whole := plan.left.get(p.capacity, 0):
            plan.place(p.capacity, whole, plan.open(whole), 0)
        for n, lengths in runs:
            if p.capacity - sum(lengths) <= most:
                plan.take_run(n, lengths)
        plan.best_fit()
        if best is None or plan.used < best.used:
            best = plan
    rows = pd.DataFrame(best.rows, columns=["length", "rank", "n", "sequence", "offset"],
                        dtype=np.int64)
    return rows.sort_values(["length", "rank"], ignore_index=True), best.used


# ------------------------------------------------------------------ Spark jobs

def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: a printable byte is its own letter, the others are
    numbered on from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokens:
    """Token ids of texts, as one array and the number of ids of each text.

    The tokenizer never joins characters across blanks, so each distinct part
    between blanks is tokenised once for a slice of texts.  A part that is plain
    letters and then punctuation consists of just these two pre-tokens, which
    go to the model directly and are kept; any other part goes through the
    whole tokenizer."""

    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]*)([-.,!?;:%&*#$|()]*)").fullmatch

    def __init__(self, path: str, cached: int):
        from tokenizers import Tokenizer
        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.model, self.letters, self.known = self.tokenizer.model, _byte_letters(), {"": b""}

    def _token(self, pre: str) -> bytes:
        if (ids := self.known.get(pre)) is None:
            raw = pre if pre.isascii() else "".join(map(self.letters.__getitem__, pre.encode()))
            ids = self.known[pre] = array("I", [t.id for t in self.model.tokenize(raw)]).tobytes()
        return ids

    def _parts(self, parts: list[str]) -> list[bytes]:
        if len(self.known) > self.cached:
            self.known = {"": b""}
        out, odd = [], []
        for i, w in enumerate(parts):
            if plain := self.PLAIN(w):
                out.append(self._token(plain[1].lower()) + self._token(plain[2]))
            else:
                out.append(b"")
                odd.append(i)
        for i, e in zip(odd, self.tokenizer.encode_batch([parts[i] for i in odd],
                                                         add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        starts, codes, parts = split_words(texts, lower=False)
        ids = self._parts(parts)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        n = size[codes]
        ends = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(first[codes] - ends[:-1], n) + np.arange(ends[-1])
        return pool[at], np.diff(ends[starts])


def tokenized_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     p: Packing = Packing(), path: str = TOKENIZER,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 (and
    ``ids``, the token ids as little-endian bytes, if asked for)."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" \
        + ", ids binary" * with_ids

    def cut(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens, end = WordTokens(path, p.cached_words), array("I", [p.end_id]).tobytes()
        step = 4 * p.capacity
        for batch in batches:
            for part in text_slices(batch, "_text", p.slice_bytes):
                ids, n = tokens(part.column("_text"))
                rows, at = [], 0
                for row, k in enumerate(n.tolist()):
                    own = ids[at:at + k].tobytes() + end
                    at += k
                    for piece, a in enumerate(range(0, len(own), step)):
                        b = own[a:a + step]
                        rows.append((row, piece, a // 4, len(b) // 4, zlib.crc32(b),
                                     *([b] if with_ids else [])))
                row, *rest = zip(*rows, strict=True)
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(pa.array(row, pa.int64())),
                     *(pa.array(c, t) for c, t in zip(rest, types, strict=False))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, p: Packing = Packing()) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``.  ``pieces`` is read twice, so pass a
    written table."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    plan, _ = plan_lengths(counts, p)
    buckets = max(1, -(-sum(counts.values()) // p.bucket_rows))
    rest = [c for c in pieces.columns if c not in ("length", "ids")]
    x = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*rest), F.lit(buckets)))
    sizes = x.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0))
                         .alias("_before"))
    own = Window.partitionBy("length", "_bucket").orderBy(*rest)
    x = x.withColumn("_own", F.row_number().over(own)).join(sizes, ["length", "_bucket"])
    x = x.withColumn("_rank", F.col("_before") + F.col("_own") - 1).drop("_before", "_own", "_bucket")

    shift = np.int64(1) << np.int64(48)
    table = spark.sparkContext.broadcast((
        (plan["length"] * shift + plan["rank"]).to_numpy(), plan["rank"].to_numpy(),
        plan["sequence"].to_numpy(), plan["offset"].to_numpy()))
    cols = [c for c in pieces.columns]
    types = {f.name: f.dataType.simpleString() for f in pieces.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in cols) + ", sequence_id long, offset long"

    def place(batches):
        keys, ranks, sequences, offsets = table.value
        for b in batches:
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            key = b.column("length").to_numpy(zero_copy_only=False) * shift + rank
            at = np.searchsorted(keys, key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in cols), pa.array(sequences[at] + rank - ranks[at]),
                 pa.array(offsets[at])], names=[*cols, "sequence_id", "offset"])
    return x.select(*cols, "_rank").mapInArrow(place, schema)


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   p: Packing = Packing(), path: str = TOKENIZER) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(tokenized_pieces(df, id_col, text_col, p, path), "pieces")
    return pack_pieces(pieces, p)


def packed_sequences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     p: Packing = Packing(), path: str = TOKENIZER) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ``ids`` (little-endian
    bytes), doc_ids and starts by offset.  A sequence has ``capacity`` tokens
    at most, which bounds its group."""
    pieces = materialize(tokenized_pieces(df, id_col, text_col, p, path, True), "pieces")
    placed = pack_pieces(pieces, p)
    one = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    x = placed.groupBy("sequence_id").agg(one.alias("_p"))
    return x.select(
        "sequence_id",
        F.aggregate("_p", F.lit(0).cast("long"), lambda a, q: a + q["length"]).alias("n_tokens"),
        F.aggregate("_p", F.lit(b""), lambda a, q: F.concat(a, q["ids"])).alias("ids"),
        F.col("_p.doc_id").alias("doc_ids"), F.col("_p.offset").alias("starts"))
