"""Interpolated modified Kneser-Ney n-gram model of any order: counted in Spark,
stored as sorted arrays, memory-mapped by the workers that score texts.

1. Words: each task counts the words of its texts; counts meet in shards by word
   hash, which are stored as sorted hash arrays.  A word's place in them is its id.
2. Level by level up to ``Training.order``: a gram of k words is the pair of the
   places of its two grams of k - 1 words, one number of at most 64 bits, spread
   by a bijection (so equal numbers are equal grams).  Tasks send packed counts to
   shards by that number; a shard stores its sorted array, whose places are what
   the next level is made of.
3. From the highest level down: a shard tells, per place of the level below, how
   often and with how many successors it is a context, and how many predecessors
   it has.  Those meet in shards by place and are stored as arrays in that order;
   the predecessors are the counts of the level below.
4. Scoring maps the files and looks up each slice's distinct words and grams.

The model's files lie in the shared folder (``spark.checkpoint.dir``), which for
this operator has to be mounted on all machines (a ``file:`` path): mapping needs
a file.  A shard's file is written beside and renamed, so a task that runs twice
leaves the same file.  Places take 32 bits: up to 4 billion distinct words, and
as many grams of every length but the longest; more are refused.

Counts: a text is a begin mark (a context only), its words, and an end mark,
which is a token.  The highest level counts occurrences, the lower ones distinct
predecessors; a gram that starts with the begin mark has none and keeps its
occurrences.  Discounts for counts 1, 2 and 3 or more come from the numbers of
grams with counts 1 to 4, on each level; the lowest level interpolates with
1 / (V + 1), the last share being that of all unknown words.

Defined cases: a null or empty text is its end mark; a null id counts as the
text ""; repeated rows are counted and scored one by one; without any training
text every token is unknown; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludeme.llm.text import hash_words, split_words, text_slices
from ludeme.plans.session import scratch_path, shuffle_partitions

END = hash_words(["\n"])[0]  # no word holds a line end


@dataclass(frozen=True)
class Training:
    order: int = 3               # words of the longest grams
    folds: int = 7
    held_out: int = 2            # texts of this fold are not learned from
    slice_bytes: int = 8 << 20   # of text, counted at once; scored in halves


def held_out(id_col: Column, t: Training = Training()) -> Column:
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % t.folds == t.held_out


# ------------------------------------------------------------------ files

def _folder(spark) -> str:
    url = urlparse(scratch_path(spark, "kn"))
    if url.scheme not in ("", "file"):
        raise ValueError("the model's files are memory-mapped: spark.checkpoint.dir has to be a "
                         f"folder that is mounted on all machines, not {url.scheme}:")
    os.makedirs(url.path, exist_ok=True)
    return url.path


def _write(folder: str, name: str, array: np.ndarray) -> None:
    beside = f"{folder}/.{name}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(beside, "wb") as f:
        np.save(f, array)
    os.replace(beside, f"{folder}/{name}.npy")


def _map(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def _narrow(n: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them."""
    most = int(n.max(initial=0))
    return n.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4"
                    if most < 1 << 32 else "<u8")


def _write_counts(folder: str, name: str, n: np.ndarray) -> None:
    """A byte each; where 255 stands, the count is in the short list beside."""
    large = np.flatnonzero(n >= 255)
    _write(folder, f"{name}-large", np.stack([large, n[large]]).astype("<i8"))
    _write(folder, name, np.minimum(n, 255).astype("u1"))


def _counts(folder: str, name: str, at: np.ndarray | slice) -> np.ndarray:
    n = _map(folder, name)[at].astype(np.int64)
    large = np.flatnonzero(n == 255)
    if len(large):
        places, counts = _map(folder, f"{name}-large")
        n[large] = counts[np.searchsorted(places, large if isinstance(at, slice) else at[large])]
    return n


def _coded(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a table given by columns, and each row's place among them."""
    code, bits = np.zeros(columns.shape[1], np.uint64), 0
    for c in columns:
        more = int(c.max(initial=0)).bit_length()
        if bits + more > 64:
            code = np.unique(code, return_inverse=True)[1].astype(np.uint64)
            bits = len(code).bit_length()
        code, bits = (code << np.uint64(more)) | c.astype(np.uint64), bits + more
    _, first, back = np.unique(code, return_index=True, return_inverse=True)
    return columns[:, first], back


def _planes(x: np.ndarray) -> tuple[int, bytes]:
    """Numbers byte by byte, as many bytes as the largest one needs."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return width, x.astype("<u8").view("u1").reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(b: bytes, k: int, width: int, at: int) -> np.ndarray:
    out = np.zeros((k, 8), "u1")
    out[:, :width] = np.frombuffer(b, "u1", k * width, at).reshape(width, k).T
    return out.view("<u8").ravel()


def _pack(h: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted distinct numbers, as differences, and their counts."""
    h = h.astype(np.uint64)
    (wide, gaps), (high, counts) = _planes(np.diff(h, prepend=h[:1])), _planes(n)
    return struct.pack("<QQBB", len(h), int(h[0]), wide, high) + gaps + counts


HEAD = struct.calcsize("<QQBB")


def _unpack_one(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    k, first, wide, high = struct.unpack_from("<QQBB", b)
    h = np.cumsum(_numbers(b, k, wide, HEAD), dtype=np.uint64) + np.uint64(first)
    return h, _numbers(b, k, high, HEAD + k * wide).astype(np.int64)


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hs, ns = zip(*map(_unpack_one, blobs), strict=True)
    return _summed(np.concatenate(hs), np.concatenate(ns))


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
    return h[first], np.add.reduceat(n, first) if len(h) else n


def _by_shard(h: np.ndarray, n: np.ndarray, shards: int, bits: int = 64) -> list[tuple[int, bytes]]:
    """(shard, packed) of sorted numbers of ``bits``; shards are ranges of them."""
    cuts = np.searchsorted(h, _bounds(shards, bits))
    ends = np.append(cuts[1:], len(h))
    return [(s, _pack(h[a:z], n[a:z])) for s, (a, z) in enumerate(zip(cuts, ends, strict=True))
            if z > a]


def _bounds(shards: int, bits: int = 64) -> np.ndarray:
    return np.array([(s << bits) // shards for s in range(shards)], dtype=np.uint64)


ODD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _spread(h: np.ndarray, half: int, back: bool = False) -> np.ndarray:
    """A bijection of numbers of 2 * ``half`` bits that spreads them evenly, or its inverse."""
    by, mask = np.uint64(half), np.uint64((1 << 2 * half) - 1)
    odd = [pow(x, -1, 1 << 64) for x in reversed(ODD)] if back else ODD
    h = h ^ (h >> by)
    for x in odd:
        h = (h * np.uint64(x)) & mask
        h = h ^ (h >> by)
    return h


def _store_grams(folder: str, level: int, shard: int, h: np.ndarray, bound: int) -> None:
    """Sorted numbers as their low 32 bits and where each run of equal high bits starts."""
    r = h - np.uint64(bound)
    high = (r >> np.uint64(32)).astype(np.int64)
    runs = np.searchsorted(high, np.arange(high[-1] + 2))
    _write(folder, f"gram{level}-{shard}", r.astype("<u4"))
    _write(folder, f"gram{level}-runs-{shard}", runs.astype("<u4"))


def _load_grams(folder: str, level: int, shard: int, bound: int) -> np.ndarray:
    runs = _map(folder, f"gram{level}-runs-{shard}").astype(np.int64)
    high = np.repeat(np.arange(len(runs) - 1, dtype=np.uint64), np.diff(runs))
    return (high << np.uint64(32)) + _map(folder, f"gram{level}-{shard}") + np.uint64(bound)


def _find_grams(folder: str, level: int, shard: int, h: np.ndarray, bound: int) -> np.ndarray:
    """Places of numbers in a shard's array, -1 where they are not in it."""
    low, runs = _map(folder, f"gram{level}-{shard}"), _map(folder, f"gram{level}-runs-{shard}")
    r = h - np.uint64(bound)
    high, r = (r >> np.uint64(32)).astype(np.int64), r.astype("<u4")
    out = np.full(len(h), -1, np.int64)
    ask = high < len(runs) - 1
    high, r = high[ask], r[ask]
    at, end = runs[high].astype(np.int64), runs[high + 1].astype(np.int64)
    stop = end
    for _ in range(int((end - at).max(initial=0)).bit_length()):
        mid = (at + end) >> 1
        less = (at < end) & (low[np.minimum(mid, len(low) - 1)] < r)
        at, end = np.where(less, mid + 1, at), np.where(less, end, mid)
    found = at < stop
    found[found] = low[at[found]] == r[found]
    out[np.flatnonzero(ask)[found]] = at[found]
    return out


def _shipped(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([s for s, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())],
        names=["shard", "blob"])


# ------------------------------------------------------------------ the model

@dataclass
class Model:
    folder: str
    shards: int
    order: int = 2
    sizes: list[np.ndarray] = field(default_factory=list)   # grams by shard, from words on
    tokens: int = 0                                     # N
    #: By level from 1: discounts of the counts 0, 1, 2, 3+.
    discounts: dict[int, tuple[float, ...]] = field(default_factory=dict)
    pairs: int = 0                                      # predecessors of all words
    left_over: float = 1.0                              # lowest level's mass for 1 / (V + 1)

    @property
    def vocabulary(self) -> int:
        return int(self.sizes[0].sum()) if self.sizes else 0

    def places(self, level: int) -> int:
        """Grams of ``level``; among the words the begin mark, which comes last."""
        return int(self.sizes[level - 1].sum()) + (level == 1)

    def half(self, level: int) -> int:
        """Bits of each of the two places that a gram of ``level`` is made of."""
        n = self.places(level - 1)
        if n >= 1 << 32:
            raise ValueError(f"{n} distinct grams of {level - 1} words: places take 32 bits")
        return max(1, n.bit_length())

    def place_shards(self, level: int) -> tuple[int, int]:
        """Places of a shard of context arrays, and such shards."""
        per = max(1, -(-self.places(level) // self.shards))
        return per, -(-self.places(level) // per)

    def look_up(self, level: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the stored order (-1: not there) and count of sorted words' hashes or
        grams' numbers."""
        place, count = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        if len(self.sizes) < level or not len(h):
            return place, count
        offset = np.cumsum(self.sizes[level - 1]) - self.sizes[level - 1]
        bounds = _bounds(self.shards, 2 * self.half(level) if level > 1 else 64)
        cuts = np.append(np.searchsorted(h, bounds), len(h))
        for s in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[s], cuts[s + 1])
            try:
                if level > 1:
                    at = _find_grams(self.folder, level, s, h[part], int(bounds[s]))
                    found = at >= 0
                else:
                    keys = _map(self.folder, f"word-{s}")
                    at = np.searchsorted(keys, h[part])
                    found = at < len(keys)
                    found[found] = keys[at[found]] == h[part][found]
            except FileNotFoundError:  # a shard without any
                continue
            place[part][found] = at[found] + offset[s]
            if level == 1 or level in self.discounts:  # trained
                count[part][found] = _counts(self.folder, f"count{level}-{s}", at[found])
        return place, count

    def grams(self, level: int, place: np.ndarray, first: np.ndarray):
        """Of the tokens, with the places of the grams of ``level`` - 1 that end there: which have
        a gram before too, and with it their distinct numbers with the way back."""
        start = self.vocabulary if level == 2 else -1
        left = np.append(start, place[:-1])
        left[first] = start
        return self.paired(level, left, place)

    def paired(self, level: int, left: np.ndarray, place: np.ndarray):
        """Which pairs of places are both known, their distinct numbers as grams of ``level`` and
        the way back."""
        ask = (left >= 0) & (place >= 0)
        half = self.half(level)
        h = _spread((left[ask].astype(np.uint64) << np.uint64(half))
                    | place[ask].astype(np.uint64), half)
        return ask, *np.unique(h, return_inverse=True)

    def contexts(self, level: int, places: np.ndarray) -> np.ndarray:
        """Rows (total, N1, N2, N3+, predecessors) of sorted places of ``level``."""
        out = np.zeros((len(places), 5), np.int64)
        if not self.tokens:
            return out
        per, n = self.place_shards(level)
        cuts = np.append(np.searchsorted(places, np.arange(n) * per), len(places))
        for s in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[s], cuts[s + 1])
            try:
                code = _map(self.folder, f"context{level}-{s}")[places[part] - s * per]
            except FileNotFoundError:  # a shard without any
                continue
            out[part] = _map(self.folder, f"context{level}-rows-{s}").T[code]
        return out

    def base_log(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.vocabulary + 1))

    def lower_probability(self, predecessors: np.ndarray) -> np.ndarray:
        d = np.array(self.discounts.get(1, (0.0,) * 4))[np.minimum(predecessors, 3)]
        own = (predecessors - d) / self.pairs if self.pairs else np.zeros(len(predecessors))
        return own + self.left_over / (self.vocabulary + 1)


def _discounts(n: list[int]) -> tuple[float, ...]:
    """Discounts for counts 0, 1, 2, 3+ from the numbers with counts 1 to 4,
    within [0, count]; where one of them is 0 the usual formula has no value and
    half a count is taken off."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return 0.0, 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return 0.0, *(min(max(d, 0.05), k) for k, d in enumerate(raw, 1))


def _count_of_counts(n: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(n, 5), minlength=6)[1:5].tolist()


def _sequences(part: pa.RecordBatch):
    """Of a slice: where each text starts in the tokens, and the tokens' hash
    codes into sorted distinct hashes (the end mark after each text)."""
    starts, codes, words = split_words(part.column("_text"))
    h, back = np.unique(np.append(hash_words(words), END), return_inverse=True)
    n = np.diff(starts) + 1
    ends = np.cumsum(n)
    tokens = np.empty(ends[-1] if len(ends) else 0, np.int64)
    last = np.zeros(len(tokens), bool)
    last[ends - 1] = True
    tokens[last] = back[-1]
    tokens[~last] = back[codes]
    return ends - n, n, tokens, h


def train(texts: DataFrame, text_col: str = "text", t: Training = Training()) -> Model:
    """The model of all ``texts``."""
    if t.order < 2:
        raise ValueError("the order is at least 2")
    spark = texts.sparkSession
    m = Model(_folder(spark), shuffle_partitions(spark), t.order)
    folder, shards = m.folder, m.shards
    source = texts.select(F.col(text_col).alias("_text"))

    def count_words(batches):
        for b in batches:
            for part in text_slices(b, "_text", t.slice_bytes):
                _, _, tokens, h = _sequences(part)
                yield _shipped(_by_shard(h, np.bincount(tokens, minlength=len(h)), shards))

    def store_words(g: pa.Table) -> pa.Table:
        s = g.column("shard")[0].as_py()
        h, n = _unpack(g.column("blob").to_pylist())
        h, n = h[n > 0], n[n > 0]  # the end mark comes along with every slice
        _write(folder, f"word-{s}", h)
        _write_counts(folder, f"count1-{s}", n)
        return pa.table({"shard": [s], "words": [len(h)], "tokens": [int(n.sum())]})
    m.sizes = [np.zeros(shards, np.int64)]
    for r in source.mapInArrow(count_words, "shard long, blob binary").groupBy("shard") \
            .applyInArrow(store_words, "shard long, words long, tokens long").collect():
        m.sizes[0][r["shard"]] = r["words"]
        m.tokens += r["tokens"]
    if not m.tokens:
        return m
    for level in range(2, t.order):
        sizes = np.zeros(shards, np.int64)
        for r in _counted(source, m, level, t).groupBy("shard").applyInArrow(
                _keep(m, level), "shard long, grams long").collect():
            sizes[r["shard"]] = r["grams"]
        m.sizes.append(sizes)
    told = "shard long, kind int, blob binary"
    stats = _counted(source, m, t.order, t).groupBy("shard").applyInArrow(
        _keep(m, t.order, tell=True), told)
    for level in range(t.order, 1, -1):
        if level < t.order:
            stats = spark.range(0, shards, 1, shards).mapInArrow(_adjust(m, level), told)
        got = {r["what"]: r["n"] for r in stats.groupBy("shard").applyInArrow(
            _store_contexts(m, level), "what string, n array<long>").groupBy("what").agg(F.array(
                *(F.sum(F.coalesce(F.get("n", F.lit(i)), F.lit(0))) for i in range(6))).alias("n"))
            .collect()}
        m.discounts[level] = _discounts(got.get("grams", [0] * 4)[:4])
    n1, n2, _, _, more, m.pairs = got["below"]
    d = m.discounts[1] = _discounts(got["below"][:4])
    m.left_over = (d[1] * n1 + d[2] * n2 + d[3] * more) / m.pairs
    m.sizes.append(np.zeros(shards, np.int64))  # nothing is made of the longest grams' places
    return m


def _counted(source: DataFrame, m: Model, level: int, t: Training) -> DataFrame:
    """(shard, packed) counts of the grams of ``level``."""
    def run(batches):
        for b in batches:
            for part in text_slices(b, "_text", t.slice_bytes):
                first, _, tokens, h = _sequences(part)
                place = m.look_up(1, h)[0][tokens]
                for k in range(2, level):
                    ask, keys, back = m.grams(k, place, first)
                    place = np.full(len(place), -1, np.int64)
                    place[ask] = m.look_up(k, keys)[0][back]
                _, keys, back = m.grams(level, place, first)
                yield _shipped(_by_shard(keys, np.bincount(back, minlength=len(keys)), m.shards,
                                         2 * m.half(level)))
    return source.mapInArrow(run, "shard long, blob binary")


def _keep(m: Model, level: int, tell: bool = False):
    """Stores a shard of grams; returns their number or what :func:`_told` tells of them."""
    def run(g: pa.Table) -> pa.Table:
        s = g.column("shard")[0].as_py()
        h, n = _unpack(g.column("blob").to_pylist())
        _store_grams(m.folder, level, s, h, _bound(m, level, s))
        _write_counts(m.folder, f"{'count' if tell else 'raw'}{level}-{s}", n)
        if tell:
            return _told(m, level, h, n)
        return pa.table({"shard": [s], "grams": [len(h)]})
    return run


def _bound(m: Model, level: int, shard: int) -> int:
    return (shard << 2 * m.half(level)) // m.shards


def _adjust(m: Model, level: int):
    """Counts of a shard's grams below the highest level: distinct predecessors."""
    def run(batches):
        offset = np.cumsum(m.sizes[level - 1]) - m.sizes[level - 1]
        for b in batches:
            for s in b.column(0).to_pylist():
                size = int(m.sizes[level - 1][s])
                if not size:
                    continue
                n = m.contexts(level, offset[s] + np.arange(size))[:, 4]
                n = np.where(n > 0, n, _counts(m.folder, f"raw{level}-{s}", slice(None)))
                _write_counts(m.folder, f"count{level}-{s}", n)
                h = _load_grams(m.folder, level, s, _bound(m, level, s))
                yield from _told(m, level, h, n).to_batches()
    return run


def _told(m: Model, level: int, h: np.ndarray, n: np.ndarray) -> pa.Table:
    """Of grams and their counts, packed sums by the place of the context (by class of the
    count) and of the gram without its first word (predecessors)."""
    half = m.half(level)
    per, _ = m.place_shards(level - 1)
    keys = _spread(h, half, back=True)
    left = (keys >> np.uint64(half)).astype(np.int64)
    right = (keys & np.uint64((1 << half) - 1)).astype(np.int64)
    rows = []
    for kind, (ids, count) in enumerate([
            (left[n > 2], n[n > 2]), (left[n == 1], None), (left[n == 2], None),
            (left[n > 2], None), (right, None)]):
        ids, count = _summed(ids, np.ones(len(ids), np.int64) if count is None else count)
        cuts = (np.flatnonzero(np.diff(ids // per)) + 1).tolist() if len(ids) else []
        rows += [(int(ids[a] // per), kind, _pack(ids[a:z] % per, count[a:z]))
                 for a, z in zip([0, *cuts], [*cuts, len(ids)], strict=True) if z > a]
    rows.append((-1, 0, np.array(_count_of_counts(n), "<i8").tobytes()))
    shard, kind, blob = zip(*rows, strict=True)
    return pa.table({"shard": pa.array(shard, pa.int64()), "kind": pa.array(kind, pa.int32()),
                     "blob": pa.array(blob, pa.binary())})


def _store_contexts(m: Model, level: int):
    """Stores what the grams of ``level`` told of the places below it."""
    per, _ = m.place_shards(level - 1)

    def run(g: pa.Table) -> pa.Table:
        s = g.column("shard")[0].as_py()
        if s < 0:  # a shard's numbers of grams with counts 1 to 4: pass the sum on
            total = sum(np.frombuffer(b, "<i8") for b in g.column("blob").to_pylist())
            return pa.table({"what": ["grams"], "n": [total.tolist()]})
        out = np.zeros((5, per), np.int64)
        for kind, b in zip(g.column("kind").to_pylist(), g.column("blob").to_pylist(), strict=True):
            ids, count = _unpack_one(b)
            out[kind][ids.astype(np.int64)] += count
        out[0] += out[1] + 2 * out[2]
        rows, code = _coded(out)
        _write(m.folder, f"context{level - 1}-rows-{s}", _narrow(rows))
        _write(m.folder, f"context{level - 1}-{s}", _narrow(code))
        p = out[4]
        return pa.table({"what": ["below"], "n": [[*_count_of_counts(p), int((p > 2).sum()),
                                                   int(p.sum())]]})
    return run


def _context_rows(m: Model, level: int, place: np.ndarray) -> np.ndarray:
    """Columns (total, N1, N2, N3+, predecessors) of places in order, -1 having none; and a last
    column of none, which the index -1 finds."""
    out = np.zeros((5, len(place) + 1), np.int64)
    known = np.flatnonzero(place >= 0)
    out[:, known] = m.contexts(level, place[known]).T
    return out


def _score_slice(part: pa.RecordBatch, m: Model):
    first, n, tokens, h = _sequences(part)
    word, count = m.look_up(1, h)
    known = (word >= 0)[tokens]
    base = m.base_log(count)[tokens]
    # Of each level, the slice's distinct grams: their places and what they are as contexts; and
    # which of them ends at each token (-1: none).  Words come in order of their places, as do
    # grams; the begin mark comes last.
    places = np.append(word, m.vocabulary)
    rows = _context_rows(m, 1, places)
    own = tokens
    p = m.lower_probability(rows[4, own])
    for level in range(2, m.order + 1 if m.tokens else 2):
        before = np.append(-1, own[:-1])
        before[first] = len(word) if level == 2 else -1
        total, n1, n2, n3 = rows[:4, before]
        known_places = np.append(places, -1)
        ask, keys, back = m.paired(level, known_places[before], known_places[own])
        found, counts = m.look_up(level, keys)
        number = np.zeros(len(p), np.int64)
        number[ask] = counts[back]
        d = np.array(m.discounts[level])
        some = np.maximum(total, 1)
        rest = (d[1] * n1 + d[2] * n2 + d[3] * n3) / some
        p = np.where(total > 0, (number - d[np.minimum(number, 3)]) / some + rest * p, p)
        if level < m.order:
            places, rows = found, _context_rows(m, level, found)
            own = np.full(len(p), -1, np.int64)
            own[ask] = np.where(found >= 0, np.arange(len(found)), -1)[back]
    score = np.log10(p)

    def per_text(x):
        return np.add.reduceat(x, first) if len(first) else np.zeros(0)
    return n, per_text(known.astype(np.int64)), per_text(base), per_text(score)


def score(df: DataFrame, m: Model, id_col: str = "doc_id", text_col: str = "text",
          t: Training = Training()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    perplexity (10 to the -score / n_tokens) of every text."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for part in text_slices(b, "_text", t.slice_bytes // 2):
                n, known, base, full = _score_slice(part, m)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("held_out"), pa.array(n, pa.int64()),
                     pa.array(known, pa.int64()), pa.array(np.full(len(n), m.tokens), pa.int64()),
                     pa.array(base, pa.float64()), pa.array(full, pa.float64()),
                     pa.array(10 ** (-full / n), pa.float64())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score", "perplexity"])
    return df.select(F.col(id_col).alias("_id"), held_out(F.col(id_col), t).alias("held_out"),
                     F.col(text_col).alias("_text")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double, perplexity double")


def fit_and_score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  t: Training = Training()) -> DataFrame:
    """Learns from all texts outside the held-out fold and scores all texts."""
    m = train(df.filter(~held_out(F.col(id_col), t)), text_col, t)
    return score(df, m, id_col, text_col, t)
