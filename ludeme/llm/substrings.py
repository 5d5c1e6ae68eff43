"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``Repeats.words`` consecutive words of a document.  Words covered by a
window whose words also start in a document with a smaller id are removed.

1. Suffixes that hang alone need no tree.  Every window holds, of the grams of
   ``gram`` words in it, the one with the smallest hash; equal windows hold equal
   ones.  Slices of texts send these hashes, each once, to shards, which tell each
   slice which of its own occur in several documents.  A suffix whose window holds
   none of those is unique; documents without others are finished.  Words are
   numbered on the way, so that equal words of all slices have one number.
2. What is left is planned: suffixes are counted by their first word; prefixes with
   more than ``group`` suffixes are made longer (``lengths``), until each group of
   suffixes with one prefix fits into memory, or the prefix is the whole window.
3. A slice sends its suffixes, equal windows once with their smallest document, to
   the group of their prefix (small prefixes share a group).  So a window that any
   number of copies hold enters a tree once per slice.
4. A group sorts its suffixes by words; neighbours' common prefixes are the inner
   nodes of its subtree, which is cut at the window's length, as what lies deeper is
   told by the suffixes that start later.  A deep node's leaves are one repeat; those
   with a larger document than the node's smallest are told so.
5. Slices mark the windows and join the ranges they cover into the removed spans, which
   are the maximal repeats within the document.

Words are told apart by 64 bits of their hash.  The first step's hashes take as many bits as
their number needs, since what is let through by chance ends in the trees.

Defined cases: a null or empty text has no words; a document shorter than a window
loses nothing; rows of equal id are compared with other ids only, so none removes
from another; a row with a null id neither removes nor loses words; an empty table
gives an empty result; other columns are ignored.  Ids are integers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.llm.text import hash_words, mix, quoted, split_words, text_slices, words_of
from ludeme.plans.session import materialize, shuffle_partitions

ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Repeats:
    words: int = 13
    gram: int = 8                # words of the grams of the first step, less than ``words``
    lengths: tuple[int, ...] = (1, 2, 4, 8)   # of prefixes, before the whole window
    group: int = 500_000         # suffixes of a prefix that are one group
    most_long: int = 1 << 20     # prefixes made longer, per length: ``group`` grows before
    slice_bytes: int = 8 << 20   # text that a task holds at once
    shard_bytes: int = 16 << 20


# ------------------------------------------------------------------ slices

def _planes(x: np.ndarray) -> np.ndarray:
    """Numbers byte by byte, all lowest bytes first: they compress better so."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return x.astype("<u8").view("u1").reshape(-1, 8)[:, :width].T.ravel()


def _numbers(planes: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, 8), "u1")
    out[:, :len(planes) // max(n, 1)] = planes.reshape(-1, n).T if n else 0
    return out.view("<u8").ravel().astype(np.int64)


def _pack(**columns) -> bytes:
    """Arrays of any lengths as one row of lists."""
    arrays = [pa.array(c) if not isinstance(c, (pa.Array, pa.ChunkedArray)) else c
              for c in columns.values()]
    row = pa.RecordBatch.from_arrays(
        [pa.LargeListArray.from_arrays([0, len(a)], a) for a in arrays], names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema,
                           options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(row)
    return sink.getvalue().to_pybytes()


def _open(blob: bytes) -> dict[str, pa.Array]:
    t = pa.ipc.open_stream(blob).read_next_batch()
    return {n: t.column(n).flatten() for n in t.schema.names}


def _rows(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)],
        names=[n for n, _ in schema])


class Tokens:
    """Texts as words: ids, where each text starts, codes into distinct words, and the numbers
    that these words have in all slices, if they are known."""

    def __init__(self, ids: pa.Array, starts: np.ndarray, codes: np.ndarray, words: pa.Array,
                 numbers: np.ndarray | None = None):
        self.ids, self.starts, self.codes, self.words = ids, starts, codes, words
        self.numbers = numbers

    @classmethod
    def of(cls, part: pa.RecordBatch) -> Tokens:
        """Frequent words get the small codes."""
        starts, codes, words = split_words(part.column("_text"), lower=False)
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return cls(part.column("_id"), starts, rank[codes] if len(rank) else codes,
                   pa.array(words, pa.string()).take(pa.array(order)))

    @classmethod
    def opened(cls, c: dict[str, pa.Array]) -> Tokens:
        starts = np.append(0, np.cumsum(_numbers(c["sizes"].to_numpy(), len(c["ids"]))))
        numbers = _numbers(c["numbers"].to_numpy(), len(c["words"])) if "numbers" in c else None
        return cls(c["ids"], starts, _numbers(c["codes"].to_numpy(), int(starts[-1])), c["words"],
                   numbers)

    def packed(self, **more) -> bytes:
        if self.numbers is not None:
            more["numbers"] = _planes(self.numbers)
        return _pack(ids=self.ids.cast(pa.int64()), sizes=_planes(np.diff(self.starts)),
                     codes=_planes(self.codes), words=self.words, **more)

    def hashes(self) -> np.ndarray:
        """Of the distinct words."""
        return hash_words(self.words.to_pylist())

    def only(self, rows: np.ndarray) -> Tokens:
        """The texts at ``rows``."""
        n = np.diff(self.starts)
        keep = np.repeat(np.isin(np.arange(len(n)), rows), n)
        used, codes = np.unique(self.codes[keep], return_inverse=True)
        return Tokens(self.ids.take(pa.array(rows)), np.append(0, np.cumsum(n[rows])), codes,
                      self.words.take(pa.array(used)),
                      None if self.numbers is None else self.numbers[used])

    def texts(self, keep: np.ndarray | None = None) -> list[str]:
        """The words, or those to keep, joined by one space."""
        starts, codes = self.starts, self.codes
        if keep is not None:
            starts, codes = np.append(0, np.cumsum(keep))[starts], codes[keep]
        flat = self.words.take(pa.array(codes))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), flat),
                              " ").to_pylist()

    def text_of(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def whole(self, words: int) -> np.ndarray:
        """Whether a window that starts at a word ends in its text (one with an id)."""
        n = len(self.codes) - words + 1
        if n <= 0:
            return np.zeros(0, bool)
        of = self.text_of()
        known = pc.is_valid(self.ids).to_numpy(zero_copy_only=False)
        return (of[:n] == of[words - 1:]) & known[of[:n]]


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(a * ODD + b)


def rolled(h: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of ``words`` words, by doubling."""
    out, have = h, 1
    while have < words:
        step = min(have, words - have)
        out = combined(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    out, have = x, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


@dataclass(frozen=True)
class Marks:
    """Which shard a mark goes to, and how many of its bits are kept there."""
    shards: int
    bits: int

    @classmethod
    def of(cls, text_bytes: int, parts: int, r: Repeats) -> Marks:
        number = max(1, text_bytes // 20)
        shards = int(min(1 << 16, max(parts, -(-8 * number // r.shard_bytes))))
        return cls(shards, min(47, max(16, (number // shards).bit_length() + 12)))

    def place(self, h: np.ndarray, r: Repeats) -> tuple[np.ndarray, np.ndarray]:
        """Per window the smallest of its grams' hashes: shard and kept bits."""
        with np.errstate(over="ignore"):
            m = mix(sliding_least(rolled(h, r.gram), r.words - r.gram + 1))
        shard = ((m >> np.uint64(48)) * np.uint64(self.shards)) >> np.uint64(16)
        return shard, m & np.uint64((1 << self.bits) - 1)

    def joined(self, shard, kept) -> np.ndarray:
        return (np.asarray(shard, np.uint64) << np.uint64(self.bits)) | kept.astype(np.uint64)

    @property
    def kind(self) -> str:
        return "<u4" if self.bits < 32 else "<u8"


def _word_shards(h: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """Per shard of words the codes that belong there."""
    if not len(h):
        return []
    shard = ((h >> np.uint64(48)) * np.uint64(shards)) >> np.uint64(16)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order].astype(np.int64))) + 1
    return [(int(shard[some[0]]), some) for some in np.split(order, cuts)]


WORDS = 1 << 20    # keys from here on are shards of words
PACKED = [("key", pa.int64()), ("slice", pa.int64()), ("blob", pa.binary())]


def _sliced(df: DataFrame, id_col: str, text_col: str, r: Repeats, marks: Marks) -> DataFrame:
    """(key, slice, blob): marks by shard, hashes of words by shard, and under negative keys the
    slices' texts.  A mark's lowest bit tells that several documents of the slice hold it."""
    def one(t: Tokens, own: int) -> pa.RecordBatch:
        rows = [(-1 - own, own, t.packed())]
        h = t.hashes()
        rows += [(WORDS + shard, own, h[some].tobytes()) for shard, some in _word_shards(h, marks.shards)]
        start = np.flatnonzero(t.whole(r.words))
        if len(start):
            mark, of = marks.joined(*marks.place(h[t.codes], r))[start], t.text_of()[start]
            new = np.append(True, (mark[1:] != mark[:-1]) | (of[1:] != of[:-1]))
            mark, of = mark[new], of[new]
            order = np.argsort(mark, kind="stable")
            mark, of = mark[order], of[order]
            first = np.flatnonzero(np.append(True, mark[1:] != mark[:-1]))
            last = np.append(first[1:], len(mark)) - 1
            shard = (mark[first] >> np.uint64(marks.bits)).astype(np.int64)
            kept = (mark[first] & np.uint64((1 << marks.bits) - 1)) << np.uint64(1)
            kept = (kept | (of[first] != of[last]).astype(np.uint64)).astype(marks.kind)
            cuts = np.flatnonzero(np.diff(shard)) + 1
            rows += [(int(shard[a]), own, kept[a:z].tobytes())
                     for a, z in zip([0, *cuts], [*cuts, len(kept)], strict=True)]
        return _rows(PACKED, rows)

    def emit(batches):
        own = TaskContext.get().partitionId() << 32
        for b in batches:
            for part in text_slices(b, "_text", r.slice_bytes):
                yield one(Tokens.of(part), own)
                own += 1
    return df.select(quoted(id_col).cast("long").alias("_id"), quoted(text_col).alias("_text")) \
        .mapInArrow(emit, "key long, slice long, blob binary")


TOLD = [("slice", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())]
TOLD_DDL = "slice long, kind int, blob binary"


def _numbered(own: list[int], blobs: list[bytes], shard: int, shards: int) -> list[tuple]:
    """To each slice the numbers of its words of a shard: the more slices, the smaller."""
    found = [np.frombuffer(b, "<u8") for b in blobs]
    words, back, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    number = np.empty(len(words), np.int64)
    number[np.lexsort((words, -n))] = np.arange(len(words)) * shards + shard
    head, number, rows, at = np.array([shard], "<u8").tobytes(), number[back], [], 0
    for s, f in zip(own, found, strict=True):
        rows.append((s, 3, head + _planes(number[at:at + len(f)]).tobytes()))
        at += len(f)
    return rows


def _several(marks: Marks):
    """Of a shard: to each slice, those of its marks that several documents hold; of a shard of
    words, their numbers."""
    def run(t: pa.Table) -> pa.Table:
        own, blobs = t.column("slice").to_pylist(), t.column("blob").to_pylist()
        shard = t.column("key")[0].as_py()
        if shard < 0:
            rows = [(s, 0, b) for s, b in zip(own, blobs, strict=True)]
            return pa.Table.from_batches([_rows(TOLD, rows)])
        if shard >= WORDS:
            rows = _numbered(own, blobs, shard - WORDS, marks.shards)
            return pa.Table.from_batches([_rows(TOLD, rows)])
        one = np.array(1, marks.kind)
        found = [np.frombuffer(b, marks.kind) for b in blobs]
        every = np.sort(np.concatenate([m >> one for m in found]))
        twice = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]],
                                          *((m >> one)[(m & one) > 0] for m in found)]))
        head = np.array([shard], "<u8").tobytes()
        rows = []
        for s, m in zip(own, found, strict=True):
            m = (m >> one)[_among(m >> one, twice)]
            if len(m):
                rows.append((s, 1, head + m.tobytes()))
        return pa.Table.from_batches([_rows(TOLD, rows)])
    return run


def _among(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Whether each is one of ``some`` (sorted)."""
    if not len(some):
        return np.zeros(len(x), bool)
    return some[np.minimum(np.searchsorted(some, x), len(some) - 1)] == x


OUT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
       ("kept_sha256", pa.string()),
       ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))]
OUT_DDL = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
           "spans array<struct<from:long,to:long>>")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _left_over(r: Repeats, marks: Marks):
    """Of a slice: the texts with windows that may be repeats (kind 0), with a mark for each
    window, and the results of those without (kind 2)."""
    def run(t: pa.Table) -> pa.Table:
        kinds, blobs = t.column("kind").to_pylist(), t.column("blob").to_pylist()
        own = t.column("slice")[0].as_py()
        x = Tokens.opened(_open(blobs[kinds.index(0)]))
        h = x.hashes()
        x.numbers = np.zeros(len(h), np.int64)
        of = dict(_word_shards(h, marks.shards))
        told = []
        for b, k in zip(blobs, kinds, strict=True):
            if k == 1:
                told.append(marks.joined(np.frombuffer(b, "<u8", 1)[0],
                                         np.frombuffer(b, marks.kind, -1, 8)))
            elif k == 3:
                some = of[int(np.frombuffer(b, "<u8", 1)[0])]
                x.numbers[some] = _numbers(np.frombuffer(b, "u1", -1, 8), len(some))
        maybe = x.whole(r.words)
        if told and len(maybe):
            maybe &= _among(marks.joined(*marks.place(h[x.codes], r)), np.sort(np.concatenate(told)))
        else:
            maybe[:] = False
        with_some = np.unique(x.text_of()[np.flatnonzero(maybe)])
        rows, out = [], np.setdiff1d(np.arange(len(x.starts) - 1), with_some)
        if len(with_some):
            part = x.only(with_some)
            keep = np.zeros(len(x.codes), bool)
            keep[: len(maybe)] = maybe
            bits = keep[np.isin(x.text_of(), with_some)][: len(part.codes) - r.words + 1]
            rows.append((own, 0, part.packed(marks=np.packbits(bits))))
        if len(out):
            part = x.only(out)
            rows.append((own, 2, _pack(ids=part.ids.cast(pa.int64()), sizes=_planes(np.diff(part.starts)),
                                       shas=pa.array(list(map(_sha, part.texts())), pa.string()))))
        return pa.Table.from_batches([_rows(TOLD, rows)])
    return run


# ------------------------------------------------------------------ suffixes

class Suffixes:
    """The suffixes of a slice that may be repeats; ``start`` is where they start."""

    def __init__(self, blob: bytes, r: Repeats):
        c = _open(blob)
        self.t, self.r = Tokens.opened(c), r
        n = max(len(self.t.codes) - r.words + 1, 0)
        bits = np.unpackbits(c["marks"].to_numpy().astype("u1"), count=n)
        self.start = np.flatnonzero(bits)
        self.words = self.t.numbers[self.t.codes]

    def path(self, start: np.ndarray, words: int) -> np.ndarray:
        """The numbers of the first ``words`` words of suffixes."""
        return self.words[start[:, None] + np.arange(words)]

    def ids(self) -> np.ndarray:
        """The document of each suffix."""
        ids = pc.fill_null(self.t.ids, 0).to_numpy(zero_copy_only=False)
        return ids[self.t.text_of()[self.start]]

    def same(self) -> np.ndarray:
        """Per suffix the number of its window among the slice's distinct ones: runs of words
        are numbered by pairs of shorter runs, over the words that such windows cover."""
        w = self.r.words
        covered = np.zeros(len(self.t.codes) + 1, np.int64)
        np.add.at(covered, self.start, 1)
        np.add.at(covered, self.start + w, -1)
        place = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
        at, x, have = np.searchsorted(place, self.start), self.t.codes[place].astype(np.uint64), 1

        def numbered(a, b):
            return np.unique((a << np.uint64(32)) | b, return_inverse=True)[1].astype(np.uint64)
        while 2 * have < w:
            x, have = numbered(x[:-have], x[have:]), 2 * have
        return numbered(x[at], x[at + w - have])

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Per distinct window, in order of their numbers: a start, the smallest document."""
        same, ids = self.same(), self.ids()
        order = np.lexsort((ids, same))
        first = order[np.append(True, np.diff(same[order].astype(np.int64)) != 0)]
        return self.start[first], ids[first]


def prefix_hash(path: np.ndarray) -> np.ndarray:
    out = np.zeros(len(path), np.uint64)
    for k in range(path.shape[1]):
        out = combined(out, path[:, k].astype(np.uint64))
    return out


def prefix_of(s: Suffixes, start: np.ndarray, long: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of each suffix, which is as long as the plan so far wants it, and which
    suffixes have one that the plan has yet to judge (the next length)."""
    r = s.r
    lengths = [*r.lengths, r.words]
    key, open_ = np.zeros(len(start), np.uint64), np.arange(len(start))
    for n, hot in zip(lengths, [*long, None], strict=False):
        key[open_] = prefix_hash(s.path(start[open_], n))
        if hot is None:
            break
        open_ = open_[_among(key[open_], hot)]
    return key, open_


def plan(rest: DataFrame, r: Repeats) -> tuple[list[np.ndarray], int]:
    """Per length the prefixes that are made longer, and the number of suffixes.

    There are no more than ``most_long`` a length: with more suffixes, groups grow."""
    long: list[np.ndarray] = []
    total, most = None, r.group
    for _ in r.lengths:
        def count(batches, long=tuple(long)):
            for b in batches:
                for blob in b.column("blob").to_pylist():
                    s = Suffixes(blob, r)
                    key, open_ = prefix_of(s, s.start, list(long))
                    key, n = np.unique(key[open_], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(n, pa.int64())], names=["prefix", "n"])
        counts = materialize(rest.select("blob").mapInArrow(count, "prefix long, n long")
                             .groupBy("prefix").agg(F.sum("n").alias("n")), "prefixes")
        if total is None:
            total = counts.agg(F.sum("n")).first()[0] or 0
            most = max(r.group, -(-total // r.most_long))
        hot = counts.filter(F.col("n") > most).select("prefix").toArrow().column("prefix")
        hot = np.sort(hot.to_numpy().astype(np.int64).view(np.uint64))
        if not len(hot):
            break
        long.append(hot)
    # After the last length in the list comes the whole window.
    return long, total or 0


ENTRY = [("group", pa.int64()), ("slice", pa.int64()), ("blob", pa.binary())]


def _dealt(s: Suffixes, long: list[np.ndarray], groups: int):
    """The distinct windows of a slice (starts, smallest documents), and per group their
    numbers, in an order that any task finds again."""
    start, ids = s.distinct()
    if not len(start):
        return start, ids, []
    group = (prefix_of(s, start, long)[0] % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((s.words[start], group))
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    return start, ids, [(int(group[some[0]]), some) for some in np.split(order, cuts)]


def _grouped(rest: DataFrame, r: Repeats, long: list[np.ndarray], groups: int) -> DataFrame:
    """(group, slice, blob): suffixes word by word, as numbers, and their documents."""
    def emit(batches):
        for b in batches:
            for own, blob in zip(b.column("slice").to_pylist(), b.column("blob").to_pylist(),
                                 strict=True):
                s = Suffixes(blob, r)
                start, ids, dealt = _dealt(s, long, groups)
                rows = []
                for group, some in dealt:
                    docs, doc = np.unique(ids[some], return_inverse=True)
                    path = s.path(start[some], r.words).T.ravel()
                    rows.append((group, own, _pack(path=_planes(path), docs=docs, doc=_planes(doc),
                                                   n=np.array([len(some)]))))
                yield _rows(ENTRY, rows)
    return rest.select("slice", "blob").mapInArrow(emit, "group long, slice long, blob binary")


def subtree(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of a group's suffixes, and between neighbours the length of their
    common prefix, which are the depths of the subtree's inner nodes."""
    order = np.lexsort([path[:, k] for k in range(path.shape[1] - 1, -1, -1)])
    differ = path[order[:-1]] != path[order[1:]]
    return order, np.where(differ.any(axis=1), differ.argmax(axis=1), path.shape[1])


def deep_nodes(common: np.ndarray, depth: int) -> np.ndarray:
    """Where, in sorted order, each set of leaves below one node of ``depth`` starts."""
    return np.flatnonzero(np.append(True, common < depth))


def _trees(r: Repeats):
    def run(t: pa.Table) -> pa.Table:
        group = t.column("group")[0].as_py()
        paths, ids = [], []
        for blob in t.column("blob").to_pylist():
            c = _open(blob)
            n = c["n"][0].as_py()
            ids.append(c["docs"].to_numpy()[_numbers(c["doc"].to_numpy(), n)])
            paths.append(_numbers(c["path"].to_numpy(), n * r.words).reshape(r.words, n).T)
        path, doc = np.concatenate(paths), np.concatenate(ids)
        path = path.astype("<u4") if path.max(initial=0) < 1 << 32 else path
        order, common = subtree(path)
        first = deep_nodes(common, r.words)
        least = np.minimum.reduceat(doc[order], first)
        told = np.empty(len(order), np.int64)
        told[order] = np.repeat(least, np.diff(np.append(first, len(order))))
        rows, at = [], 0
        for own, n in zip(t.column("slice").to_pylist(), map(len, ids), strict=True):
            some = told[at:at + n]
            if (some < doc[at:at + n]).any():
                docs, code = np.unique(some, return_inverse=True)
                rows.append((own, 1, _pack(group=np.array([group]), docs=docs, doc=_planes(code))))
            at += n
        return pa.Table.from_batches([_rows(TOLD, rows)])
    return run


def _marked(r: Repeats, long: list[np.ndarray], groups: int):
    """Of a slice's texts with suffixes in trees, what is kept."""
    def run(t: pa.Table) -> pa.Table:
        kinds, blobs = t.column("kind").to_pylist(), t.column("blob").to_pylist()
        s = Suffixes(blobs[kinds.index(0)], r)
        same, ids = s.same().astype(np.int64), s.ids()
        _, least, dealt = _dealt(s, long, groups)
        of = dict(dealt)
        for b, k in zip(blobs, kinds, strict=True):
            if k:
                c = _open(b)
                some = of[c["group"][0].as_py()]
                told = c["docs"].to_numpy()[_numbers(c["doc"].to_numpy(), len(some))]
                least[some] = np.minimum(least[some], told)
        gone = s.start[least[same] < ids]
        edge = np.zeros(len(s.t.codes) + 1, np.int64)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + r.words, -1)
        return pa.Table.from_batches([_result(s.t, np.cumsum(edge[:-1]) == 0)])
    return run


def _result(t: Tokens, keep: np.ndarray) -> pa.RecordBatch:
    rows = []
    for i, (doc, text) in enumerate(zip(t.ids.to_pylist(), t.texts(keep), strict=True)):
        a, z = int(t.starts[i]), int(t.starts[i + 1])
        gone = ~keep[a:z]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
        spans = [{"from": int(p), "to": int(q)} for p, q in zip(edge[::2], edge[1::2], strict=True)]
        rows.append((doc, z - a, int(gone.sum()), _sha(text), spans))
    return _rows(OUT, rows)


def _finished(batches):
    for b in batches:
        for blob in b.column("blob").to_pylist():
            c = _open(blob)
            sizes = _numbers(c["sizes"].to_numpy(), len(c["ids"])).tolist()
            yield _rows(OUT, [(i, n, 0, sha, []) for i, n, sha in zip(
                c["ids"].to_pylist(), sizes, c["shas"].to_pylist(), strict=True)])


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          r: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of what is left, joined by one space) and spans
    (removed words, from 0, the end not included) of every row."""
    if not 0 < r.gram <= r.words or max(r.lengths) >= r.words:
        raise ValueError("grams are at most, and prefixes shorter than, a window")
    parts = shuffle_partitions(df.sparkSession)
    marks = Marks.of(df.agg(F.sum(F.octet_length(quoted(text_col)))).first()[0] or 0, parts, r)
    told = _sliced(df, id_col, text_col, r, marks).groupBy("key").applyInArrow(_several(marks), TOLD_DDL)
    rows = materialize(told.groupBy("slice").applyInArrow(_left_over(r, marks), TOLD_DDL), "suffixes")
    rest = rows.filter("kind = 0")
    long, total = plan(rest, r)
    groups = int(max(parts, -(-2 * total // r.group)))
    found = _grouped(rest, r, long, groups).groupBy("group").applyInArrow(_trees(r), TOLD_DDL)
    marked = rest.unionByName(found).groupBy("slice").applyInArrow(_marked(r, long, groups), OUT_DDL)
    return marked.unionByName(rows.filter("kind = 2").select("blob").mapInArrow(_finished, OUT_DDL))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    r: Repeats = Repeats()) -> DataFrame:
    """``df``, whose ids are unique, with the repeats taken out of the texts: the words that stay
    of a text that loses some, joined by one space; the other texts as they are."""
    found = dedup(df, id_col, text_col, r).filter("n_removed > 0").select(
        F.col("doc_id").alias("_id"), "spans")
    x = df.select(F.struct(*map(quoted, df.columns)).alias("_row"),
                  quoted(id_col).cast("long").alias("_id")).join(found, "_id", "left")
    row = F.col("_row")
    kept = F.filter(words_of(row.getField(text_col)), lambda w, i: ~F.exists(
        "spans", lambda s: (s["from"] <= i) & (i < s["to"])))
    out = {c: row.getField(c) for c in df.columns}
    out[text_col] = F.when(F.col("spans").isNull(), out[text_col]).otherwise(F.array_join(kept, " "))
    return x.select(*(c.alias(n) for n, c in out.items()))
