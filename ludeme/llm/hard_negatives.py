"""Hard-negative mining over an inverted multi-index.

1. Vectors become integers floor(256 x) and are cut into two halves.  Each half has
   its own codebook, fitted by Lloyd's steps on a bounded sample; a vector's two
   nearest codes are its cell.  All vectors are indexed; a code's radius is the
   largest distance of any vector's half to it.
2. Cells are stored in shards of bounded size as arrays that tasks map: a cell is a
   run of rows in a shard, a large cell is dealt to several shards.
3. An anchor's half-score with any vector of code i is at most q c_i + |q| r_i.  Both
   halves' bounds are sorted and a heap visits the cells by their sum, largest first
   (multi-sequence).  The first walk ends when the k-th positive's score lies above
   the next cell's bound; the second when, for each positive's window, so do the
   last wanted negative's score, or the window's lower end.  A cell whose members all
   score above every window is passed over.  So the results are exact; the index
   only decides how much is scored.

Anchors are dealt over tasks by a hash of their own values, and a task holds one
anchor's walk and one cell's rows (mapped) at a time.

The shards lie in the shared folder (``spark.checkpoint.dir``), which for this
operator has to be mounted on all machines (a ``file:`` path).  A shard's file is
written beside and renamed, so a task that runs twice leaves the same file.

Defined cases: a vector that is null or has a null or non-finite component takes no
part, nor does a row with a null id or label; vectors of different lengths are
compared as if filled up with zeros; an anchor is compared with rows of other ids;
repeated ids are separate rows; ties go to the smaller id; anchors without positives,
and positives without negatives in their window, give no row; an empty table gives
an empty result; other columns are ignored.  Scores are exact up to 2 ** 53; larger
ones are rounded, and clipped to a long's range.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludeme.plans.session import materialize, scratch_path, shuffle_partitions


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    every: int = 50              # ids divisible by this are anchors
    positives: int = 5
    negatives: int = 3
    low: int = 50                # per cent of the positive's score
    high: int = 95
    sample: int = 8_192          # vectors that the codebooks are fitted on, at most
    steps: int = 6               # Lloyd's steps
    most_codes: int = 128        # of a codebook
    cell_rows: int = 512         # vectors of a cell, on average, as long as codes allow
    shard_rows: int = 65_536


@dataclass
class Index:
    """What each task needs of the index; bounded by ``most_codes`` squared cells."""
    folder: str
    width: int = 2
    codes: tuple[np.ndarray, np.ndarray] = ()
    radii: tuple[np.ndarray, np.ndarray] = ()
    #: cell -> its runs (shard, first row, row after the last)
    runs: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)


# ------------------------------------------------------------------ vectors

def labelled(vectors: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """id, label, v of the rows that take part."""
    v = F.col(vec_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                          v.cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & good)


def matrix(lists: pa.Array, width: int, scale: int) -> np.ndarray:
    """Whole-numbered rows, filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), width))
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2:]


def nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.argmin((codes * codes).sum(axis=1) - 2 * x @ codes.T, axis=1)


def codebook(x: np.ndarray, k: int, steps: int) -> np.ndarray:
    """Lloyd's steps from the rows at even places; a code without rows stays."""
    codes = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(steps):
        own = nearest(x, codes)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(codes)
        np.add.at(sums, own, x)
        codes[n > 0] = sums[n > 0] / n[n > 0, None]
    return codes


# ------------------------------------------------------------------ index

def _folder(spark) -> str:
    url = urlparse(scratch_path(spark, "cells"))
    if url.scheme not in ("", "file"):
        raise ValueError("cells are memory-mapped: spark.checkpoint.dir has to be a folder that "
                         f"is mounted on all machines, not {url.scheme}:")
    os.makedirs(url.path, exist_ok=True)
    return url.path


def _write(folder: str, name: str, array: np.ndarray) -> None:
    beside = f"{folder}/.{name}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(beside, "wb") as f:
        np.save(f, array)
    os.replace(beside, f"{folder}/{name}.npy")


def _smallest(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(x).max(initial=0)
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8")


def _assigned(rows: DataFrame, ix: Index, m: Mining) -> DataFrame:
    """id, label, v, cell and the distances of the halves to their codes."""
    k = len(ix.codes[1])

    def run(batches):
        for b in batches:
            x = matrix(b.column("v"), ix.width, m.scale)
            own = [nearest(h, c) for h, c in zip(halves(x), ix.codes, strict=True)]
            far = [np.sqrt(((h - c[o]) ** 2).sum(axis=1))
                   for h, c, o in zip(halves(x), ix.codes, own, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(own[0] * k + own[1], pa.int64()), *map(pa.array, far)],
                names=["id", "label", "v", "cell", "far1", "far2"])
    return rows.mapInArrow(
        run, "id long, label long, v array<double>, cell long, far1 double, far2 double")


def build(rows: DataFrame, m: Mining) -> tuple[Index, DataFrame]:
    """The index of all rows (id, label, v), and the rows with their cells."""
    spark = rows.sparkSession
    rows = materialize(rows, "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    ix = Index(_folder(spark), max(2, (width or 0) + (width or 0) % 2))
    drawn = rows.orderBy(F.xxhash64("id", "v"), "id").limit(m.sample).select("v").toArrow()
    if not n:
        return ix, rows.withColumn("cell", F.lit(0).cast("long"))
    x = matrix(drawn.column("v"), ix.width, m.scale)
    k = max(1, min(m.most_codes, len(x), round((n / m.cell_rows) ** 0.5)))
    ix.codes = tuple(codebook(h, k, m.steps) for h in halves(x))
    rows = materialize(_assigned(rows, ix, m), "assigned")
    radii = (np.zeros(k), np.zeros(k))
    shards, cells, room = [], {}, 0
    for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far1").alias("r1"),
                                      F.max("far2").alias("r2")).orderBy("cell").collect():
        i, j = divmod(r["cell"], k)
        radii[0][i], radii[1][j] = max(radii[0][i], r["r1"]), max(radii[1][j], r["r2"])
        # Small cells share a shard, a large one takes several of its own.
        if not shards or room < r["n"]:
            own = -(-r["n"] // m.shard_rows)
            shards += range(len(shards), len(shards) + own)
            cells[r["cell"]] = (len(shards) - own, own)
            room = m.shard_rows - r["n"] if own == 1 else 0
        else:
            cells[r["cell"]] = (len(shards) - 1, 1)
            room -= r["n"]
    ix.radii = radii
    place = spark.createDataFrame([(c, s, o) for c, (s, o) in cells.items()],
                                  "cell long, first long, own long")
    dealt = rows.join(F.broadcast(place), "cell").select(   # at most most_codes ** 2 rows
        (F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("own"))).alias("shard"),
        "cell", "id", "label", "v")

    def store(t: pa.Table) -> pa.Table:
        s = t.column("shard")[0].as_py()
        cell = t.column("cell").to_numpy()
        order = np.lexsort((t.column("id").to_numpy(), cell))
        cell = cell[order]
        _write(ix.folder, f"id-{s}", t.column("id").to_numpy()[order])
        _write(ix.folder, f"label-{s}", t.column("label").to_numpy()[order])
        _write(ix.folder, f"v-{s}", _smallest(matrix(t.column("v"), ix.width, m.scale)[order]))
        own, a = np.unique(cell, return_index=True)
        return pa.table({"cell": own, "shard": np.full(len(own), s), "a": a,
                         "z": np.append(a[1:], len(cell))})
    for r in dealt.groupBy("shard").applyInArrow(
            store, "cell long, shard long, a long, z long").collect():
        ix.runs.setdefault(r["cell"], []).append((r["shard"], r["a"], r["z"]))
    return ix, rows


# ------------------------------------------------------------------ walks

class Cells:
    """The mapped shards of an index."""

    def __init__(self, ix: Index):
        self.ix, self.maps = ix, {}

    def rows(self, cell: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """ids, labels and vectors of a cell, run by run."""
        for shard, a, z in self.ix.runs.get(cell, ()):
            if shard not in self.maps:
                self.maps[shard] = [np.load(f"{self.ix.folder}/{name}-{shard}.npy", mmap_mode="r")
                                    for name in ("id", "label", "v")]
            ids, labels, v = self.maps[shard]
            yield ids[a:z], labels[a:z], v[a:z]


def bounds(ix: Index, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per half: the largest and the smallest half-score that a code's vectors can have."""
    out = []
    for h, codes, radii in zip(halves(q[None, :]), ix.codes, ix.radii, strict=True):
        middle = codes @ h[0]
        # Beyond rounding errors of the products.
        reach = np.sqrt(h[0] @ h[0]) * radii * (1 + 1e-9) + 1e-9 * (1 + np.abs(middle))
        out.append((middle + reach, middle - reach))
    return out


def multi_sequence(up1: np.ndarray, up2: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs, the largest sum first."""
    o1, o2 = np.argsort(-up1, kind="stable"), np.argsort(-up2, kind="stable")
    a, b = up1[o1].tolist(), up2[o2].tolist()
    heap, reached = [(-(a[0] + b[0]), 0, 0)], [0] * len(a)   # reached: columns used of a row
    while heap:
        s, i, j = heapq.heappop(heap)
        yield -s, int(o1[i]), int(o2[j])
        reached[i] = j + 1
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


def _merged(best: list, score: np.ndarray, ids: np.ndarray, k: int) -> list:
    """The first k of best and the new ones: (-score, id) ascending."""
    if len(score) > k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        ties = np.sort(ids[score == cut])[:k]
        score, ids = (np.append(score[score > cut], np.full(len(ties), cut)),
                      np.append(ids[score > cut], ties))
    if len(best) == k and len(score):
        some = score >= -best[-1][0]
        score, ids = score[some], ids[some]
    if not len(score):
        return best
    return sorted(best + [(-int(s), int(i)) for s, i in zip(score, ids, strict=True)])[:k]


def _long(x: int) -> int:
    return max(min(x, (1 << 63) - 1), -(1 << 63))


def mine_one(cells: Cells, own_id: int, label: int, q: np.ndarray, m: Mining):
    """Rows (positive_id, rank, negative_id, positive_score, negative_score), and the
    numbers of vectors that the two walks scored."""
    ix, k = cells.ix, len(cells.ix.codes[1])
    (up1, down1), (up2, down2) = bounds(ix, q)
    best: list = []
    scored = [0, 0]
    for most, i, j in multi_sequence(up1, up2):
        if len(best) == m.positives and -best[-1][0] > most:
            break
        for ids, labels, v in cells.rows(i * k + j):
            take = (labels == label) & (ids != own_id)
            scored[0] += int(take.sum())
            best = _merged(best, v[take].astype(float) @ q, ids[take], m.positives)
    # Windows in whole scores: low * p <= 100 * s <= high * p.
    windows = [(-(m.low * s // 100), -s * m.high // 100) for s, _ in best]
    found: list[list] = [[] for _ in best]
    open_ = [w for w, (lo, hi) in enumerate(windows) if lo <= hi]
    for most, i, j in multi_sequence(up1, up2):
        open_ = [w for w in open_ if most >= windows[w][0] and not (
            len(found[w]) == m.negatives and -found[w][-1][0] > most)]
        if not open_:
            break
        if down1[i] + down2[j] > max(windows[w][1] for w in open_):
            continue
        for ids, labels, v in cells.rows(i * k + j):
            take = (labels != label) & (ids != own_id)
            scored[1] += int(take.sum())
            score, ids = v[take].astype(float) @ q, ids[take]
            for w in open_:
                within = (score >= windows[w][0]) & (score <= windows[w][1])
                found[w] = _merged(found[w], score[within], ids[within], m.negatives)
    out = [(pid, r, nid, _long(-p), _long(-s)) for (p, pid), negatives in zip(best, found, strict=True)
           for r, (s, nid) in enumerate(negatives, 1)]
    return out, scored


def mine(vectors: DataFrame, m: Mining = Mining(), id_col: str = "vec_id",
         vec_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score and the
    rows that the anchor's walks scored (``scored_positives``, ``scored_negatives``)."""
    spark = vectors.sparkSession
    ix, rows = build(labelled(vectors, id_col, vec_col, F.col("label") if label is None else label), m)
    anchors = rows.filter(F.col("id") % m.every == 0).select("id", "label", "v")
    n = anchors.count()
    parts = max(1, min(-(-n // 64), 16 * shuffle_partitions(spark)))
    anchors = anchors.repartition(parts, F.xxhash64("id", "v"))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
             "negative_score", "scored_positives", "scored_negatives"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]

    def run(batches):
        cells = Cells(ix)
        for b in batches:
            x = matrix(b.column("v"), ix.width, m.scale)
            out = []
            for a, own, q in zip(b.column("id").to_pylist(), b.column("label").to_pylist(), x,
                                 strict=True):
                found, scored = mine_one(cells, a, own, q, m)
                out += [(a, *row, *scored) for row in found]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
    return anchors.mapInArrow(run, ", ".join(
        f"{n} {'int' if t == pa.int32() else 'long'}" for n, t in zip(names, kinds, strict=True)))
