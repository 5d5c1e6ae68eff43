"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors become integers floor(256 x).  A vector is cut into equal segments, of
which the mean and the deviation are kept, at several resolutions.  For segments
of length L with means m and deviations s, the squared distance of q and c is at
least sum L ((m_q - m_c)^2 + (s_q - s_c)^2), so the inner product is at most
sum L (m_q m_c + s_q s_c).  From coarse to fine, pairs whose bound lies under the
query's k-th best score so far go; only the survivors' exact scores are computed.

Queries and candidates are cut into parts of bounded size and each pair of parts
is one task, which keeps its queries' best k; the parts' winners are merged.

Defined cases: a vector that is null or has a null or non-finite component takes
no part; vectors of different lengths are compared as if filled up with zeros; a
null id takes no part; repeated ids are separate candidates (a query's own id is
none); ties go to the smaller id; an empty table gives an empty result; scores
beyond a long's range are clipped to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludeme.plans.session import materialize


@dataclass(frozen=True)
class Search:
    k: int = 5
    scale: int = 256
    every: int = 50              # ids divisible by this are queries
    levels: tuple[int, ...] = (16, 8, 4, 2)   # segment lengths, coarse to fine
    slice_rows: int = 8192       # candidates of a task, about
    part_rows: int = 4096        # queries of a task, about
    chunk: int = 256


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"),
                          v.cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull() & good)


def _matrix(lists: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """Integer rows, filled up with zeros.  Floats hold them exactly (their
    magnitude may be large, their precision is a double's)."""
    flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), width))
    rows = np.repeat(np.arange(len(n)), n)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _statistics(x: np.ndarray, length: int) -> np.ndarray:
    """Means and deviations side by side, scaled so that their inner product is
    the bound."""
    s = x.reshape(len(x), -1, length)
    return np.hstack([s.mean(axis=2), s.std(axis=2)]) * np.sqrt(length)


def _exact(a: np.ndarray, b: np.ndarray, small: bool) -> np.ndarray:
    if small:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    top = (1 << 63) - 1
    return np.array([max(min(sum(int(x) * int(y) for x, y in zip(p, q, strict=True)), top), -top - 1)
                     for p, q in zip(a, b, strict=True)], dtype=np.int64)


def search_part(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray,
                s: Search) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate id, score) of each query's best k."""
    small = (np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]) < 2.0 ** 53
    order = np.argsort(-np.einsum("ij,ij->i", c, c), kind="stable")  # long vectors first
    cid, c = cid[order], c[order]
    stats = [( _statistics(q, n), _statistics(c, n)) for n in s.levels]
    slack = 1e-9 * (1 + np.sqrt(np.einsum("ij,ij->i", q, q)))
    reach = np.sqrt(np.einsum("ij,ij->i", c, c))
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    floor = np.full(len(q), -np.inf)
    for lo in range(0, len(c), s.chunk):
        found = []
        for a in range(0, len(q), s.chunk):
            some = slice(lo, lo + s.chunk)
            coarse = stats[0][0][a:a + s.chunk] @ stats[0][1][some].T
            room = slack[a:a + s.chunk, None] * (1 + reach[some])
            i, j = np.nonzero(coarse + room >= floor[a:a + s.chunk, None])
            i, j = i + a, j + lo
            for sq, sc in stats[1:]:
                keep = np.einsum("ij,ij->i", sq[i], sc[j]) + slack[i] * (1 + reach[j]) >= floor[i]
                i, j = i[keep], j[keep]
            other = qid[i] != cid[j]
            i, j = i[other], j[other]
            score = _exact(q[i], c[j], small)
            keep = score >= floor[i]
            found.append((i[keep], cid[j[keep]], score[keep]))
        i, ids, score = (np.concatenate(x) for x in zip(best, *found, strict=True))
        order = np.lexsort((ids, -score.astype(object) if not small else -score, i))
        i, ids, score = i[order], ids[order], score[order]
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, int)
        rank = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
        keep = rank < s.k
        best = i[keep], ids[keep], score[keep]
        full = rank[keep] == s.k - 1
        floor[best[0][full]] = best[2][full]
    return best


def top_k(vectors: DataFrame, s: Search = Search(), id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's best k."""
    v = materialize(valid(vectors, id_col, vec_col), "vectors")
    is_query = F.col("id") % s.every == 0
    size = v.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q"),
                 F.max(F.size("v")).alias("w")).first()
    slices, parts = max(1, -(-size["n"] // s.slice_rows)), max(1, -(-size["q"] // s.part_rows))
    most = max(s.levels)
    width = max(1, -(-(size["w"] or 1) // most)) * most
    spread = F.xxhash64("id", "v")
    c = v.select("id", "v", F.lit(False).alias("query"), F.pmod(spread, F.lit(slices)).alias("slice"),
                 F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    q = v.filter(is_query).select(
        "id", "v", F.lit(True).alias("query"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.pmod(spread, F.lit(parts)).alias("part"))

    def search(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        is_q = t.column("query").to_numpy()
        rows = t.column("v").combine_chunks()
        rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
        x = _matrix(rows, width, s.scale)
        ids = t.column("id").to_numpy()
        i, other, score = search_part(ids[is_q], x[is_q], ids[~is_q], x[~is_q], s)
        return pa.table({"query_id": ids[is_q][i], "row": i, "vec_id": other, "score": score})
    # The exchange by (slice, part) comes from the grouping.
    found = c.unionByName(q.withColumn("slice", F.col("slice").cast("long"))
                          .withColumn("part", F.col("part").cast("int"))) \
        .groupBy("slice", "part").applyInArrow(
        search, "query_id long, row long, vec_id long, score long")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= s.k) \
        .select("query_id", "rank", "vec_id", "score")
