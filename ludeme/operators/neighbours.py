"""Exact nearest neighbours of items by cosine, over an index of blocks.

Vectors are scaled to length one and dealt to blocks around centres (k-means on the unit
vectors).  A block keeps its mean and its radius, so a query's similarity with any of its
vectors is at most query x mean + radius.  The first pass scores, per query, the blocks with
the highest bounds; the n-th best similarity so far is a floor.  The second pass takes only
the blocks whose bound reaches the floor: the others are skipped before any vector moves,
and the result is exact.

Blocks are cut into parts of bounded size, and a part's queries are dealt to parts as well,
so neither a block that holds a third of all vectors nor a block that every query wants is
one task.

Similarities are rounded to nine places and ordered by that, ties by id.  A vector that is
null, has a null or non-finite component, no direction or another length than most takes no
part; a query is not its own neighbour.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludeme.functions.metrics import norm
from ludeme.plans.session import materialize

DIGITS = 9


@dataclass(frozen=True)
class BlockIndex:
    """rows: id, unit, block, part; the block table: one entry per block."""
    rows: DataFrame
    number: np.ndarray
    mean: np.ndarray
    radius: np.ndarray
    parts: np.ndarray
    count: int


@dataclass(frozen=True)
class IndexParams:
    block_rows: int = 1024       # vectors of a block, about
    most_blocks: int = 1024      # the block table is sent to the tasks
    part_rows: int = 4096
    part_queries: int = 2048
    probes: int = 2              # blocks of a query's first pass
    seed: int = 42


def unit_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id (long), unit (array<double> of length one)."""
    v = F.col(vec_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    x = df.select(F.col(id_col).cast("long").alias("id"), v.alias("_v")).filter(
        F.col("id").isNotNull() & F.col("_v").isNotNull() & good) \
        .withColumn("_n", norm(F.col("_v"))).filter((F.col("_n") > 0) & (F.col("_n") < float("inf")))
    return x.select("id", F.transform("_v", lambda c: c / F.col("_n")).alias("unit"))


def build_index(vectors: DataFrame, id_col: str, vec_col: str,
                p: IndexParams = IndexParams()) -> BlockIndex:
    units = materialize(unit_vectors(vectors, id_col, vec_col), "units")
    widths = units.groupBy(F.size("unit").alias("w")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "w").first()
    if widths is None:
        rows = units.select("*", F.lit(0).alias("block"), F.lit(0).cast("long").alias("part"))
        return BlockIndex(rows, np.zeros(0, int), np.zeros((0, 0)), np.zeros(0), np.zeros(0, int), 0)
    units = units.filter(F.size("unit") == widths["w"])
    k = int(min(p.most_blocks, max(1, widths["n"] // p.block_rows)))
    if k > 1:
        x = units.withColumn("_x", array_to_vector("unit"))
        fitted = KMeans(featuresCol="_x", predictionCol="block", k=k, seed=p.seed, maxIter=5,
                        initMode="random").fit(x)
        dealt = fitted.transform(x).drop("_x")
    else:
        dealt = units.withColumn("block", F.lit(0))
    dealt = materialize(dealt, "blocks")
    # Partial aggregation: a block of any size is one buffer per task.
    means = dealt.groupBy("block").agg(Summarizer.mean(array_to_vector(F.col("unit"))).alias("m"),
                                       F.count(F.lit(1)).alias("n")) \
        .select("block", vector_to_array("m").alias("mean"), "n")
    away = F.zip_with("unit", "mean", lambda a, b: (a - b) * (a - b))
    far = dealt.join(F.broadcast(means), "block").groupBy("block").agg(   # most_blocks rows
        F.sqrt(F.max(F.aggregate(away, F.lit(0.0), lambda s, x: s + x))).alias("radius"))
    parts = F.ceil(F.col("n") / p.part_rows).cast("long")
    rows = dealt.join(F.broadcast(means.select("block", parts.alias("parts"))), "block").select(
        "id", "unit", "block", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    table = means.join(far, "block").select("block", "mean", "radius", parts.alias("parts")) \
        .orderBy("block").collect()    # most_blocks rows at most
    number, mean, radius, parts = (np.array([r[c] for r in table])
                                   for c in ("block", "mean", "radius", "parts"))
    return BlockIndex(rows, number, mean, radius, parts, int(widths["n"]))


def _visits(index: BlockIndex, queries: DataFrame, p: IndexParams, first: bool) -> DataFrame:
    """(query, unit, block, parts): each query's blocks with the highest bounds, or those of the
    others whose bound reaches the query's ``floor``."""
    number, mean, radius, parts = index.number, index.mean, index.radius, index.parts

    def run(batches):
        for b in batches:
            lists = b.column("unit")
            x = lists.flatten().to_numpy().reshape(b.num_rows, -1)
            bound = x @ mean.T + radius + 1e-8
            place = np.argsort(np.argsort(-bound, axis=1, kind="stable"), axis=1)
            take = place < p.probes
            if not first:
                floor = b.column("floor").to_numpy(zero_copy_only=False)
                take = ~take & (bound >= np.nan_to_num(floor, nan=-2.0)[:, None])
            i, j = np.nonzero(take)
            yield pa.RecordBatch.from_arrays(
                [b.column("query").take(pa.array(i)), lists.take(pa.array(i)),
                 pa.array(number[j], pa.int32()), pa.array(parts[j], pa.int64())],
                names=["query", "unit", "block", "parts"])
    return queries.mapInArrow(run, "query long, unit array<double>, block int, parts long")


def _similar(index: BlockIndex, visits: DataFrame, n: int, p: IndexParams) -> DataFrame:
    """(query, id, similarity): per query and part of a block, its n best.  ``visits``: query,
    unit, block, parts."""
    deals = visits.groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / p.part_queries).cast("long").alias("deals"))
    q = visits.join(deals, "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query"), F.col("deals")).alias("deal"), F.col("query").alias("id"),
        "unit", F.lit(True).alias("asks"))
    c = index.rows.join(deals, "block").select(
        "block", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"),
        "id", "unit", F.lit(False).alias("asks"))

    def search(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        asks = t.column("asks").to_numpy()
        ids = t.column("id").to_numpy()
        lists = t.column("unit").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        x = lists.flatten().to_numpy().reshape(len(ids), -1)
        qs, own, other = x[asks], ids[asks], ids[~asks]
        out = []
        for a in range(0, len(qs), 512):
            s = np.round(qs[a:a + 512] @ x[~asks].T, DIGITS)
            s[own[a:a + 512, None] == other[None, :]] = -np.inf
            least = (np.partition(s, s.shape[1] - n, axis=1)[:, -n] if s.shape[1] > n
                     else np.full(len(s), -2.0))
            i, j = np.nonzero(s >= np.maximum(least, -2.0)[:, None])
            order = np.lexsort((other[j], -s[i, j], i))
            i, j = i[order], j[order]
            first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, int)
            rank = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
            i, j = i[rank < n], j[rank < n]
            out.append((own[a + i], other[j], s[i, j]))
        q_, id_, s_ = (np.concatenate(c) for c in zip(*out, strict=True)) if out else ([], [], [])
        return pa.table({"query": pa.array(q_, pa.int64()), "id": pa.array(id_, pa.int64()),
                         "similarity": pa.array(s_, pa.float64())})
    return c.unionByName(q).groupBy("block", "part", "deal").applyInArrow(
        search, "query long, id long, similarity double")


def _best(found: DataFrame, n: int) -> DataFrame:
    own = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= n)


def neighbours(index: BlockIndex, ids: DataFrame, n: int = 10,
               p: IndexParams = IndexParams()) -> DataFrame:
    """(query, rank, id, similarity) of the items whose ids are in ``ids`` (column ``id``)."""
    queries = materialize(index.rows.join(ids.select(F.col("id").cast("long")).distinct(), "id",
                                          "left_semi").select(F.col("id").alias("query"), "unit"),
                          "queries")
    if not index.count:
        return queries.sparkSession.createDataFrame(
            [], "query long, rank int, id long, similarity double")
    first = materialize(_best(_similar(index, _visits(index, queries, p, True), n, p), n), "probed")
    floors = first.filter(F.col("rank") == n).select("query", F.col("similarity").alias("floor"))
    rest = _visits(index, queries.join(floors, "query", "left"), p, False)
    second = _similar(index, materialize(rest, "visits"), n, p)
    return _best(first.drop("rank").unionByName(second), n).select(
        "query", "rank", "id", "similarity")


def visited_blocks(index: BlockIndex, ids: DataFrame, n: int = 10,
                   p: IndexParams = IndexParams()) -> DataFrame:
    """(query, blocks, visited): the index's blocks, and those whose bound reaches the query's
    n-th similarity."""
    floors = neighbours(index, ids, n, p).filter(F.col("rank") == n) \
        .select("query", F.col("similarity").alias("floor"))
    q = index.rows.select(F.col("id").alias("query"), "unit").join(floors, "query")
    none = IndexParams(probes=0)
    return _visits(index, q, none, False).groupBy("query").agg(
        F.lit(len(index.number)).alias("blocks"), F.count(F.lit(1)).alias("visited"))
