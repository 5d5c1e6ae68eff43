"""Exact top-N lists over factor tables, with an early stop and a mask of seen items.

Items are sorted by falling norm and cut into chunks of bounded size; a chunk is broadcast
and every user that is still open scores it block by block.  By Cauchy-Schwarz no item from
a block on can score above |user| times the block's largest norm: once that lies under a
user's N-th score the list is final, and the user leaves the rounds.  Users stay where they
are (no shuffle, no user x item rows, no task per pair of blocks); between rounds only open
users are written.

Seen items travel with the user as one sorted array and are skipped while a block is scored,
so a user with a long history needs no more memory than that array and N entries.

A score is the dot product of the stored factors in double precision, rounded to a float;
equal scores are ordered by item id.  Items whose score is not a number are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.functions.metrics import norm
from ludeme.plans.ranking import global_rank
from ludeme.plans.session import materialize
from ludeme.sources.schema import ITEM_ID, RATING, USER_ID


@dataclass(frozen=True)
class Blocks:
    items: int = 2048            # items scored together
    users: int = 1024            # users scored together
    chunk_bytes: int = 16 << 20  # of item factors broadcast in a round


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _first(row: np.ndarray, score: np.ndarray, item: np.ndarray, n: int):
    """Of (row, score, item) the n best of each row, in order."""
    order = np.lexsort((item, -score, row))
    row, score, item = row[order], score[order], item[order]
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, int)
    rank = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
    keep = rank < n
    return row[keep], score[keep], item[keep], rank[keep]


def score_block(u: np.ndarray, size: np.ndarray, seen: pa.Array, top: tuple, floor: np.ndarray,
                items: np.ndarray, v: np.ndarray, reach: np.ndarray, n: int, b: Blocks):
    """The best lists (row, score, item) of a block of users after the items of a chunk, the
    n-th scores, and how many items each user was scored against."""
    done = np.zeros(len(u), np.int64)
    counts = np.diff(seen.offsets.to_numpy())
    seen_row = np.repeat(np.arange(len(u)), counts)
    seen_item = seen.flatten().to_numpy(zero_copy_only=False)
    for a in range(0, len(items), b.items):
        # Scores are floats: what rounds to the n-th score may still come first by its id.
        open_ = np.flatnonzero(size * reach[a] * (1 + 1e-6) >= floor)
        if not len(open_):
            break
        ids = items[a:a + b.items]
        s = (u[open_] @ v[a:a + b.items].T).astype(np.float32)
        done[open_] += len(ids)
        if len(seen_item):
            order = np.argsort(ids)
            at = np.minimum(np.searchsorted(ids[order], seen_item), len(ids) - 1)
            hit = ids[order][at] == seen_item
            place = np.full(len(u), -1)
            place[open_] = np.arange(len(open_))
            hit &= place[seen_row] >= 0
            s[place[seen_row[hit]], order[at[hit]]] = np.nan
        least = floor[open_].astype(np.float32)
        if s.shape[1] > n:   # the block's own n-th score per user
            full = np.where(np.isnan(s), -np.inf, s)
            least = np.maximum(least, np.partition(full, s.shape[1] - n, axis=1)[:, -n])
        i, j = np.nonzero(s >= least[:, None])
        row, score, item, rank = _first(np.append(top[0], open_[i]), np.append(top[1], s[i, j]),
                                        np.append(top[2], ids[j]), n)
        top = row, score, item
        last = rank == n - 1
        floor = floor.copy()
        floor[row[last]] = score[last]
    return top, floor, done


_STATE = ("id int, features array<float>, seen array<int>, items array<int>, "
          "scores array<float>, scored long")


def _state(users: DataFrame, seen: DataFrame | None) -> DataFrame:
    if seen is None:
        own = F.array().cast("array<int>")
    else:
        per = seen.groupBy(F.col(USER_ID).alias("id")).agg(
            F.array_sort(F.collect_set(ITEM_ID)).alias("_seen"))
        users = users.join(per, "id", "left")
        own = F.coalesce("_seen", F.array().cast("array<int>"))
    return users.select("id", "features", own.cast("array<int>").alias("seen"),
                        F.array().cast("array<int>").alias("items"),
                        F.array().cast("array<float>").alias("scores"),
                        F.lit(0).cast("long").alias("scored"))


def top_n(users: DataFrame, items: DataFrame, n: int = 10, seen: DataFrame | None = None,
          blocks: Blocks = Blocks()) -> DataFrame:
    """(id, items, scores, scored) of each user: the ids and scores of the n best items, and
    the number of items that were scored to know them.

    ``users``, ``items``: id, features (arrays of one length); ``seen``: pairs of user and
    item to leave out."""
    spark = users.sparkSession
    sorted_items, count = global_rank(items.withColumn("_norm", norm(F.col("features"))),
                                      [F.desc_nulls_last("_norm"), F.asc("id")], "_rank", "items")
    width = items.agg(F.max(F.size("features"))).first()[0] or 0
    chunk = max(blocks.items, blocks.chunk_bytes // (8 * max(width, 1)))
    left, done = materialize(_state(users, seen), "users"), []

    for low in range(0, count, chunk):
        part = sorted_items.filter((F.col("_rank") >= low) & (F.col("_rank") < low + chunk)) \
            .orderBy("_rank").select("id", "features", "_norm").toArrow()
        cast = spark.sparkContext.broadcast((   # at most chunk_bytes of factors
            part.column("id").to_numpy().astype(np.int64), _matrix(part.column("features"), width),
            part.column("_norm").to_numpy()))

        def run(batches, cast=cast):
            ids, v, norms = cast.value
            for whole in batches:
                for at in range(0, whole.num_rows, blocks.users):
                    t = whole.slice(at, blocks.users)
                    u = _matrix(t.column("features"), width)
                    size = np.sqrt((u * u).sum(axis=1))
                    kept = t.column("items")
                    row = np.repeat(np.arange(len(u)), np.diff(kept.offsets.to_numpy()))
                    score = t.column("scores").flatten().to_numpy(zero_copy_only=False)
                    item = kept.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    have = np.bincount(row, minlength=len(u))
                    floor = np.full(len(u), -np.inf)
                    full = have == n
                    floor[full] = score[np.cumsum(have)[full] - 1] if len(score) else -np.inf
                    top, _, scored = score_block(
                        u, size, t.column("seen"), (row, score, item), floor, ids, v, norms, n,
                        blocks)
                    ends = np.append(0, np.cumsum(np.bincount(top[0], minlength=len(u))))
                    ends = pa.array(ends, pa.int32())
                    total = t.column("scored").to_numpy() + scored
                    yield pa.RecordBatch.from_arrays([
                        t.column("id"), t.column("features"), t.column("seen"),
                        pa.ListArray.from_arrays(ends, pa.array(top[2], pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(top[1], pa.float32())),
                        pa.array(total, pa.int64())],
                        names=["id", "features", "seen", "items", "scores", "scored"])
        left = left.mapInArrow(run, _STATE)
        if low + chunk >= count:
            break
        left = materialize(left, "lists")
        cast.unpersist()
        after = float(part.column("_norm")[-1].as_py() or 0.0)   # of all items still to come, at most
        bound = norm(F.col("features")) * F.lit(after) * F.lit(1 + 1e-6)
        open_ = F.when(F.size("scores") < n, F.lit(True)).otherwise(
            bound >= F.try_element_at("scores", F.lit(-1)).cast("double"))
        done.append(left.filter(~open_))
        left = left.filter(open_)
        if left.isEmpty():
            break
    for d in done:
        left = left.unionByName(d)
    return left.select("id", "items", "scores", "scored")


def as_recommendations(lists: DataFrame, user_col: str = USER_ID) -> DataFrame:
    """(user, array of (item, rating)), the best first; users without items are left out."""
    pairs = F.arrays_zip(F.col("items").alias(ITEM_ID), F.col("scores").alias(RATING))
    kind = f"array<struct<{ITEM_ID}:int,{RATING}:float>>"
    return lists.filter(F.size("items") > 0).select(
        F.col("id").alias(user_col), pairs.cast(kind).alias("recommendations"))


def recommend(model: ALSModel, n: int = 10, users: DataFrame | None = None,
              seen: DataFrame | None = None, blocks: Blocks = Blocks()) -> DataFrame:
    """Lists of the model's users (or those of ``users`` that the model knows)."""
    of = model.userFactors
    if users is not None:
        of = of.join(users.select(F.col(USER_ID).cast("int").alias("id")).distinct(), "id",
                     "left_semi")
    return top_n(of, model.itemFactors, n, seen, blocks)
