"""Does a fitted factorisation solve its own equations?

ALS ends with a user half-step: with the item factors V fixed, each user's factor x minimises a
least-squares problem, whose gradient is

    explicit   sum_i v_i (v_i.x - r_i) + lambda n x
    implicit   V'V x + sum_i c_i v_i (v_i.x) - sum_{r_i > 0} (1 + c_i) v_i + lambda n+ x

with c_i = alpha |r_i|, n the user's ratings and n+ those above zero.  The gradient is zero at the
solution; under non-negativity it is zero where x > 0 and not negative where x = 0.  Both are one
condition: a Newton step per coordinate, x_k - g_k / A_kk, cut off at 0 if x may not be negative,
leaves x where it is.  The residual is the largest such move, relative to the largest coordinate.

As v_i.x is known once a rating row has met both factors, the sums are vectors of ``rank`` numbers
(the gradient's and the diagonal's), partially aggregated: a user with a third of all ratings costs
a buffer per task.  V'V is ``rank`` squared numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.functions.metrics import dot
from ludeme.operators.als import ALSParams
from ludeme.sources.schema import ITEM_ID, RATING, USER_ID


def gram(factors: DataFrame, rank: int) -> np.ndarray:
    """V'V of a factor table: one partial sum per batch, ``rank`` squared rows at the end."""
    def partial(batches):
        total = np.zeros((rank, rank))
        for b in batches:
            v = b.column("features").flatten().to_numpy().astype(np.float64).reshape(-1, rank)
            total += v.T @ v
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rank * rank), pa.int64()), pa.array(total.ravel())],
            names=["at", "x"])
    out = np.zeros(rank * rank)
    for r in factors.select("features").mapInArrow(partial, "at long, x double") \
            .groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r["at"]] = r["x"]
    return out.reshape(rank, rank)


def user_residuals(model: ALSModel, train: DataFrame, params: ALSParams) -> DataFrame:
    """(user_id, ratings, residual, lowest): per user of ``train`` the relative residual of its
    factor, and the factor's smallest coordinate.  A user without a factor has residual null."""
    rank = model.rank
    u = model.userFactors.select(F.col("id").alias(USER_ID), F.col("features").alias("_x"))
    v = model.itemFactors.select(F.col("id").alias(ITEM_ID), F.col("features").alias("_v"))
    r = F.col(RATING).cast("float").cast("double")    # MLlib keeps ratings as floats
    rows = train.select(USER_ID, ITEM_ID, r.alias("_r")).join(v, ITEM_ID).join(u, USER_ID, "left")
    p = dot(F.col("_v"), F.col("_x"))
    if params.implicit:
        c = F.lit(params.alpha) * F.abs("_r")
        pull = c * p - F.when(F.col("_r") > 0, 1 + c).otherwise(0.0)
        weight, counted = c, F.when(F.col("_r") > 0, 1).otherwise(0)
    else:
        pull, weight, counted = p - F.col("_r"), F.lit(1.0), F.lit(1)
    rows = rows.select(USER_ID, "_v", "_x", pull.alias("_pull"), weight.cast("double").alias("_c"),
                       counted.alias("_n"))
    at = [F.get("_v", F.lit(k)).cast("double") for k in range(rank)]
    sums = rows.groupBy(USER_ID).agg(
        F.count(F.lit(1)).alias("ratings"), F.sum("_n").cast("double").alias("n"),
        F.any_value("_x").alias("x"),
        F.array(*(F.sum(F.col("_pull") * k) for k in at)).alias("g"),
        F.array(*(F.sum(F.col("_c") * k * k) for k in at)).alias("d"))
    whole = gram(model.itemFactors, rank) if params.implicit else np.zeros((rank, rank))
    reg, above_zero = params.reg_param, params.nonnegative

    def solve(batches):
        for b in batches:
            known = b.column("x").is_valid().to_numpy(zero_copy_only=False)
            some = b.filter(pa.array(known))

            def matrix(name):
                return some.column(name).flatten().to_numpy(zero_copy_only=False) \
                    .astype(np.float64).reshape(-1, rank)
            x, n = matrix("x"), some.column("n").to_numpy()[:, None]
            g = x @ whole + matrix("g") + reg * n * x
            a = np.diag(whole) + matrix("d") + reg * n
            with np.errstate(divide="ignore", invalid="ignore"):
                to = np.where(a > 0, x - g / a, x)
            to = np.maximum(to, 0) if above_zero else to
            size = np.maximum(np.abs(x).max(axis=1, initial=0), np.abs(to).max(axis=1, initial=0))
            move = np.abs(to - x).max(axis=1, initial=0)
            residual, lowest = np.full(b.num_rows, np.nan), np.full(b.num_rows, np.nan)
            residual[known] = np.where(size > 0, move / np.where(size > 0, size, 1), 0.0)
            lowest[known] = x.min(axis=1, initial=np.inf)
            yield pa.RecordBatch.from_arrays(
                [b.column(USER_ID), b.column("ratings"), pa.array(residual, from_pandas=True),
                 pa.array(lowest, from_pandas=True)],
                names=[USER_ID, "ratings", "residual", "lowest"])
    return sums.mapInArrow(solve, f"{USER_ID} int, ratings long, residual double, lowest double")


def fit_report(model: ALSModel, train: DataFrame, params: ALSParams,
               most: float = 1e-3) -> DataFrame:
    """users, ratings, unsolved (users without a factor or with a residual above ``most``) and
    below_zero (users with a negative coordinate where none is allowed)."""
    x = user_residuals(model, train, params)
    negative = F.coalesce(F.col("lowest") < 0, F.lit(False)) if params.nonnegative else F.lit(False)
    return x.agg(F.count(F.lit(1)).alias("users"), F.sum("ratings").alias("ratings"),
                 F.count_if(~F.coalesce(F.col("residual") <= most, F.lit(False))).alias("unsolved"),
                 F.count_if(negative).alias("below_zero"))
