"""Alternating-least-squares models (MLlib) with explicit seeds and sized blocks.

MLlib's ALS is already a distributed block solver: ratings are partitioned
into user and item blocks, each half-iteration ships factor blocks to the
blocks that need them.  What we choose is the block counts (from the number of
ratings alone, as MLlib draws the first factors per block: the same data and
parameters give the same model on any cluster), the seed (always set), the
checkpoint interval (lineage of long runs is cut into the shared checkpoint
folder) and storage levels.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.plans.session import ensure_checkpoint_dir
from ludeme.sources.schema import ITEM_ID, RATING, USER_ID


@dataclass(frozen=True)
class ALSParams:
    rank: int = 10
    reg_param: float = 0.01
    max_iter: int = 5
    implicit: bool = True
    alpha: float = 1.0
    nonnegative: bool = True
    seed: int = 42
    cold_start: str = "drop"
    num_blocks: int | None = None    # user blocks; one per BLOCK_ROWS ratings if not given
    item_blocks: int | None = None   # few, and no more than user blocks, if not given
    checkpoint_interval: int = 10

    def with_(self, **kw) -> "ALSParams":
        return replace(self, **kw)

    def as_dict(self) -> dict:
        return asdict(self)


# The notebook's three implicit variants and the README's explicit one.
PLAY_PARAMS = ALSParams(rank=10, reg_param=0.01, max_iter=5)
COMBINED_PARAMS = ALSParams(rank=10, reg_param=0.01, max_iter=5)
LOG_PARAMS = ALSParams(rank=15, reg_param=0.001, max_iter=5)
EXPLICIT_PARAMS = ALSParams(rank=10, reg_param=0.1, max_iter=10, implicit=False,
                            nonnegative=False)


BLOCK_ROWS = 100_000    # ratings of a user block
ITEM_BLOCKS = 8         # item blocks, if their ratings fit
ITEM_BLOCK_ROWS = 4_000_000    # ratings of an item block: 32 MB and the factors of their users


def sized(params: ALSParams, rows: int) -> ALSParams:
    """``params`` with block counts: those given, or a user block per ``BLOCK_ROWS`` ratings and
    ``ITEM_BLOCKS`` item blocks (no more than user blocks, and one per ``ITEM_BLOCK_ROWS`` ratings
    at least).

    A half-step ships a user's factor once to every item block that holds an item of theirs, and
    MLlib's top-N pairs all blocks: with both counts growing, its work would grow faster than the
    ratings.  The first factors that a fit uses are the users' alone, so the item blocks do not
    change the model."""
    blocks = params.num_blocks or max(1, -(-rows // BLOCK_ROWS))
    few = min(blocks, max(ITEM_BLOCKS, -(-rows // ITEM_BLOCK_ROWS)))
    return params.with_(num_blocks=blocks, item_blocks=params.item_blocks or few)


def make_als(params: ALSParams, user_col: str = USER_ID, item_col: str = ITEM_ID,
             rating_col: str = RATING) -> ALS:
    if params.num_blocks is None:
        raise ValueError("block counts are not set: see sized()")
    return ALS(userCol=user_col, itemCol=item_col, ratingCol=rating_col,
               rank=params.rank, regParam=params.reg_param, maxIter=params.max_iter,
               implicitPrefs=params.implicit, alpha=params.alpha,
               nonnegative=params.nonnegative, seed=params.seed,
               coldStartStrategy=params.cold_start,
               numUserBlocks=params.num_blocks,
               numItemBlocks=params.item_blocks or params.num_blocks,
               checkpointInterval=params.checkpoint_interval,
               intermediateStorageLevel="MEMORY_AND_DISK",
               finalStorageLevel="MEMORY_AND_DISK")


def fit_als(train: DataFrame, params: ALSParams, rows: int | None = None, **cols) -> ALSModel:
    """``rows``: the ratings that block counts are set by; counted if not given."""
    ensure_checkpoint_dir(train.sparkSession)
    if params.num_blocks is None:
        params = sized(params, train.count() if rows is None else rows)
    return make_als(params, **cols).fit(train)


def factor_tables(model: ALSModel) -> DataFrame:
    """User and item latent factors in one table: side, id, features array<float>."""
    return (model.userFactors.select(F.lit("user").alias("side"), "id", "features")
            .unionByName(model.itemFactors.select(F.lit("item").alias("side"), "id",
                                                  "features")))


def cold_start_report(model: ALSModel, df: DataFrame, user_col: str = USER_ID,
                      item_col: str = ITEM_ID) -> DataFrame:
    """How many rows the cold-start strategy would drop, and why, in one pass.

    Joins the rows to the factor id lists (one row per user / item; Catalyst
    picks broadcast or shuffle by size) instead of scoring them.
    """
    users = model.userFactors.select(F.col("id").alias(user_col), F.lit(True).alias("_u"))
    items = model.itemFactors.select(F.col("id").alias(item_col), F.lit(True).alias("_i"))
    j = df.join(users, user_col, "left").join(items, item_col, "left")
    u_cold, i_cold = F.col("_u").isNull(), F.col("_i").isNull()
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(~u_cold & ~i_cold).alias("scored"),
                 F.count_if(u_cold | i_cold).alias("dropped"),
                 F.count_if(u_cold).alias("unseen_user"),
                 F.count_if(i_cold).alias("unseen_item"))


__all__ = ["ALSParams", "PLAY_PARAMS", "COMBINED_PARAMS", "LOG_PARAMS", "EXPLICIT_PARAMS",
           "BLOCK_ROWS", "ITEM_BLOCKS", "ITEM_BLOCK_ROWS", "sized", "make_als", "fit_als", "factor_tables", "cold_start_report"]
