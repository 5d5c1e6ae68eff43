"""Model evaluation: RMSE (one aggregation), constant-predictor baselines
and ranking metrics (precision@k, MAP) without collecting
per-user lists to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludeme.functions.metrics import rmse
from ludeme.sources.schema import ITEM_ID, PREDICTION, RATING, USER_ID


def rmse_report(predictions: DataFrame, label: str = RATING,
                prediction: str = PREDICTION) -> DataFrame:
    """rmse and rows_scored in one pass; rmse is NULL (not an error) on zero rows.
    NaN predictions (cold rows under strategy 'nan') and NULL labels are excluded."""
    scored = predictions.filter(~F.isnan(F.col(prediction)))
    return scored.agg(rmse(label, prediction).alias("rmse"),
                      F.count(F.col(label) - F.col(prediction)).alias("rows_scored"))


def evaluate_rmse(predictions: DataFrame, label: str = RATING,
                  prediction: str = PREDICTION) -> tuple[float | None, int]:
    row = rmse_report(predictions, label, prediction).first()
    return (None if row["rmse"] is None else float(row["rmse"])), int(row["rows_scored"])


def baseline_rmse(train: DataFrame, test: DataFrame, label: str = RATING) -> DataFrame:
    """RMSE of two constant predictors on ``test``: always 0 (the RMS of the
    label) and always the train mean (one scalar aggregate, then a literal)."""
    m = train.agg(F.avg(label)).first()[0]
    m = F.lit(None).cast("double") if m is None else F.lit(float(m))
    y = F.col(label).cast("double")
    return test.agg(F.sqrt(F.avg(y * y)).alias("rmse_zero"),
                    F.sqrt(F.avg((y - m) * (y - m))).alias("rmse_mean"),
                    F.count(F.lit(1)).alias("rows"))


def relevant_pairs(test: DataFrame, threshold: float = 0.0, user_col: str = USER_ID,
                   item_col: str = ITEM_ID, label: str = RATING) -> DataFrame:
    """Distinct (user, item) pairs of the test split with label > threshold."""
    return (test.filter(F.col(label) > threshold).select(user_col, item_col).distinct())


def _metrics_from_hits(hits: DataFrame, relevant: DataFrame, k: int, user_col: str,
                       rank_col: str) -> DataFrame:
    w = Window.partitionBy(user_col).orderBy(rank_col)
    hits = hits.withColumn("_h", F.row_number().over(w))          # hits so far (<= k rows)
    per_user_hits = hits.groupBy(user_col).agg(
        F.count(F.lit(1)).alias("_hits"),
        F.sum(F.col("_h") / F.col(rank_col)).alias("_prec_sum"))
    n_rel = relevant.groupBy(user_col).agg(F.count(F.lit(1)).alias("_nrel"))
    per_user = n_rel.join(per_user_hits, user_col, "left").fillna(0, ["_hits", "_prec_sum"])
    return per_user.agg(
        F.lit(k).alias("k"),
        F.count(F.lit(1)).alias("users"),
        F.avg(F.col("_hits") / F.lit(float(k))).alias("precision_at_k"),
        F.avg(F.col("_prec_sum") / F.least(F.col("_nrel"), F.lit(k))).alias("map_at_k"))


def ranking_metrics(ranked: DataFrame, relevant: DataFrame, k: int,
                    user_col: str = USER_ID, item_col: str = ITEM_ID,
                    rank_col: str = "rank") -> DataFrame:
    """precision@k and mean average precision@k over users with >= 1 relevant item.

    ``ranked``: (user, item, rank 1..) recommendation rows; ``relevant``:
    distinct (user, item) truth pairs.  Hits are found by an equi-join on the
    pair (no per-user arrays), then a running hit count per user over <= k
    rows.  Matches MLlib's RankingEvaluator: precisionAtK divides by k, and
    AP@k divides the summed precisions by min(k, |relevant|).
    """
    top = ranked.filter(F.col(rank_col) <= k).select(user_col, item_col, rank_col)
    hits = top.join(relevant, [user_col, item_col], "inner")
    return _metrics_from_hits(hits, relevant, k, user_col, rank_col)


def popularity_top(train: DataFrame, n: int, item_col: str = ITEM_ID) -> DataFrame:
    """Top-n items by train interaction count, ties by id, with rank 1..n.
    (n rows: the window runs over the n-row top-k output only.)"""
    return (train.groupBy(item_col).agg(F.count(F.lit(1)).alias("_c"))
            .orderBy(F.desc("_c"), F.asc(item_col)).limit(n)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("_c"),
                                                                   F.asc(item_col))))
            .drop("_c"))


def popularity_metrics(train: DataFrame, relevant: DataFrame, k: int,
                       user_col: str = USER_ID, item_col: str = ITEM_ID) -> DataFrame:
    """ranking_metrics of the popularity list, computed by joining the truth
    pairs to the k-row list (broadcast, k rows) instead of copying the list to
    every user."""
    top = popularity_top(train, k, item_col)
    hits = relevant.join(F.broadcast(top), item_col, "inner")
    return _metrics_from_hits(hits, relevant, k, user_col, "rank")
