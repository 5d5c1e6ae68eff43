"""End-to-end plans: log -> ratings -> ids -> split -> ALS -> metrics / lists.

The notebook's three cases are one function with a rating rule.  The indexed,
split-tagged ratings are written once to the shared checkpoint folder, a folder
for each split, and every split reads only its own, so every model fit and evaluation after it starts
from a fixed, lineage-free table (executor loss costs a re-read, not a
re-derivation from the raw log).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.functions.rating_rules import RULES, RatingRule
from ludeme.operators.als import ALSParams, fit_als
from ludeme.operators.evaluate import rmse_report
from ludeme.operators.indexing import IndexModel, index_ratings
from ludeme.operators.ratings import build_ratings
from ludeme.operators.split import (SPLIT, default_key, entity_split, random_split, with_row_keys,
                                    with_split)
from ludeme.plans.session import ensure_checkpoint_dir, materialize
from ludeme.sources.schema import ITEM_ID, PREDICTION, RATING, ROW_KEY, USER_ID


@dataclass
class Prepared:
    rule: RatingRule
    users: IndexModel
    items: IndexModel
    data: DataFrame          # indexed ratings + split tag (written table)
    train: DataFrame
    test: DataFrame
    rows: int                # rating rows (for block sizing)
    validation: DataFrame | None = None   # set by a three-way split


def prepare(log: DataFrame, rule: RatingRule | str, *, split: str = "hash",
            weights: Sequence[float] = (0.8, 0.2), seed: int = 42, by: str = "row",
            pair_agg: str | None = None, handle_invalid: str = "error") -> Prepared:
    """Ratings under ``rule`` -> dense ids -> split, written once.

    ``split``: ``hash`` (by row or pair), ``random``, or ``entity``, which holds out whole users
    and items (half of the last weight of each).  A log without row ids gets some for the hash split.
    Three weights give train / validation / test: tune on validation, then
    score the chosen model on test once (the notebook picks its trial on the
    test split itself)."""
    rule = RULES[rule] if isinstance(rule, str) else rule
    ensure_checkpoint_dir(log.sparkSession)
    if split == "hash" and by == "row" and pair_agg is None and ROW_KEY not in log.columns:
        log = with_row_keys(log)    # equal rows fall on both sides
    # A NULL rating (no value, or the log of a value of -1 or less) would end every fit.
    ratings = build_ratings(log, rule, pair_agg).filter(F.col(RATING).isNotNull())
    key = default_key(ratings, by)
    ir = index_ratings(ratings, handle_invalid=handle_invalid)
    labels = [ir.users.input_col] if split == "entity" else []
    keep = [c for c in dict.fromkeys([*key, *labels, USER_ID, ITEM_ID, RATING,
                                      ir.users.input_col, ir.items.input_col])
            if c in ir.df.columns]
    names = ("train", "test") if len(weights) == 2 else ("train", "validation", "test")
    if len(weights) not in (2, 3):
        raise ValueError("weights: (train, test) or (train, validation, test)")
    if split == "hash":
        data = with_split(ir.df.select(*keep), weights, names, seed, key)
        data = materialize(data, "prepared", SPLIT)
        parts = [data.filter(F.col(SPLIT) == n).drop(SPLIT) for n in names]
    elif split == "entity":
        share = weights[-1] / sum(weights) / 2    # of the users, and of the items
        data = entity_split(ir.df.select(*keep), share, share, seed, ir.users.input_col,
                            ir.items.input_col)
        data = materialize(data, "prepared", SPLIT)
        names = ("train", "test")
        parts = [data.filter(F.col(SPLIT) == n).drop(SPLIT) for n in names]
    elif split == "random":
        data = materialize(ir.df.select(*keep), "prepared")
        parts = random_split(data, weights, seed)
    else:
        raise ValueError(f"unknown split {split!r}")
    validation = parts[1] if len(parts) == 3 else None
    return Prepared(rule, ir.users, ir.items, data, parts[0], parts[-1], ir.users.rows,
                    validation)


@dataclass
class VariantResult:
    name: str
    params: ALSParams
    model: ALSModel
    predictions: DataFrame
    report: DataFrame        # one row: rmse, rows_scored


def run_variant(prep: Prepared, params: ALSParams, name: str | None = None) -> VariantResult:
    model = fit_als(prep.train, params, rows=prep.rows)
    pred = model.transform(prep.test)
    return VariantResult(name or prep.rule.name, params, model, pred, rmse_report(pred))


def variant_row(res: VariantResult, prep: Prepared) -> DataFrame:
    """rmse, rows_scored, the zero-predictor RMSE on the same scored rows and
    their ratio (the label scales of the variants differ, so only the ratio
    compares across them)."""
    scored = res.predictions.filter(~F.isnan(F.col(PREDICTION)))
    y = F.col(RATING).cast("double")
    d = y - F.col(PREDICTION).cast("double")
    return scored.agg(
        F.lit(res.name).alias("variant"),
        F.lit(res.params.rank).alias("rank"),
        F.lit(float(res.params.reg_param)).alias("reg_param"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.count(d).alias("rows_scored"),
        F.sqrt(F.avg(y * y)).alias("rmse_zero"),
    ).withColumn("rmse_ratio", F.col("rmse") / F.col("rmse_zero"))


__all__ = ["Prepared", "prepare", "VariantResult", "run_variant", "variant_row"]
