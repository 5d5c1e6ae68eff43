"""Rating builders: the log -> (log columns + ``rating``) under a rating rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.functions.rating_rules import RULES, RatingRule
from ludeme.sources.schema import ACTION, ITEM, MEMBER, RATING


def _rule(rule: RatingRule | str) -> RatingRule:
    return RULES[rule] if isinstance(rule, str) else rule


def build_ratings(log: DataFrame, rule: RatingRule | str, pair_agg: str | None = None
                  ) -> DataFrame:
    """Apply a rating rule.

    ``pair_agg`` = None keeps one row per action (repeated (member, item) pairs
    reach the model as separate observations, as the notebook does);
    ``"sum"`` / ``"max"`` collapse them to one row per pair.  Collapsing also
    bounds the per-user row count by the catalogue size, which is the
    scale option for logs with very heavy users.
    """
    rule = _rule(rule)
    df = log
    if rule.keep is not None:
        df = df.filter(F.col(ACTION).isin(*rule.keep))
    df = df.withColumn(RATING, rule.expr())
    if pair_agg is None or pair_agg == "none":
        return df
    agg = {"sum": F.sum, "max": F.max}[pair_agg]
    # partial aggregation map-side: a hot member's rows are combined per task
    # before the shuffle, so no single reducer sees the raw hot group.
    return df.groupBy(MEMBER, ITEM).agg(agg(RATING).alias(RATING))


def ratings_play(log: DataFrame) -> DataFrame:
    return build_ratings(log, "play")


def ratings_combined(log: DataFrame) -> DataFrame:
    return build_ratings(log, "combined")


def ratings_log(log: DataFrame) -> DataFrame:
    return build_ratings(log, "log")


def rule_report(log: DataFrame, rule: RatingRule | str) -> DataFrame:
    """Rows per action, how many fall to the rule's ``otherwise`` branch, and how
    many get a NULL rating (e.g. log1p of a value <= -1)."""
    rule = _rule(rule)
    df = log if rule.keep is None else log.filter(F.col(ACTION).isin(*rule.keep))
    return (df.groupBy(ACTION)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(rule.unmapped()).alias("unmapped"),
                 F.count_if(rule.expr().isNull()).alias("null_ratings")))
