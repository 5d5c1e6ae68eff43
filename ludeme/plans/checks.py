"""Companions of the model queries with columns that SQL can derive.

A factorisation cannot be written in SQL, but much of what comes out of it can be
checked: which ids have factors, which rows are scored and that a score is the
product of the stored factors, the shape and order of the lists, the trials of
the grid.  Every column is computed from the real output of the query's operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludeme.functions.metrics import dot
from ludeme.operators import evaluate, hybrid, recommend, split
from ludeme.operators.als import (COMBINED_PARAMS, EXPLICIT_PARAMS, LOG_PARAMS, PLAY_PARAMS,
                                  factor_tables)
from ludeme.operators.fit_check import fit_report
from ludeme.operators.tune import best_trial
from ludeme.plans import queries as q
from ludeme.plans.oracle import INDEXED, LOG
from ludeme.plans.session import scratch_path
from ludeme.sources.interactions import lineitem_log, read_interactions_csv
from ludeme.sources.schema import (ACTION, ITEM, ITEM_ID, MEMBER, PREDICTION, PURCHASE, RATING,
                                   ROW_KEY, USER_ID, VALUE)

VARIANTS = (("play", "play", PLAY_PARAMS), ("combined", "combined", COMBINED_PARAMS),
            ("log", "log", LOG_PARAMS), ("explicit", "raw", EXPLICIT_PARAMS))


def _finite(c):
    c = F.col(c)
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))


def _shape(lists: DataFrame, score: str = recommend.SCORE, rank: str = recommend.RANK) -> DataFrame:
    """Per user: rows, distinct titles, rows whose score is above their predecessor's."""
    before = F.lag(score).over(Window.partitionBy(USER_ID).orderBy(rank))
    return lists.withColumn("_up", F.col(score) > before).groupBy(USER_ID).agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct(ITEM).alias("distinct_items"),
        F.count_if(F.coalesce("_up", F.lit(False))).alias("misordered"))


def als_fit_check(spark, sf_dir):
    """Per variant: users whose factor does not solve its own equations, or has a coordinate
    below zero where none may be."""
    out = None
    for name, rule, params in VARIANTS:
        one = fit_report(q.variant(spark, sf_dir, rule, params, name).model,
                         q.prepared(spark, sf_dir, rule).train, params).select(
            F.lit(name).alias("variant"), "users", "ratings", "unsolved", "below_zero")
        out = one if out is None else out.unionByName(one)
    return out


def tuning_ledger_check(spark, sf_dir):
    """What a run's ledger holds after it was begun with three trials and resumed, each trial's
    score on the validation split, and whether its bundle can be read as it was committed."""
    ledger, result, p = q.validated(spark, sf_dir)
    scored = result.trials.select("trial", "rows_scored", _finite("rmse").alias("rmse_finite"))
    rows = ledger.rows()
    whole = [(r["trial"], ledger.bundle(r["run_id"], r["trial"]).params.max_iter == r["max_iter"]
              and ledger.bundle(r["run_id"], r["trial"]).items.size == p.items.size,
              r["trial"] in result.resumed) for r in rows.collect()]
    read = spark.createDataFrame(whole, "trial int, bundle_whole boolean, resumed boolean")
    return rows.join(read, "trial").join(scored, "trial").select(
        "run_id", "variant", "trial", "rank", "reg_param", "max_iter", "seed", "bundle_whole",
        "resumed", "rows_scored", "rmse_finite")


def validated_test_check(spark, sf_dir):
    """Trials with a score on the test split: the best on the validation split alone."""
    v = q.q_tuning_validated(spark, sf_dir)
    best = v.orderBy(F.asc_nulls_last("rmse"), "trial").limit(1).select(F.col("trial").alias("_t"))
    on = F.col("test_rows").isNotNull()
    return v.join(F.broadcast(best), F.col("trial") == F.col("_t"), "left").agg(   # one row
        F.count_if(on).alias("tested"), F.count_if(on & F.col("_t").isNotNull()).alias("tested_best"),
        F.max("test_rows").alias("test_rows"))


def split_by_content(spark, sf_dir):
    """A log without row ids, keyed by content and a running number among equal rows."""
    log = q.log_of(spark, sf_dir).select(MEMBER, ITEM, ACTION)
    return split.with_split(split.with_row_keys(log)).select(ROW_KEY, MEMBER, ITEM, ACTION,
                                                             split.SPLIT)


def als_rmse_check(spark, sf_dir):
    out = None
    for name, rule, params in VARIANTS:
        one = q.variant(spark, sf_dir, rule, params, name).report.select(
            F.lit(name).alias("variant"), "rows_scored", _finite("rmse").alias("rmse_finite"))
        out = one if out is None else out.unionByName(one)
    return out


def als_factors_check(spark, sf_dir):
    f = factor_tables(q.variant(spark, sf_dir, "log", LOG_PARAMS, "log").model)
    return f.groupBy("side").agg(
        F.count_distinct("id").alias("ids"), F.min(F.size("features")).alias("shortest"),
        F.max(F.size("features")).alias("longest"),
        F.count_if(F.exists("features", lambda x: x < 0)).alias("with_negative"))


def als_predictions_check(spark, sf_dir):
    res = q.variant(spark, sf_dir, "log", LOG_PARAMS, "log")
    u = res.model.userFactors.select(F.col("id").alias(USER_ID), F.col("features").alias("_u"))
    i = res.model.itemFactors.select(F.col("id").alias(ITEM_ID), F.col("features").alias("_i"))
    product = dot(F.col("_u"), F.col("_i"))
    near = F.abs(F.col(PREDICTION) - product) <= 1e-5 * F.greatest(F.lit(1.0), F.abs(product))
    return res.predictions.join(u, USER_ID).join(i, ITEM_ID).select(
        ROW_KEY, USER_ID, ITEM_ID, F.round(RATING, q.D6).alias(RATING), near.alias("is_product"))


def variant_comparison_check(spark, sf_dir):
    v = q.q_variant_comparison(spark, sf_dir)
    ratio = F.abs(F.col("rmse_ratio") * F.col("rmse_zero") - F.col("rmse")) < 1e-9
    return v.select("variant", "rank", "reg_param", "rows_scored",
                    F.round("rmse_zero", q.D6).alias("rmse_zero"), ratio.alias("ratio_holds"))


def tuning_check(spark, sf_dir):
    return q.tuned(spark, sf_dir).trials.select(
        "variant", "trial", "rank", "reg_param", "max_iter", "seed", "rows_scored",
        _finite("rmse").alias("rmse_finite"))


def best_trial_check(spark, sf_dir):
    trials = q.tuned(spark, sf_dir).trials
    best = best_trial(trials).select(F.col("trial").alias("_t"), F.col("rmse").alias("_r"))
    beats = (F.col("rmse") < F.col("_r")) | ((F.col("rmse") == F.col("_r"))
                                             & (F.col("trial") < F.col("_t")))
    return trials.join(F.broadcast(best), F.col("trial") >= 0).agg(   # best: one row
        F.count_distinct("_t").alias("best_trials"), F.count(F.lit(1)).alias("trials"),
        F.count_if(beats).alias("better_trials"), F.max("rows_scored").alias("rows_scored"))


def split_random_check(spark, sf_dir):
    s = q.q_split_random(spark, sf_dir)
    per = s.groupBy(ROW_KEY).agg(F.count_distinct(split.SPLIT).alias("sides"),
                                 F.count_if(F.col(split.SPLIT) == "train").alias("train"),
                                 F.count(F.lit(1)).alias("n"))
    share = F.sum("train") / F.sum("n")
    return per.agg(F.sum("n").alias("rows"), F.count_if(F.col("sides") > 1).alias("on_both"),
                   (F.abs(share - 0.8) < 0.02).alias("share_holds"))


def _lists(spark, sf_dir, users=None):
    p = q.prepared(spark, sf_dir, "log")
    model = q.best_model(spark, sf_dir)
    recs = (recommend.recommend_all(model, q.TOP_N) if users is None
            else recommend.recommend_for(model, users, q.TOP_N))
    return recommend.attach_titles(recommend.flatten(recs), p.items)


def recs_all_users_check(spark, sf_dir):
    return _shape(_lists(spark, sf_dir))


def recs_exact_check(spark, sf_dir):
    """Lists of the blocked top-N against MLlib's own scorer, place by place: users, and places
    whose scores differ by more than single precision allows or that only one of them has."""
    model = q.best_model(spark, sf_dir)
    own = recommend.flatten(recommend.recommend_all(model, q.TOP_N))
    other = recommend.flatten(model.recommendForAllUsers(q.TOP_N)).select(
        F.col(USER_ID).alias("_u"), F.col(recommend.RANK).alias("_r"), F.col(recommend.SCORE).alias("_s"))
    near = F.abs(F.col(recommend.SCORE) - F.col("_s")) <= 1e-5 * F.greatest(F.abs("_s"), F.lit(1.0))
    both = own.join(other, (F.col(USER_ID) == F.col("_u")) & (F.col(recommend.RANK) == F.col("_r")),
                    "full")
    return both.agg(F.count_distinct(USER_ID).alias("users"),
                    F.count_if(~F.coalesce(near, F.lit(False))).alias("differing"))


def recs_for_users_check(spark, sf_dir):
    one = spark.createDataFrame([(0,)], f"{USER_ID} int")
    return _shape(_lists(spark, sf_dir, one))


def recs_unseen_check(spark, sf_dir):
    recs = q.q_recs_unseen(spark, sf_dir)
    seen = q.prepared(spark, sf_dir, "log").train.select(USER_ID, ITEM).distinct()
    again = recs.join(seen, [USER_ID, ITEM], "left_semi").groupBy(USER_ID).agg(
        F.count(F.lit(1)).alias("_again"))
    return _shape(recs).join(again, USER_ID, "left").select(
        USER_ID, "items", "distinct_items", "misordered",
        F.coalesce("_again", F.lit(0)).cast("long").alias("seen_items"))


def ranking_metrics_check(spark, sf_dir):
    m = q.q_ranking_metrics(spark, sf_dir)
    return m.select("k", "users", F.col("precision_at_k").between(0, 1).alias("precision_in_range"),
                    F.col("map_at_k").between(0, 1).alias("map_in_range"))


def hybrid_recs_check(spark, sf_dir):
    h = q.q_hybrid_recs(spark, sf_dir)
    blend = 0.7 * F.col(recommend.SCORE) + 0.3 * F.coalesce(hybrid.CONTENT, F.lit(0.0))
    off = h.filter(F.abs(F.col(hybrid.HYBRID) - blend) > 1e-6).groupBy(USER_ID).agg(
        F.count(F.lit(1)).alias("_off"))
    return _shape(h, hybrid.HYBRID, "hybrid_rank").join(off, USER_ID, "left").select(
        USER_ID, "items", "distinct_items", "misordered",
        F.coalesce("_off", F.lit(0)).cast("long").alias("not_blended"))


def csv_round_trip(spark, sf_dir):
    """The log written as headerless CSV and scanned with the declared schema."""
    path = scratch_path(spark, "csv")
    q.log_of(spark, sf_dir).select(MEMBER, ITEM, ACTION, VALUE).write \
        .option("escape", '"').csv(path)
    return read_interactions_csv(spark, path)


def top_purchase_count(spark, sf_dir):
    """Items by number of purchases (the sum of ``value`` where each purchase has 1)."""
    return q.actions_of(spark, sf_dir).filter(F.col(ACTION) == PURCHASE).groupBy(ITEM).agg(
        F.count(F.lit(1)).alias("purchases")).orderBy(F.desc("purchases"), ITEM).limit(q.TOP_N)


def load_lineitem(spark, sf_dir):
    return lineitem_log(spark, sf_dir)


def split_hash_lineitem(spark, sf_dir):
    return split.with_split(lineitem_log(spark, sf_dir)).select(ROW_KEY, split.SPLIT)


QUERIES = {f.__name__: f for f in (
    als_fit_check, tuning_ledger_check, validated_test_check, split_by_content,
    als_rmse_check, als_factors_check, als_predictions_check, variant_comparison_check,
    tuning_check, best_trial_check, split_random_check, recs_all_users_check, recs_exact_check,
    recs_for_users_check, recs_unseen_check, ranking_metrics_check, hybrid_recs_check,
    csv_round_trip, top_purchase_count, load_lineitem, split_hash_lineitem)}

_SCORED = LOG + """,
s AS (SELECT *, CASE WHEN (('0x' || substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8))::BIGINT
                           % 1000000) < 800000 THEN 'train' ELSE 'test' END AS split FROM log),
v AS (
  SELECT 'play' AS variant, s.*, value AS rating FROM s WHERE behaviour = 'play'
  UNION ALL SELECT 'combined', s.*, CASE WHEN behaviour = 'purchase' THEN 1.0 ELSE value END FROM s
  UNION ALL SELECT 'log', s.*, CASE WHEN behaviour = 'purchase' THEN 1.0 ELSE ln(1 + value) END
            FROM s
  UNION ALL SELECT 'explicit', s.*, value FROM s),
tu AS (SELECT DISTINCT variant, member_id FROM v WHERE split = 'train' AND rating IS NOT NULL),
ti AS (SELECT DISTINCT variant, game FROM v WHERE split = 'train' AND rating IS NOT NULL),
sc AS (SELECT v.* FROM v JOIN tu USING (variant, member_id) JOIN ti USING (variant, game)
       WHERE v.split = 'test' AND v.rating IS NOT NULL)"""

_TRAIN = INDEXED + """,
tu AS (SELECT DISTINCT user_id FROM r WHERE split = 'train'),
ti AS (SELECT DISTINCT game_id FROM r WHERE split = 'train'),
ni AS (SELECT count(*) AS n FROM ti)"""

_LINES = """l AS (
  SELECT l.*, o.o_custkey, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber, l_partkey, l_quantity ORDER BY o_custkey) AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
k AS (
  SELECT *, concat_ws('-', coalesce(CAST(l_orderkey AS VARCHAR), ''),
                      coalesce(CAST(l_linenumber AS VARCHAR), ''),
                      coalesce(CAST(l_partkey AS VARCHAR), ''),
                      coalesce(CAST(l_quantity AS VARCHAR), ''), CAST(n AS VARCHAR)) AS event_id
  FROM l)"""

_LIST = """least(10, ni.n) AS items, least(10, ni.n) AS distinct_items,
       CAST(0 AS BIGINT) AS misordered"""

_VALIDATED = INDEXED + """,
b AS (SELECT *, ('0x' || substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 1000000
             AS bucket FROM r WHERE rating IS NOT NULL),
tu AS (SELECT DISTINCT user_id FROM b WHERE bucket < 700000),
ti AS (SELECT DISTINCT game_id FROM b WHERE bucket < 700000),
sc AS (SELECT b.* FROM b JOIN tu USING (user_id) JOIN ti USING (game_id))"""

ORACLE_SQL = {
    "als_fit_check": f"""WITH {_SCORED}
SELECT variant, count(DISTINCT member_id) AS users, count(*) AS ratings,
       CAST(0 AS BIGINT) AS unsolved, CAST(0 AS BIGINT) AS below_zero
FROM v WHERE split = 'train' AND rating IS NOT NULL GROUP BY variant""",
    "tuning_ledger_check": f"""WITH {_VALIDATED},
g AS (SELECT * FROM (VALUES (5), (15)) a(rank),
             (VALUES (CAST(0.01 AS DOUBLE)), (0.1)) b(reg_param), (VALUES (5), (10)) c(max_iter)),
t AS (SELECT *, CAST(row_number() OVER (ORDER BY rank, reg_param, max_iter) - 1 AS INTEGER) AS trial
      FROM g),
n AS (SELECT count(*) AS n FROM sc WHERE bucket >= 700000 AND bucket < 800000)
SELECT 'grid' AS run_id, 'log' AS variant, trial, rank, reg_param, max_iter,
       CAST(42 AS BIGINT) AS seed, true AS bundle_whole, trial < 3 AS resumed, n.n AS rows_scored,
       true AS rmse_finite
FROM t, n""",
    "validated_test_check": f"""WITH {_VALIDATED}
SELECT CAST(1 AS BIGINT) AS tested, CAST(1 AS BIGINT) AS tested_best, count(*) AS test_rows
FROM sc WHERE bucket >= 800000""",
    "split_by_content": rf"""WITH {LOG},
k AS (SELECT member_id, game, behaviour, row_number() OVER (PARTITION BY member_id, game, behaviour)
             AS n FROM log),
e AS (SELECT member_id, game, behaviour, concat_ws('|', CAST(member_id AS VARCHAR),
        coalesce(regexp_replace(game, '([\\|])', '\\\1', 'g'), '\N'), behaviour,
        CAST(n AS VARCHAR)) AS event_id FROM k)
SELECT *, CASE WHEN (('0x' || substr(md5('42|' || event_id), 1, 8))::BIGINT % 1000000) < 800000
               THEN 'train' ELSE 'test' END AS split FROM e""",
    "als_rmse_check": f"""WITH {_SCORED}
SELECT variant, count(*) AS rows_scored, true AS rmse_finite FROM sc GROUP BY variant""",
    "als_factors_check": f"""WITH {_TRAIN}
SELECT 'user' AS side, count(*) AS ids, 15 AS shortest, 15 AS longest,
       CAST(0 AS BIGINT) AS with_negative FROM tu
UNION ALL SELECT 'item', count(*), 15, 15, 0 FROM ti""",
    "als_predictions_check": f"""WITH {_TRAIN}
SELECT event_id, user_id, game_id, ROUND(rating, 6) AS rating, true AS is_product
FROM r JOIN tu USING (user_id) JOIN ti USING (game_id) WHERE split = 'test'""",
    "variant_comparison_check": f"""WITH {_SCORED}
SELECT variant, CASE variant WHEN 'log' THEN 15 ELSE 10 END AS rank,
       CAST(CASE variant WHEN 'log' THEN 0.001 ELSE 0.01 END AS DOUBLE) AS reg_param,
       count(*) AS rows_scored, ROUND(sqrt(avg(rating * rating)), 6) AS rmse_zero,
       true AS ratio_holds
FROM sc WHERE variant <> 'explicit' GROUP BY variant""",
    "tuning_check": f"""WITH {_SCORED},
g AS (SELECT * FROM (VALUES (5), (10), (15)) a(rank),
             (VALUES (CAST(0.001 AS DOUBLE)), (0.01), (0.1)) b(reg_param)),
n AS (SELECT count(*) AS n FROM sc WHERE variant = 'log')
SELECT 'log' AS variant,
       CAST(row_number() OVER (ORDER BY rank, reg_param) - 1 AS INTEGER) AS trial, rank,
       reg_param, 5 AS max_iter, CAST(42 AS BIGINT) AS seed, n.n AS rows_scored,
       true AS rmse_finite
FROM g, n""",
    "best_trial_check": f"""WITH {_SCORED}
SELECT CAST(1 AS BIGINT) AS best_trials, CAST(9 AS BIGINT) AS trials,
       CAST(0 AS BIGINT) AS better_trials, count(*) AS rows_scored
FROM sc WHERE variant = 'log'""",
    "split_random_check": f"""WITH {LOG}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS on_both, true AS share_holds FROM log""",
    "recs_all_users_check": f"WITH {_TRAIN} SELECT user_id, {_LIST} FROM tu, ni",
    "recs_exact_check": f"""WITH {_TRAIN}
SELECT count(*) AS users, CAST(0 AS BIGINT) AS differing FROM tu""",
    "recs_for_users_check": f"WITH {_TRAIN} SELECT user_id, {_LIST} FROM tu, ni WHERE user_id = 0",
    "recs_unseen_check": f"""WITH {_TRAIN},
c AS (SELECT user_id, least(10, any_value(ni.n) - count(DISTINCT game_id)) AS items
      FROM r, ni WHERE split = 'train' GROUP BY user_id)
SELECT user_id, items, items AS distinct_items, CAST(0 AS BIGINT) AS misordered,
       CAST(0 AS BIGINT) AS seen_items
FROM c WHERE items > 0""",
    "ranking_metrics_check": f"""WITH {INDEXED}
SELECT 10 AS k, count(DISTINCT user_id) AS users, true AS precision_in_range, true AS map_in_range
FROM r WHERE split = 'test' AND rating > 0""",
    "hybrid_recs_check": f"""WITH {_TRAIN}
SELECT user_id, {_LIST}, CAST(0 AS BIGINT) AS not_blended FROM tu, ni""",
    "csv_round_trip": f"""WITH {LOG}
SELECT CAST(member_id AS INTEGER) AS member_id, game, behaviour, value FROM log""",
    "top_purchase_count": f"""WITH {LOG}
SELECT game, count(*) AS purchases FROM log WHERE behaviour = 'purchase'
GROUP BY game ORDER BY purchases DESC, game LIMIT 10""",
    "load_lineitem": f"""WITH {_LINES}
SELECT event_id, o_custkey AS member_id, 'part-' || CAST(l_partkey AS VARCHAR) AS game,
       'play' AS behaviour, l_quantity AS value FROM k""",
    "split_hash_lineitem": f"""WITH {_LINES}
SELECT event_id, CASE WHEN (('0x' || substr(md5('42|' || event_id), 1, 8))::BIGINT % 1000000)
                           < 800000 THEN 'train' ELSE 'test' END AS split FROM k""",
}
