"""The query registry: one callable (spark, sf_dir) -> DataFrame per operator,
and the equivalent DuckDB SQL where the result is SQL-expressible.

All queries read the supplied tables through the ``events`` binding of the
interaction log (see :func:`ludeme.sources.interactions.events_log`), over the
whole table.  Doubles that two engines may sum in a different order are
rounded to 6 places in both forms.

Fitted state (dictionaries, checkpointed splits, ALS models) is shared across
queries of the same session and input folder, so the registry fits each
model once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludeme.operators import (evaluate, hybrid, neighbours, profile, ratings, recommend, split,
                              toplists)
from ludeme.operators.als import (COMBINED_PARAMS, EXPLICIT_PARAMS, LOG_PARAMS, PLAY_PARAMS,
                                  ALSParams, cold_start_report, factor_tables)
from ludeme.operators.indexing import fit_index
from ludeme.operators.joins import lookup_join
from ludeme.operators.tune import TrialLedger, best_trial, param_grid, tune
from ludeme.plans.pipelines import Prepared, VariantResult, prepare, run_variant, variant_row
from ludeme.plans.session import scratch_path
from ludeme.sources.interactions import events_log, table
from ludeme.sources.schema import ITEM, ITEM_ID, MEMBER, PREDICTION, RATING, ROW_KEY, USER_ID

D6 = 6          # rounding digits for doubles compared across engines
TOP_N = 10

_CACHE: dict = {}


def _key(spark: SparkSession, sf_dir: str, *parts) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), *parts)


def _cached(spark, sf_dir, parts, make):
    k = _key(spark, sf_dir, *parts)
    if k not in _CACHE:
        _CACHE[k] = make()
    return _CACHE[k]


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log(spark, sf_dir)


def actions_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in a form whose filters on one action reach the scan."""
    return events_log(spark, sf_dir, branches=True)


def clear_cache(spark: SparkSession) -> None:
    """Forgets what was fitted in this application; written copies stay."""
    for k in [k for k in _CACHE if k[0] == spark.sparkContext.applicationId]:
        del _CACHE[k]


def prepared(spark: SparkSession, sf_dir: str, rule: str, split: str = "hash",
             weights: tuple[float, ...] = (0.8, 0.2)) -> Prepared:
    return _cached(spark, sf_dir, ("prep", rule, split, weights),
                   lambda: prepare(log_of(spark, sf_dir), rule, split=split, weights=weights))


def variant(spark: SparkSession, sf_dir: str, rule: str, params: ALSParams,
            name: str | None = None) -> VariantResult:
    return _cached(spark, sf_dir, ("variant", rule, params),
                   lambda: run_variant(prepared(spark, sf_dir, rule), params, name))


def tuned(spark: SparkSession, sf_dir: str):
    def make():
        p = prepared(spark, sf_dir, "log")
        return tune(p.train, p.test, param_grid(LOG_PARAMS), variant="log",
                    rows=p.rows)
    return _cached(spark, sf_dir, ("tune", "log"), make)


#: Tuned on a validation split, iterations an axis of the grid.
VALIDATED_SPLIT = (0.7, 0.1, 0.2)
VALIDATED_GRID = {"ranks": (5, 15), "regs": (0.01, 0.1), "iters": (5, 10)}


def validated(spark: SparkSession, sf_dir: str):
    """(ledger, result, prepared) of a run that is begun with some of its trials and then resumed."""
    def make():
        p = prepared(spark, sf_dir, "log", weights=VALIDATED_SPLIT)
        ledger = TrialLedger(spark, scratch_path(spark, "ledger"))
        grid = param_grid(LOG_PARAMS, **VALIDATED_GRID)
        own = {"variant": "log", "rows": p.rows, "ledger": ledger, "run_id": "grid",
               "users": p.users, "items": p.items}
        tune(p.train, p.validation, grid[:3], **own)
        return ledger, tune(p.train, p.validation, grid, **own), p
    return _cached(spark, sf_dir, ("validated", "log"), make)


def best_model(spark: SparkSession, sf_dir: str):
    return tuned(spark, sf_dir).best()[2]


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), D6) for c in cols})


# ---------------------------------------------------------------- sources / profile

def q_load_interactions(spark, sf_dir):
    return log_of(spark, sf_dir)


def q_preview(spark, sf_dir):
    return profile.preview(log_of(spark, sf_dir), TOP_N, [ROW_KEY])


def q_schema_report(spark, sf_dir):
    return profile.schema_report(log_of(spark, sf_dir))


def q_dataset_profile(spark, sf_dir):
    return profile.dataset_profile(log_of(spark, sf_dir))


def q_behaviour_counts(spark, sf_dir):
    return profile.behaviour_counts(log_of(spark, sf_dir))


def q_null_audit(spark, sf_dir):
    return profile.null_audit(log_of(spark, sf_dir))


def q_playtime_stats(spark, sf_dir):
    return _r6(profile.playtime_stats(actions_of(spark, sf_dir)), "mean", "stddev")


def q_clean_interactions(spark, sf_dir):
    return profile.clean_interactions(log_of(spark, sf_dir))


def _view(spark, sf_dir) -> str:
    return toplists.register_view(actions_of(spark, sf_dir), "interactions")


def q_sql_top_played(spark, sf_dir):
    return toplists.sql_top_played(spark, _view(spark, sf_dir), TOP_N, D6)


def q_sql_top_purchased(spark, sf_dir):
    return toplists.sql_top_purchased(spark, _view(spark, sf_dir), TOP_N, D6)


# ---------------------------------------------------------------- ratings / ids / split

def q_ratings_play(spark, sf_dir):
    return ratings.ratings_play(actions_of(spark, sf_dir)).select(ROW_KEY, MEMBER, ITEM, RATING)


def q_ratings_combined(spark, sf_dir):
    return (ratings.ratings_combined(log_of(spark, sf_dir))
            .select(ROW_KEY, MEMBER, ITEM, "behaviour", RATING))


def q_ratings_log(spark, sf_dir):
    return _r6(ratings.ratings_log(log_of(spark, sf_dir))
               .select(ROW_KEY, MEMBER, ITEM, "behaviour", RATING), RATING)


def q_split_hash_small(spark, sf_dir):
    """A test share of half a percent, as a very long log has."""
    return split.with_split(log_of(spark, sf_dir), (0.995, 0.005)).groupBy(split.SPLIT).agg(
        F.count(F.lit(1)).alias("rows"))


def q_rejected_ratings(spark, sf_dir):
    """Per rating rule, its rows and those without a rating, which no fit takes."""
    log = log_of(spark, sf_dir)
    out = None
    for name, build in (("play", ratings.ratings_play), ("combined", ratings.ratings_combined),
                        ("log", ratings.ratings_log)):
        one = build(log).agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("rows"),
                             (F.count(F.lit(1)) - F.count(RATING)).alias("rejected"))
        out = one if out is None else out.unionByName(one)
    return out


def q_index_users(spark, sf_dir):
    return prepared(spark, sf_dir, "log").users.dictionary.select(MEMBER, USER_ID, "n")


def q_index_games(spark, sf_dir):
    return prepared(spark, sf_dir, "log").items.dictionary.select(ITEM, ITEM_ID, "n")


def q_game_dictionary(spark, sf_dir):
    return prepared(spark, sf_dir, "log").items.dictionary.select(ITEM, ITEM_ID)


def q_indexed_ratings(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    return _r6(p.data.select(ROW_KEY, USER_ID, ITEM, ITEM_ID, RATING), RATING)


def q_split_hash(spark, sf_dir):
    return split.with_split(log_of(spark, sf_dir)).select(ROW_KEY, MEMBER, ITEM, split.SPLIT)


def q_split_random(spark, sf_dir):
    tr, te = split.random_split(log_of(spark, sf_dir), (0.8, 0.2), 42)
    return (tr.select(ROW_KEY, F.lit("train").alias(split.SPLIT))
            .unionByName(te.select(ROW_KEY, F.lit("test").alias(split.SPLIT))))


def q_ratings_with_titles(spark, sf_dir):
    """Test rows left-joined to a title dictionary fitted on the TRAIN rows only:
    items never seen in training keep their row with a NULL title / id."""
    p = prepared(spark, sf_dir, "log")
    train_items = fit_index(p.train, ITEM, "train_game_id")
    titled = lookup_join(p.test.select(ROW_KEY, USER_ID, ITEM),
                         train_items.dictionary.select(ITEM, "train_game_id"), ITEM,
                         dim_bytes=train_items.bytes, how="left")
    return titled.select(ROW_KEY, USER_ID, ITEM, "train_game_id")


def q_rmse_baseline(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    return _r6(evaluate.baseline_rmse(p.train, p.test), "rmse_zero", "rmse_mean")


def q_ranking_popularity(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    rel = evaluate.relevant_pairs(p.test)
    return _r6(evaluate.popularity_metrics(p.train, rel, TOP_N), "precision_at_k", "map_at_k")


# ---------------------------------------------------------------- models

def _report(res: VariantResult) -> DataFrame:
    return res.report.select(F.lit(res.name).alias("variant"), "rmse", "rows_scored")


def q_als_play(spark, sf_dir):
    return _report(variant(spark, sf_dir, "play", PLAY_PARAMS, "play"))


def q_als_combined(spark, sf_dir):
    return _report(variant(spark, sf_dir, "combined", COMBINED_PARAMS, "combined"))


def q_als_log(spark, sf_dir):
    return _report(variant(spark, sf_dir, "log", LOG_PARAMS, "log"))


def q_als_explicit(spark, sf_dir):
    return _report(variant(spark, sf_dir, "raw", EXPLICIT_PARAMS, "explicit"))


def q_als_rmse(spark, sf_dir):
    return variant(spark, sf_dir, "log", LOG_PARAMS, "log").report


def q_als_factors(spark, sf_dir):
    return factor_tables(variant(spark, sf_dir, "log", LOG_PARAMS, "log").model)


def q_als_predictions(spark, sf_dir):
    res = variant(spark, sf_dir, "log", LOG_PARAMS, "log")
    return res.predictions.select(ROW_KEY, USER_ID, ITEM_ID, RATING, PREDICTION)


def q_cold_start_report(spark, sf_dir):
    p = prepared(spark, sf_dir, "play")
    res = variant(spark, sf_dir, "play", PLAY_PARAMS, "play")
    return cold_start_report(res.model, p.test)


def q_tuning_runs(spark, sf_dir):
    return tuned(spark, sf_dir).trials


def q_best_trial(spark, sf_dir):
    return best_trial(tuned(spark, sf_dir).trials)


def q_variant_comparison(spark, sf_dir):
    rows = [variant_row(variant(spark, sf_dir, r, prm, r), prepared(spark, sf_dir, r))
            for r, prm in (("play", PLAY_PARAMS), ("combined", COMBINED_PARAMS),
                           ("log", LOG_PARAMS))]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def q_recs_all_users(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    return recommend.order_for_display(
        recommend.titled_recs(best_model(spark, sf_dir), p.items, TOP_N))


def q_recs_for_users(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    one = spark.createDataFrame([(0,)], f"{USER_ID} int")
    return (recommend.titled_recs(best_model(spark, sf_dir), p.items, TOP_N, users=one)
            .orderBy(F.desc(recommend.SCORE), ITEM))


def q_recs_unseen(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    recs = recommend.recommend_unseen(best_model(spark, sf_dir), p.train, TOP_N)
    return recommend.attach_titles(recs, p.items).select(USER_ID, ITEM, recommend.SCORE,
                                                         recommend.RANK)


def q_ranking_metrics(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    ranked = recommend.flatten(recommend.recommend_all(best_model(spark, sf_dir), TOP_N))
    return evaluate.ranking_metrics(ranked, evaluate.relevant_pairs(p.test), TOP_N)


def q_cold_start_entities(spark, sf_dir):
    """The report on a split that holds out whole users and items."""
    p = prepared(spark, sf_dir, "log", "entity")
    res = _cached(spark, sf_dir, ("cold", "log"), lambda: run_variant(p, LOG_PARAMS, "log"))
    return cold_start_report(res.model, p.test)


def q_item_neighbours(spark, sf_dir):
    """The ten nearest of all embeddings for every item of the log."""
    index = neighbours.build_index(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    items = prepared(spark, sf_dir, "log").items.dictionary.select(
        F.expr(f"try_cast({ITEM} AS bigint)").alias("id"))
    return neighbours.neighbours(index, items, TOP_N).select(
        F.col("query").alias("item"), "rank", F.col("id").alias("neighbour"), "similarity")


def q_ranking_content(spark, sf_dir):
    """Ranking metrics of lists by content score."""
    p = prepared(spark, sf_dir, "log")
    vecs = hybrid.item_vectors_from_embeddings(table(spark, sf_dir, "embeddings"))
    ranked = hybrid.content_lists(hybrid.user_profiles(p.train, vecs, items=p.items), p.items, vecs,
                                  TOP_N)
    return _r6(evaluate.ranking_metrics(ranked, evaluate.relevant_pairs(p.test), TOP_N),
               "precision_at_k", "map_at_k")


def q_tuning_validated(spark, sf_dir):
    """The trials on the validation split, and the best one's score on the test split."""
    _, result, p = validated(spark, sf_dir)
    t, params, model, _ = result.best()
    test = evaluate.rmse_report(model.transform(p.test)).select(
        F.lit(t).alias("trial"), F.col("rmse").alias("test_rmse"),
        F.col("rows_scored").alias("test_rows"))
    return result.trials.join(test, "trial", "left")    # one row


def q_content_scores(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    vecs = hybrid.item_vectors_from_embeddings(table(spark, sf_dir, "embeddings"))
    prof = hybrid.user_profiles(p.train, vecs, items=p.items)
    pairs = p.test.select(ROW_KEY, USER_ID, ITEM)
    return _r6(hybrid.content_scores(pairs, prof, vecs, users=p.users, items=p.items),
               hybrid.CONTENT)


def q_hybrid_recs(spark, sf_dir):
    p = prepared(spark, sf_dir, "log")
    vecs = hybrid.item_vectors_from_embeddings(table(spark, sf_dir, "embeddings"))
    return hybrid.hybrid_recs(best_model(spark, sf_dir), p.items, p.train, vecs,
                              n=TOP_N, weight=0.7, users=p.users)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "load_interactions": q_load_interactions,
    "preview": q_preview,
    "schema_report": q_schema_report,
    "dataset_profile": q_dataset_profile,
    "behaviour_counts": q_behaviour_counts,
    "null_audit": q_null_audit,
    "playtime_stats": q_playtime_stats,
    "clean_interactions": q_clean_interactions,
    "sql_top_played": q_sql_top_played,
    "sql_top_purchased": q_sql_top_purchased,
    "ratings_play": q_ratings_play,
    "ratings_combined": q_ratings_combined,
    "ratings_log": q_ratings_log,
    "split_hash_small": q_split_hash_small,
    "rejected_ratings": q_rejected_ratings,
    "index_users": q_index_users,
    "index_games": q_index_games,
    "game_dictionary": q_game_dictionary,
    "indexed_ratings": q_indexed_ratings,
    "split_hash": q_split_hash,
    "split_random": q_split_random,
    "ratings_with_titles": q_ratings_with_titles,
    "rmse_baseline": q_rmse_baseline,
    "ranking_popularity": q_ranking_popularity,
    "content_scores": q_content_scores,
    "item_similarity": q_content_scores,    # its name so far
    "item_neighbours": q_item_neighbours,
    "ranking_content": q_ranking_content,
    "cold_start_entities": q_cold_start_entities,
    "tuning_validated": q_tuning_validated,
    "als_play": q_als_play,
    "als_combined": q_als_combined,
    "als_log": q_als_log,
    "als_explicit": q_als_explicit,
    "als_rmse": q_als_rmse,
    "als_factors": q_als_factors,
    "als_predictions": q_als_predictions,
    "cold_start_report": q_cold_start_report,
    "tuning_runs": q_tuning_runs,
    "best_trial": q_best_trial,
    "variant_comparison": q_variant_comparison,
    "recs_all_users": q_recs_all_users,
    "recs_for_users": q_recs_for_users,
    "recs_unseen": q_recs_unseen,
    "ranking_metrics": q_ranking_metrics,
    "hybrid_recs": q_hybrid_recs,
}
