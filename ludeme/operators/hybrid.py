"""Content-based scoring and the hybrid recommender.

* Item vectors come from a content table (here ``embeddings``: one vector per
  item id).
* A user's content profile is the rating-weighted mean of the vectors of the
  items they rated positively in training -- MLlib's ``Summarizer`` as a
  grouped aggregate, so it is partially aggregated map-side (a very heavy user
  costs one buffer per task, not one task) and never explodes vectors into
  per-element rows.
* Content score of a (user, item) pair = cosine(profile, item vector),
  computed with JVM higher-order functions.
* Hybrid: the blend ``weight * als + (1 - weight) * content`` is one dot product
  of joined vectors, so the blocked top-k scores every item exactly, with no
  user x item rows and no candidate list.
* Content lists: the same top-k over unit profiles and unit vectors.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludeme.functions.metrics import cosine, norm
from ludeme.operators import topn
from ludeme.operators.indexing import IndexModel
from ludeme.operators.joins import DEFAULT_BROADCAST_BYTES, lookup_join
from ludeme.operators.recommend import SCORE, attach_titles, flatten
from ludeme.sources.schema import ITEM, ITEM_ID, PREDICTION, RATING, USER_ID

VECTOR = "vector"
PROFILE = "profile"
CONTENT = "content_score"
HYBRID = "hybrid_score"
#: What a joined vector may take: a thousand doubles.
VECTOR_BYTES = 8 << 10


def item_vectors_from_embeddings(emb: DataFrame, id_col: str = "vec_id",
                                 vec_col: str = "embedding") -> DataFrame:
    """(game, vector): the item title is the vector id as a string, matching the
    ``events`` binding's item key."""
    return emb.select(F.col(id_col).cast("string").alias(ITEM), F.col(vec_col).alias(VECTOR))


def _attach(facts: DataFrame, dim: DataFrame, key: str, how: str,
            model: IndexModel | None) -> DataFrame:
    """``dim``: one row of a vector per key of the dictionary ``model``."""
    if model is None:       # no size bound known: Catalyst decides (AQE splits skew)
        return facts.join(dim, key, how)
    if key not in (model.input_col, model.output_col):
        raise ValueError(f"{key} is neither the label nor the id of the dictionary")
    # Vectors are wide: the dictionary's bytes say nothing of theirs, so they are counted as
    # a shuffle would see them, beyond any small dictionary.
    known = dim.join(model.dictionary.select(key), key, "left_semi")
    wide = model.size * VECTOR_BYTES
    return lookup_join(facts, known, key, dim_bytes=wide, how=how,
                       broadcast_bytes=DEFAULT_BROADCAST_BYTES)


def user_profiles(train: DataFrame, vectors: DataFrame, user_col: str = USER_ID,
                  rating_col: str = RATING, items: IndexModel | None = None) -> DataFrame:
    """(user, profile array<double>): rating-weighted mean item vector over the
    user's positively rated training rows.  With ``items`` the vector lookup is
    size-checked and salted on hot items."""
    rows = _attach(train.filter(F.col(rating_col) > 0).select(user_col, ITEM, rating_col),
                   vectors, ITEM, "inner", items)
    agg = rows.groupBy(user_col).agg(
        Summarizer.mean(array_to_vector(F.col(VECTOR)),
                        F.col(rating_col).cast("double")).alias("_m"))
    return agg.select(user_col, vector_to_array("_m").alias(PROFILE))


def content_scores(pairs: DataFrame, profiles: DataFrame, vectors: DataFrame,
                   user_col: str = USER_ID, users: IndexModel | None = None,
                   items: IndexModel | None = None) -> DataFrame:
    """Add ``content_score`` = cosine(user profile, item vector) to (user, game)
    rows; NULL when the user has no profile or the item no vector.  With the
    ``users`` / ``items`` dictionaries both lookups are size-checked and salted
    on hot keys."""
    j = _attach(pairs, profiles, user_col, "left", users)
    j = _attach(j, vectors, ITEM, "left", items)
    return (j.withColumn(CONTENT, cosine(F.col(PROFILE), F.col(VECTOR)))
            .drop(PROFILE, VECTOR))


def _unit(table: DataFrame, vector: str, dims: int) -> DataFrame:
    """``vector`` at length one; zeros where it is missing or has no direction."""
    t = table.withColumn("_v", F.col(vector).cast("array<double>"))
    t = t.withColumn("_n", norm(F.col("_v")))
    good = (F.size("_v") == dims) & (F.col("_n") > 0) & (F.col("_n") < float("inf"))
    unit = F.when(good, F.transform("_v", lambda x: x / F.col("_n")))
    return t.withColumn("_unit", F.coalesce(unit, F.array_repeat(F.lit(0.0), dims))) \
        .drop("_v", "_n")


def blended_factors(model: ALSModel, items: IndexModel, profiles: DataFrame, vectors: DataFrame,
                    weight: float) -> tuple[DataFrame, DataFrame]:
    """Factors (id, features) of users and items whose dot product is the blend: a user's factors
    are followed by the unit profile, weighted, an item's by its unit vector, so it is
    ``weight * als + (1 - weight) * cosine`` for any pair."""
    dims = max(vectors.agg(F.max(F.size(VECTOR))).first()[0] or 0, 0)
    user = model.userFactors.join(profiles.withColumnRenamed(USER_ID, "id"), "id", "left")
    user = _unit(user, PROFILE, dims).select("id", F.concat(
        F.transform("features", lambda x: x * F.lit(weight)),
        F.transform("_unit", lambda x: x * F.lit(1.0 - weight))).cast("array<float>")
        .alias("features"))
    by_id = items.dictionary.select(F.col(ITEM_ID).alias("id"), ITEM).join(vectors, ITEM)
    item = model.itemFactors.join(by_id.select("id", VECTOR), "id", "left")
    item = _unit(item, VECTOR, dims).select("id", F.concat(
        F.col("features").cast("array<double>"), "_unit").cast("array<float>").alias("features"))
    return user, item


def content_lists(profiles: DataFrame, items: IndexModel, vectors: DataFrame,
                  n: int = 10) -> DataFrame:
    """(user_id, game_id, score, rank): per user with a profile the n items of the dictionary
    whose vectors are nearest to it by cosine."""
    dims = max(vectors.agg(F.max(F.size(VECTOR))).first()[0] or 0, 0)

    def factors(table, vector):
        some = _unit(table, vector, dims).filter(F.exists("_unit", lambda x: x != 0))
        return some.select("id", F.col("_unit").cast("array<float>").alias("features"))
    by_id = items.dictionary.select(F.col(ITEM_ID).alias("id"), ITEM).join(vectors, ITEM)
    lists = topn.top_n(factors(profiles.withColumnRenamed(USER_ID, "id"), PROFILE),
                       factors(by_id, VECTOR), n)
    return flatten(topn.as_recommendations(lists))


def hybrid_recs(model: ALSModel, items: IndexModel, train: DataFrame, vectors: DataFrame,
                n: int = 10, weight: float = 0.7, users: IndexModel | None = None) -> DataFrame:
    """Top-n per user of all the model's items by ``weight * ALS score + (1 - weight)
    * content score``; a missing content score counts as 0.  ``vectors``: one row per
    item.  Items are chosen by single-precision scores (as every ALS list), then
    ranked by the exact blend, ties by item id."""
    prof = user_profiles(train, vectors, items=items)
    user, item = blended_factors(model, items, prof, vectors, weight)
    top = flatten(topn.as_recommendations(topn.top_n(user, item, n)))
    rows = model.transform(top.select(USER_ID, ITEM_ID)).withColumnRenamed(PREDICTION, SCORE)
    scored = content_scores(attach_titles(rows, items), prof, vectors, users=users, items=items)
    blend = (F.lit(weight) * F.col(SCORE).cast("double")
             + F.lit(1.0 - weight) * F.coalesce(F.col(CONTENT), F.lit(0.0)))
    w = Window.partitionBy(USER_ID).orderBy(F.desc(HYBRID), F.asc(ITEM_ID))
    return (scored.withColumn(HYBRID, blend)
            .withColumn("hybrid_rank", F.row_number().over(w))
            .select(USER_ID, ITEM, SCORE, CONTENT, HYBRID, "hybrid_rank"))
