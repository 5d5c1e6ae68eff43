"""Top-N recommendation tables over the exact lists of :mod:`ludeme.operators.topn`.

Items are scored in blocks of falling norm until no later block can reach a user's list; items
the user has seen are masked while a block is scored.  (user, item) pairs are never rows.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.operators import topn
from ludeme.operators.indexing import IndexModel
from ludeme.operators.joins import lookup_join
from ludeme.sources.schema import ITEM, ITEM_ID, RATING, USER_ID

SCORE = "score"
RANK = "rank"


def recommend_all(model: ALSModel, n: int = 10) -> DataFrame:
    """(user_id, recommendations): the n best (game_id, rating) of every user."""
    return topn.as_recommendations(topn.recommend(model, n))


def recommend_for(model: ALSModel, users: DataFrame, n: int = 10) -> DataFrame:
    """Top-N for the users in ``users`` (column ``user_id``); an unknown user gets
    no row."""
    return topn.as_recommendations(topn.recommend(model, n, users))


def flatten(recs: DataFrame, user_col: str = USER_ID) -> DataFrame:
    """(user, array<struct<item, rating>>) -> one row per item with its 1-based rank."""
    return (recs.select(user_col, F.posexplode("recommendations").alias("_pos", "rec"))
            .select(user_col, F.col(f"rec.{ITEM_ID}").alias(ITEM_ID),
                    F.col(f"rec.{RATING}").alias(SCORE),
                    (F.col("_pos") + 1).alias(RANK)))


def attach_titles(flat: DataFrame, items: IndexModel, how: str = "left") -> DataFrame:
    """game_id -> title through the dictionary the model was trained with.  The
    dictionary is broadcast when its (known) size in bytes allows; otherwise the join is
    salted on the items that the lists hold most often."""
    return lookup_join(flat, items.dictionary.select(ITEM_ID, items.input_col), ITEM_ID,
                       dim_bytes=items.bytes, how=how)


def titled_recs(model: ALSModel, items: IndexModel, n: int = 10,
                users: DataFrame | None = None) -> DataFrame:
    recs = recommend_all(model, n) if users is None else recommend_for(model, users, n)
    return attach_titles(flatten(recs), items).select(USER_ID, ITEM, SCORE)


def order_for_display(df: DataFrame) -> DataFrame:
    """By user, then score, both descending, ties by item (a range-partitioned sort)."""
    return df.orderBy(F.desc(USER_ID), F.desc(SCORE), ITEM)


def recommend_unseen(model: ALSModel, seen: DataFrame, n: int = 10,
                     users: DataFrame | None = None) -> DataFrame:
    """Exact top-N per user among items the user has NOT interacted with.

    ``seen``: (user_id, game_id) pairs (duplicates allowed).  Each user's sorted seen ids travel
    with the factor and are skipped while a block of items is scored."""
    lists = topn.recommend(model, n, users, seen.select(USER_ID, ITEM_ID))
    return flatten(topn.as_recommendations(lists))
