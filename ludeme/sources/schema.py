"""Declared schemas.  Nothing is inferred: inference costs a second pass over the
input and can flip a column's type on dirty rows."""

from __future__ import annotations

from pyspark.sql import types as T

# The interaction log: one row per action (a bought-and-played item has two rows).
MEMBER = "member_id"
ITEM = "game"
ACTION = "behaviour"
VALUE = "value"
ROW_KEY = "event_id"          # optional stable row id carried by table bindings

USER_ID = "user_id"           # dense int ids produced by the indexer
ITEM_ID = "game_id"
RATING = "rating"
PREDICTION = "prediction"

# Fixed values of the log's action domain.
PURCHASE = "purchase"
PLAY = "play"

INTERACTION_SCHEMA = T.StructType([
    T.StructField(MEMBER, T.LongType(), True),
    T.StructField(ITEM, T.StringType(), True),
    T.StructField(ACTION, T.StringType(), True),
    T.StructField(VALUE, T.DoubleType(), True),
])

LOG_COLUMNS = [MEMBER, ITEM, ACTION, VALUE]

RECOMMENDATION_STRUCT = T.StructType([
    T.StructField(ITEM_ID, T.IntegerType(), True),
    T.StructField(RATING, T.FloatType(), True),
])

TUNING_RUNS_SCHEMA = T.StructType([
    T.StructField("variant", T.StringType(), False),
    T.StructField("trial", T.IntegerType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("reg_param", T.DoubleType(), False),
    T.StructField("max_iter", T.IntegerType(), False),
    T.StructField("seed", T.LongType(), False),
    T.StructField("rmse", T.DoubleType(), True),
    T.StructField("rows_scored", T.LongType(), False),
])

#: A finished trial of a run; ``run_id`` and ``trial`` are the folders it lies in.
LEDGER_SCHEMA = T.StructType([
    T.StructField("variant", T.StringType(), True),
    T.StructField("rank", T.IntegerType(), True),
    T.StructField("reg_param", T.DoubleType(), True),
    T.StructField("max_iter", T.IntegerType(), True),
    T.StructField("seed", T.LongType(), True),
    T.StructField("num_blocks", T.IntegerType(), True),
    T.StructField("item_blocks", T.IntegerType(), True),
    T.StructField("data", T.StringType(), True),
    T.StructField("fit_seconds", T.DoubleType(), True),
    T.StructField("bundle", T.StringType(), True),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("trial", T.IntegerType(), True),
])
