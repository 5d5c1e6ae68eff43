"""Readers for the interaction log and bindings of the supplied tables to it.

Every reader returns the canonical log columns ``member_id, game, behaviour,
value`` (see :mod:`ludeme.sources.schema`); table bindings also carry a stable
``event_id`` so that hash splits are independent of file layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludeme.plans.session import default_parallelism
from ludeme.sources.schema import (ACTION, INTERACTION_SCHEMA, ITEM, MEMBER, PLAY,
                                   PURCHASE, ROW_KEY, VALUE)


def read_interactions_csv(spark: SparkSession, path: str | Sequence[str],
                          schema: T.StructType = INTERACTION_SCHEMA,
                          header: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """Headerless CSV scan with a declared schema (comma separator, ``"`` quotes).

    Quoted titles may hold commas.  Columns beyond the schema are ignored, which
    is the point of declaring it.
    """
    return (spark.read.schema(schema)
            .option("header", header)
            .option("mode", mode)
            .option("quote", '"')
            .option("escape", '"')
            .csv(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# How the supplied `events` table maps onto the log's action domain.
EVENT_ACTIONS = {"purchase": PURCHASE, "view": PLAY, "click": PLAY}


def events_log(spark: SparkSession, sf_dir: str, branches: bool = False) -> DataFrame:
    """Bind ``events`` to the log: user -> member, ``props.k`` -> item,
    purchase -> purchase, view/click -> play, other event types left out.

    One scan reads the whole log, and maps the action row by row.  With ``branches`` the log is a
    union with one branch per action, whose action is a literal: a filter on the action drops the
    other branches and reaches the scan as a filter on ``event_type``.  The right form for queries
    of one action; a query of all of them would read the table once per action."""
    ev = table(spark, sf_dir, "events")

    def bound(rows: DataFrame, action: Column) -> DataFrame:
        return rows.select(F.col("event_id").alias(ROW_KEY), F.col("user_id").alias(MEMBER),
                           F.get_json_object("props", "$.k").alias(ITEM), action.alias(ACTION),
                           F.col("value").alias(VALUE))
    if not branches:
        mapping = F.create_map(*[F.lit(x) for kv in EVENT_ACTIONS.items() for x in kv])
        return bound(ev.filter(F.col("event_type").isin(*EVENT_ACTIONS)),
                     mapping[F.col("event_type")])
    out = None
    for action in dict.fromkeys(EVENT_ACTIONS.values()):
        types = [t for t, a in EVENT_ACTIONS.items() if a == action]
        one = bound(ev.filter(F.col("event_type").isin(*types)), F.lit(action))
        out = one if out is None else out.unionByName(one)
    return out


LINE_ROWS = 500_000    # lines that a task joins and sorts


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bind ``lineitem`` joined to ``orders`` to the log (scale binding):
    customer -> member, ``part-<partkey>`` -> item, every line a play of
    ``l_quantity``.  Order and line number do not identify a line, so the row key
    is all read columns and a number among equal lines; the numbering is
    partitioned by the order key too, as the join is.

    Both sides are dealt to as many tasks as hold ``LINE_ROWS`` lines each (counted from the
    files' footers): a task sorts no more of a longer table."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = max(default_parallelism(spark), -(-li.count() // LINE_ROWS))
    li, od = li.repartition(parts, "l_orderkey"), od.repartition(parts, "o_orderkey")
    # orders is one row per key (no skew on the build side); Catalyst picks the
    # strategy from sizes: sort-merge at scale, broadcast when orders is small.
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    j = j.withColumn("_n", F.row_number().over(Window.partitionBy(*line).orderBy("o_custkey")))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*line, "_n"]]
    return j.select(
        F.concat_ws("-", *text).alias(ROW_KEY),
        F.col("o_custkey").alias(MEMBER),
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias(ITEM),
        F.lit(PLAY).alias(ACTION),
        F.col("l_quantity").alias(VALUE))

