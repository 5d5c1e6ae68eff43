"""Dimension lookup joins with a byte-checked broadcast and hot-key salting.

``lookup_join(facts, dim, key)`` attaches columns of a one-row-per-key
dimension table (id dictionaries, titles) to a fact table.

* A dimension whose size in bytes is known (dictionaries are measured when fitted)
  and at most ``broadcast_bytes`` is broadcast: no shuffle of the fact side.
* Without a known size Catalyst decides by its own estimate.
* Beyond that it is a shuffle join, with the fact side's own hot keys split: a key
  with more rows than one task's share is given salts; its fact rows are dealt by
  a hash of their own values (deterministic, so retries are safe) and its dimension
  row is replicated as often.  Rows whose key is NULL, which match nothing, are
  dealt to all tasks.  The hot-key list is at most ``shuffle partitions`` long by
  construction, so broadcasting it is bounded too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.functions.hashing import salt
from ludeme.plans.session import shuffle_partitions

#: A broadcast side of up to 64 MB is cheap on any executor; above it we shuffle.
DEFAULT_BROADCAST_BYTES = 64 << 20
#: What a row of a few numbers takes beside its text, in a hashed relation.
ROW_BYTES = 64
_SALT = "_ldm_salt"
_NSALT = "_ldm_nsalt"


def hot_keys(facts: DataFrame, key: str, partitions: int) -> DataFrame:
    """(key, salts) of the keys that hold more than one partition's share of the fact rows.

    Counted from the facts with partial aggregation; fewer than ``partitions`` keys can be."""
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_ldm_n"))
    # The share is taken of the largest counts only after all are known: one row.
    total = counts.agg(F.sum("_ldm_n")).first()[0] or 0
    share = max(1, -(-total // partitions))
    return counts.filter(F.col("_ldm_n") > share).select(
        key, F.ceil(F.col("_ldm_n") / F.lit(share)).cast("int").alias(_NSALT))


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, *, dim_bytes: int | None = None,
                how: str = "inner", broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                partitions: int | None = None) -> DataFrame:
    """Join ``facts`` to the one-row-per-``key`` table ``dim`` (``how`` in inner / left).
    ``dim_bytes``: the dimension's size, if it is known."""
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left joins")
    if dim_bytes is None:
        return facts.join(dim, key, how)
    if dim_bytes <= broadcast_bytes:
        return facts.join(F.broadcast(dim), key, how)

    parts = partitions or shuffle_partitions(facts.sparkSession)
    hot = hot_keys(facts, key, parts)
    cols = list(facts.columns)
    dealt = (F.when(F.col(key).isNull(), salt(cols, F.lit(parts)))
             .when(F.col(_NSALT).isNull(), F.lit(0)).otherwise(salt(cols, F.col(_NSALT))))
    salted_facts = facts.join(F.broadcast(hot), key, "left").withColumn(_SALT, dealt).drop(_NSALT)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(_NSALT), F.lit(1)) - 1)
    salted_dim = dim.join(F.broadcast(hot), key, "left").withColumn(_SALT, F.explode(copies)) \
        .drop(_NSALT)
    return salted_facts.join(salted_dim, [key, _SALT], how).drop(_SALT)
