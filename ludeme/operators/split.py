"""Train / test (/ validation) splits.

``hash_split`` (default) assigns each row by an md5 bucket of its key, so the
split is identical across file layouts, partition counts, retries and engines
(a SQL engine reproduces it bit for bit).  Keying by the (member, item) pair
keeps a pair's purchase and play rows on the same side.

``entity_split`` holds out whole users and items, as a cold start has them.

``with_row_keys`` gives a log without row ids one: its content and a running
number among equal rows, so equal rows fall on both sides.  Equal rows are counted
(partially aggregated) and dealt out again in runs, never gathered.

``random_split`` is ``DataFrame.randomSplit``: per-partition Bernoulli samples
whose result changes if the input is repartitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.functions.hashing import BUCKETS, hash_bucket
from ludeme.plans.session import shuffle_partitions
from ludeme.sources.schema import ITEM, LOG_COLUMNS, MEMBER, ROW_KEY

SPLIT = "split"


def default_key(df: DataFrame, by: str = "row") -> list[str]:
    if by == "pair":
        return [MEMBER, ITEM]
    if ROW_KEY in df.columns:
        return [ROW_KEY]
    # no row id: identical rows share a bucket; with_row_keys tells them apart
    return [c for c in LOG_COLUMNS if c in df.columns]


def _bounds(weights: Sequence[float]) -> list[int]:
    total = float(sum(weights))
    acc, out = 0.0, []
    for w in weights:
        acc += w
        out.append(int(round(BUCKETS * acc / total)))
    out[-1] = BUCKETS
    return out


def with_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2),
               names: Sequence[str] = ("train", "test"), seed: int = 42,
               key_cols: Sequence[str] | None = None, by: str = "row") -> DataFrame:
    """Tag each row with its split name (one pass, no shuffle)."""
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    key_cols = list(key_cols or default_key(df, by))
    b = hash_bucket(key_cols, seed)
    bounds = _bounds(weights)
    expr = None
    for bound, name in zip(bounds, names):
        expr = (F.when(b < bound, F.lit(name)) if expr is None
                else expr.when(b < bound, F.lit(name)))
    return df.withColumn(SPLIT, expr)


def hash_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42,
               key_cols: Sequence[str] | None = None, by: str = "row") -> list[DataFrame]:
    key_cols = list(key_cols or default_key(df, by))
    b = hash_bucket(key_cols, seed)
    bounds, lo, out = _bounds(weights), 0, []
    for hi in bounds:
        out.append(df.filter((b >= lo) & (b < hi)))
        lo = hi
    return out


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
                 ) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


COLD_USERS, COLD_ITEMS = "cold-user", "cold-item"


def entity_split(df: DataFrame, users: float = 0.1, items: float = 0.1, seed: int = 42,
                 user_col: str = MEMBER, item_col: str = ITEM) -> DataFrame:
    """Tags as ``test`` every row of a held-out user or item, the rest as ``train``: a share
    of the users and of the items is held out, each by a hash of its own."""
    out = F.lit(False)
    for col, share, what in ((user_col, users, COLD_USERS), (item_col, items, COLD_ITEMS)):
        # The hash of a user is not the hash of an item of the same name.
        b = hash_bucket([col], f"{seed}|{what}")
        out = out | (F.col(col).isNotNull() & (b < int(round(BUCKETS * share))))
    return df.withColumn(SPLIT, F.when(out, F.lit("test")).otherwise(F.lit("train")))


def with_row_keys(df: DataFrame, cols: Sequence[str] | None = None, key: str = ROW_KEY,
                  run: int = 100_000) -> DataFrame:
    """``df`` (its columns ``cols``) with a row key: the values and the row's number among equal
    rows, joined by ``|``; a null is written as ``\\N``, and a backslash or bar as with a
    backslash before it."""
    cols = list(cols or df.columns)
    n = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_ldm_n"))
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_ldm_n") - 1) / run))
    # A row repeated a billion times is many runs, each an input row of its own.
    x = n.select("*", F.explode(runs).alias("_ldm_run")).repartition(
        shuffle_partitions(df.sparkSession), *cols, "_ldm_run")
    first = F.col("_ldm_run") * run + 1
    x = x.select(*cols, F.explode(F.sequence(first, F.least(first + run - 1, F.col("_ldm_n"))))
                 .alias("_ldm_number"))
    text = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"([\\|])", r"\\$1"),
                       F.lit("\\N")) for c in cols]
    return x.select(F.concat_ws("|", *text, F.col("_ldm_number").cast("string")).alias(key), *cols)
