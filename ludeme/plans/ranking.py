"""Global ranks without a single task: a range-partitioned sort, written once, and the
sorted partitions' offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludeme.plans.session import materialize

_AT, _PART, _FROM = "_ldm_at", "_ldm_part", "_ldm_from"


def global_rank(df: DataFrame, order: list[Column], rank: str = "rank",
                name: str = "ranked") -> tuple[DataFrame, int]:
    """``df`` with ``rank`` (from 0) in ``order``, and its number of rows.

    The driver sees one row per sorted partition; those are broadcast back."""
    s = materialize(df.orderBy(*order).withColumn(_AT, F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned(_AT, 33)
    sizes = s.groupBy(part.alias("p")).agg(F.min(_AT).alias("first"),
                                           F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    before, rows = 0, []
    for r in sizes:
        rows.append((r["p"], before - r["first"]))
        before += r["n"]
    places = df.sparkSession.createDataFrame(rows, f"{_PART} long, {_FROM} long")
    out = s.withColumn(_PART, part).join(F.broadcast(places), _PART) \
        .withColumn(rank, F.col(_FROM) + F.col(_AT))
    return out.drop(_AT, _PART, _FROM), before
