"""Profiling operators: schema, counts, distinct counts, null audit, summary
statistics, cleaning and an ordered preview.  All are single-pass aggregations
with map-side partial aggregation, so a hot key costs nothing extra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludeme.sources.schema import ACTION, ITEM, MEMBER, PLAY, VALUE


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark SQL type, nullability, position."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ])
    return df.sparkSession.createDataFrame(rows, schema)


def dataset_profile(df: DataFrame, user_col: str = MEMBER, item_col: str = ITEM,
                    exact: bool = True) -> DataFrame:
    """Rows, distinct users and distinct items in ONE aggregation job.

    ``exact=False`` swaps the two distinct counts for HyperLogLog++ sketches
    (fixed memory per partition, no distinct-value shuffle) for very large logs.
    """
    if exact:
        users, items = F.count_distinct(user_col), F.count_distinct(item_col)
    else:
        users, items = F.approx_count_distinct(user_col), F.approx_count_distinct(item_col)
    return df.agg(F.count(F.lit(1)).alias("rows"), users.alias("users"),
                  items.alias("items"))


def behaviour_counts(df: DataFrame, col: str = ACTION) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column, all columns in one pass; 0 (not NULL) on empty input."""
    columns = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def value_stats(df: DataFrame, col: str = VALUE) -> DataFrame:
    """count, mean, sample stddev, min, max of a column, typed (not strings)."""
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"),
                  F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"),
                  F.max(c).alias("max"))


def playtime_stats(df: DataFrame, action: str = PLAY) -> DataFrame:
    return value_stats(df.filter(F.col(ACTION) == F.lit(action)))


def clean_interactions(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``subset`` (default: the log columns present)."""
    subset = list(subset or [c for c in (MEMBER, ITEM, ACTION, VALUE) if c in df.columns])
    return df.na.drop(how="any", subset=subset)


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows under a stated order (a defined result, unlike a bare limit).
    Planned as TakeOrderedAndProject: each task keeps n rows, no full sort."""
    return df.orderBy(*order_by).limit(n)
