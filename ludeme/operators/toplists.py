"""Top-N lists over the log, in DataFrame and SQL form.

Shape: filter (pushed to the scan) -> partial HashAggregate -> exchange on the
item -> final aggregate -> TakeOrderedAndProject (each task keeps n rows; no
global sort).  A hot item costs nothing extra thanks to the partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludeme.sources.schema import ACTION, ITEM, PLAY, PURCHASE, VALUE


def top_items_by_sum(df: DataFrame, action: str, alias: str, n: int = 10,
                     digits: int | None = None) -> DataFrame:
    """Items with the largest SUM(value) over rows of one action; ties by title."""
    total = F.sum(VALUE)
    if digits is not None:
        total = F.round(total, digits)
    return (df.filter(F.col(ACTION) == F.lit(action))
            .groupBy(ITEM).agg(total.alias(alias))
            .orderBy(F.desc(alias), F.asc(ITEM))
            .limit(n))


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


TOP_SQL = """
SELECT {item}, {total} AS {alias}
FROM {view}
WHERE {action_col} = :action
GROUP BY {item}
ORDER BY {alias} DESC, {item}
LIMIT {n}
"""


def top_sql_text(view: str, alias: str, n: int = 10, digits: int | None = None) -> str:
    total = f"SUM({VALUE})" if digits is None else f"ROUND(SUM({VALUE}), {digits})"
    return TOP_SQL.format(item=ITEM, total=total, alias=alias, view=view,
                          action_col=ACTION, n=int(n))


def sql_top(spark: SparkSession, view: str, action: str, alias: str, n: int = 10,
            digits: int | None = None) -> DataFrame:
    return spark.sql(top_sql_text(view, alias, n, digits), args={"action": action})


def sql_top_played(spark: SparkSession, view: str, n: int = 10,
                   digits: int | None = None) -> DataFrame:
    return sql_top(spark, view, PLAY, "total_playtime", n, digits)


def sql_top_purchased(spark: SparkSession, view: str, n: int = 10,
                      digits: int | None = None) -> DataFrame:
    return sql_top(spark, view, PURCHASE, "total_purchased", n, digits)
