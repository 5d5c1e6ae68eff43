"""URL filters by a temporal list join (native).

Lists are dated entries: at a time, a key is added to a list or taken off it.
Entries become validity intervals [from, to) by looking at the next entry of the
same list and key.  A capture (a URL and its fetch time) has as keys its host's
domain suffixes and its path's prefixes; an as-of join finds, for every key, the
intervals that hold the fetch time.  The most specific active entry decides
(allow wins a draw); without one the capture is kept.

Captures of the same URL and time are judged once.  The join is an equality on
the key with a range condition; a hot host's captures are dealt to several parts,
each with a copy of the intervals, and Spark splits what is still large.

Defined cases: a null or unparsable URL has no keys and is kept with no entry; a
null fetch time matches nothing; an entry without a time or key never holds; of
entries of one time for one list and key the removal comes first; repeated rows
each get the verdict; an empty list keeps all; other columns are passed on, but for
those named as the verdict's, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludeme.llm.text import every_salt, hex_number, quoted, row_salt

NO_END = (1 << 62)
BLOCK, ALLOW = "block", "allow"


def keys_of(url: Column) -> Column:
    """Array of (key, depth): every domain suffix of two labels or more as
    ``d:``, every path prefix as ``u:``; the deeper the more specific."""
    u = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(u, "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    path = F.regexp_extract(u, "^[a-z][a-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.when((host != "") & (n > 1), F.transform(
        F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda k: F.struct(
            F.concat(F.lit("d:"), F.array_join(F.slice(labels, n - k + 1, k), ".")).alias("key"),
            k.alias("depth"))))
    parts = F.array_remove(F.split(path, "/"), "")
    prefixes = F.when((host != "") & (F.size(parts) > 0), F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda k: F.struct(
            F.concat(F.lit("u:"), host, F.lit("/"), F.array_join(F.slice(parts, 1, k), "/"))
            .alias("key"), (k + 1000).alias("depth"))))
    none = F.array().cast("array<struct<key:string,depth:int>>")
    return F.concat(F.coalesce(suffixes, none), F.coalesce(prefixes, none))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, from, to) from entries (list, key, at, action ``add``/``remove``)."""
    e = entries.filter("`at` IS NOT NULL AND `key` IS NOT NULL").select("list", "key", "at", "action")
    nxt = Window.partitionBy("list", "key").orderBy("at", F.desc("action"))
    return e.withColumn("to", F.coalesce(F.lead("at").over(nxt), F.lit(NO_END))) \
        .filter("action = 'add' AND `at` < `to`") \
        .select("list", "key", F.col("at").alias("from"), "to")


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url",
          time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with n_block, n_allow (active entries), decided_by (the
    deciding key, null if none) and kept."""
    x = captures.select(quoted(url_col).alias("_u"), quoted(time_col).alias("_at"),
                        F.struct(*map(quoted, captures.columns)).alias("_row"))
    once = x.select("_u", "_at").distinct()
    k = once.select("_u", "_at", F.explode(keys_of(F.col("_u"))).alias("k")) \
        .select("_u", "_at", F.col("k.key").alias("key"), F.col("k.depth").alias("depth"),
                row_salt(once).alias("_salt"))
    dealt = intervals(entries).select("*", every_salt().alias("_salt"))
    hit = k.join(dealt, ["key", "_salt"]).filter((F.col("from") <= F.col("_at"))
                                                   & (F.col("_at") < F.col("to")))
    top = F.max(F.struct("depth", (F.col("list") == ALLOW).alias("allow"), "key")).alias("top")
    verdict = hit.groupBy("_u", "_at").agg(
        F.count(F.when(F.col("list") == BLOCK, 1)).alias("n_block"),
        F.count(F.when(F.col("list") == ALLOW, 1)).alias("n_allow"), top)
    y = x.alias("x").join(verdict.alias("v"), F.col("x._u").eqNullSafe(F.col("v._u"))
                          & F.col("x._at").eqNullSafe(F.col("v._at")), "left")
    added = {"n_block": F.coalesce("v.n_block", F.lit(0)), "n_allow": F.coalesce("v.n_allow", F.lit(0)),
             "decided_by": F.col("v.top.key"), "kept": F.coalesce("v.top.allow", F.lit(True))}
    return y.select(*(F.col("x._row").getField(c).alias(c) for c in captures.columns
                      if c.lower() not in added), *(c.alias(n) for n, c in added.items()))


DAY, SPAN = 86_400, 366
EPOCH = 1_704_067_200  # 2024-01-01


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures (page_id, url, fetched_at in seconds): the tables have no fetch
    times, so a digest of the page id gives one within a year."""
    h = hex_number(F.md5(F.concat(F.lit("fetch:"), F.col("page_id").cast("string"))))
    return pages.select("page_id", "url", (h % (SPAN * DAY) + EPOCH).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries from the pages' own keys: a digest of a key says whether it
    is listed (one in four), where, when, and whether it is taken off and put
    back later."""
    k = pages.select("url").distinct().select(F.explode(keys_of(F.col("url"))).alias("k")) \
        .select("k.key").distinct()
    d = F.md5(F.concat(F.lit("entry:"), F.col("key")))
    k = k.select("key", hex_number(d).alias("a"), hex_number(F.substring(d, 9, 8)).alias("b"),
                 hex_number(F.substring(d, 17, 8)).alias("c")).filter("a % 4 = 0")
    start = F.col("b") % (SPAN * DAY) + EPOCH
    off = start + F.col("c") % (90 * DAY) + 1
    steps = F.array(
        F.struct(start.alias("at"), F.lit("add").alias("action")),
        F.struct(F.when(F.col("a") % 8 == 0, off).alias("at"), F.lit("remove").alias("action")),
        F.struct(F.when(F.col("a") % 16 == 0, off + 30 * DAY).alias("at"),
                 F.lit("add").alias("action")))
    return k.select(F.when(F.col("c") % 3 == 0, ALLOW).otherwise(BLOCK).alias("list"), "key",
                    F.explode(steps).alias("s")).select("list", "key", "s.at", "s.action") \
        .filter("`at` IS NOT NULL")
