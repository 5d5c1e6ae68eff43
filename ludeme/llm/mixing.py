"""Mixing sources to target weights by Sainte-Lague apportionment (native).

Sources get integer numbers of equal blocks of words by the highest quotients
votes / (2 j - 1).  The parties are shards: each source is split by a digest of
the document id into shards of about ``shard_docs`` documents, so no group grows
with a hot source, and each shard's votes are its share of the source's target.
Shards of many blocks compete for blocks of ``block_words``, the small ones for
blocks of one word, each kind for as many as its votes are.  No shard gets more than ``cap``
times its words: blocks beyond go to the next highest quotients.

How many quotients of a shard lie above a threshold follows from a formula, so
the threshold that fills the house is found by aggregation, narrowing a range of
thresholds; only the few quotients left within it are ranked, and of a multitude
of equal ones those with the smallest digests win, found in the same way.

Inside a shard the documents lie end to end in a seeded order; a shard takes
whole passes over that line and then a run of blocks from a seeded start,
around the end.  ``taken`` is what that covers of a document.

Targets: source weights share all words; a target stops at ``cap`` times its
source's words and the excess goes to the others by weight until none is above.

Defined cases: a null text has 0 words; a null source is a source of its own,
last in order; a source without words has the target 0; documents of equal id
are ordered by size (equal rows are alike); an empty table gives an empty result;
a document with no words takes 0; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludeme.llm.text import hex_number, quoted, words_of
from ludeme.plans.ranking import global_rank
from ludeme.plans.session import materialize


@dataclass(frozen=True)
class Mix:
    block_words: int = 32
    large_blocks: int = 64       # a shard whose votes are as many blocks gets whole ones
    weights: tuple[int, ...] = (1, 2, 3)
    cap: int = 3
    seed: int = 42
    shard_docs: int = 4_000
    most_ranked: int = 10_000    # quotients (or digests) that are ranked in one task


STEPS = 32    # thresholds that one aggregation looks at


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    return df.select(quoted(id_col).alias("doc_id"), quoted(source_col).alias("source"),
                     F.size(words_of(quoted(text_col))).cast("long").alias("size"))


def _sums(rows: DataFrame, of: list[Column]) -> list[float]:
    r = rows.agg(*(F.sum(c).alias(f"c{i}") for i, c in enumerate(of))).first()
    return [x or 0 for x in r]


def _at_each(rows: DataFrame, at: Callable[[Column], Column], steps: list[float]) -> list[float]:
    """The sum of ``at`` for each threshold.  They come as an array, so the plan of one search
    step is that of the next and is compiled once."""
    x = rows.select("*", F.explode(F.array(*map(F.lit, steps))).alias("_x"))
    found = {r["_x"]: r["s"] for r in
             x.groupBy("_x").agg(F.sum(at(F.col("_x"))).alias("s")).collect()}
    return [found.get(x) or 0 for x in steps]


def _narrowed(rows: DataFrame, at: Callable[[Column], Column], want: float, lo: float, hi: float,
              enough: float) -> tuple[float, float]:
    """A narrower (lo, hi) with sum at(lo) <= want < sum at(hi), for a sum that grows with its
    threshold and a range that has both; until the sums differ by ``enough`` at most, or no
    number lies between."""
    low, high = _at_each(rows, at, [lo, hi])
    while high - low > enough:
        steps = sorted({lo + (hi - lo) * k / STEPS for k in range(1, STEPS)} - {lo, hi})
        if not steps:
            break
        for x, n in zip(steps, _at_each(rows, at, steps), strict=True):
            if n <= want and x > lo:
                lo, low = x, n
            elif n > want:
                hi, high = x, n
                break
    return lo, hi


# ------------------------------------------------------------------ targets

def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per source (a written table): its words, weight, shards and target."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count_if(F.col("size") > 0).alias("n_docs"))
    per, _ = global_rank(per, [F.asc_nulls_last("source")], "_rank", "sources")
    weight = F.get(F.array(*map(F.lit, mix.weights)), (F.col("_rank") % len(mix.weights)).cast("int"))
    per = per.withColumn("weight", weight.cast("long")) \
        .withColumn("most", mix.cap * F.col("source_size"))
    total, most = per.agg(F.sum("source_size"), F.max(F.col("most") / F.col("weight"))).first()
    total = int(total or 0)
    level = 0.0
    if total:
        # The common level at which the sources, each up to its most, hold all words.
        low, _ = _narrowed(per, lambda x: F.least("most", x * F.col("weight")), total,
                           0.0, float(most) + 1, total / (1 << 20))
        while True:   # exactly: the capped ones leave the rest to the others
            full = F.col("most") <= F.lit(low) * F.col("weight")
            gone, left = _sums(per, [F.when(full, F.col("most")), F.when(~full, F.col("weight"))])
            level = (total - gone) / left if left else low
            if not left or level <= low:
                break
            low = level
    full = F.col("most") <= F.lit(level) * F.col("weight")
    target = F.when(full, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    # Of a target of few words, no shard should get less than one.
    shards = F.least(F.ceil(F.col("n_docs") / mix.shard_docs), F.floor("target"))
    per = per.withColumn("target", target).select(
        "source", "source_size", "weight", "target",
        F.greatest(shards, F.lit(1)).cast("long").alias("n_shards"))
    return materialize(per, "targets")


# ------------------------------------------------------------------ quotas

def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _won(t: Column) -> Column:
    """How many quotients of a shard are ``t`` or more, its cap at most."""
    j = F.floor((F.col("votes") / t + 1) / 2)

    def reaches(j):
        return F.col("votes") / (2 * j - 1) >= t
    exact = F.when(reaches(j + 1), j + 1).when((j >= 1) & ~reaches(j), j - 1).otherwise(j)
    return F.least(F.greatest(exact, F.lit(0)), F.col("most")).cast("long")


def _apportioned(shards: DataFrame, house: int, mix: Mix) -> DataFrame:
    """``shards`` (source, shard, votes, most, digest, ...) with ``quota``: ``house`` blocks by the
    highest quotients."""
    every, biggest = shards.agg(F.sum("most"), F.max("votes")).first()
    if house <= 0 or not biggest:
        return shards.withColumn("quota", F.lit(0).cast("long"))
    if every <= house:
        return shards.withColumn("quota", F.col("most"))
    # The sum grows as the threshold falls: search over its negative.
    low = biggest / 2
    while _at_each(shards, _won, [low])[0] <= house:
        low /= 64
    a, b = _narrowed(shards, lambda x: _won(-x), house, -2.0 * biggest, -low, mix.most_ranked)
    won = materialize(shards.withColumn("quota", _won(F.lit(-a))).withColumn("_up", _won(F.lit(-b))), "quotas")
    need = house - _sums(won, [F.col("quota")])[0]
    # What is open: some quotients, or any number of equal ones.
    open_ = won.filter("_up > quota").select(
        "source", "shard", "votes", "digest",
        F.explode(F.sequence(F.col("quota") + 1, F.col("_up"))).alias("j"))
    if _sums(won, [F.col("_up") - F.col("quota")])[0] > mix.most_ranked:
        one, top = F.lit(1).cast("long"), float(16 ** 15)
        x, y = _narrowed(open_, lambda d: F.when(F.col("digest") < d, one), need, 0.0, top,
                         mix.most_ranked)
        sure = open_.filter(F.col("digest") < F.lit(x))
        need -= sure.count()
        open_ = open_.filter((F.col("digest") >= F.lit(x)) & (F.col("digest") < F.lit(y)))
    else:
        sure = open_.limit(0)
    order = Window.orderBy(F.desc(F.col("votes") / (2 * F.col("j") - 1)), "digest",
                           F.asc_nulls_last("source"), "shard")   # most_ranked rows at most
    picked = open_.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= need)
    more = sure.select("source", "shard").unionByName(picked.select("source", "shard")) \
        .groupBy("source", "shard").agg(F.count(F.lit(1)).alias("_more"))
    x, y = won.alias("x"), more.alias("y")
    return x.join(y, _same(F.col("x.source"), F.col("y.source"))
                  & (F.col("x.shard") == F.col("y.shard")), "left").select(
        *(F.col(f"x.{c}") for c in shards.columns),
        (F.col("quota") + F.coalesce("_more", F.lit(0))).alias("quota"))


def shard_words(shards: DataFrame, mix: Mix) -> DataFrame:
    """Words that each shard takes.  ``shards``: source, shard, shard_size, source_size, target."""
    votes = F.try_divide(F.col("target") * F.col("shard_size"), F.col("source_size"))
    digest = F.md5(F.concat_ws(":", F.lit(f"start:{mix.seed}"), "source", F.col("shard").cast("string")))
    s = shards.withColumn("votes", F.coalesce(votes, F.lit(0.0))).withColumn(
        "digest", hex_number(digest, 15)).withColumn("block", F.when(
            F.col("votes") >= mix.large_blocks * mix.block_words, mix.block_words).otherwise(1))
    s = s.withColumn("most", F.floor(mix.cap * F.col("shard_size") / F.col("block")).cast("long"))
    s = materialize(s, "shards")
    large, small = s.filter("block > 1"), s.filter("block = 1")
    out = None
    for part, words in ((large, mix.block_words), (small, 1)):
        house = math.floor(_sums(part, [F.col("votes")])[0] / words + 0.5)
        one = _apportioned(part, house, mix)
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------ placing

def mix_documents(df: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id",
                  text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: size, source_size, target, taken, and the passes and word
    ranges behind it (``passes``, ``from1``/``to1`` and ``from2``/``to2``)."""
    sizes = materialize(sized(df, id_col, text_col, source_col), "sizes")
    return _place(sizes, *_plan(sizes, mix))


def _sharded(rows: DataFrame, per: DataFrame, mix: Mix) -> DataFrame:
    """Adds to (doc_id, source, size, ...) what its source has, its digest and shard."""
    digest = F.md5(F.concat(F.lit(f"{mix.seed}:"),
                            F.coalesce(F.col("d.doc_id").cast("string"), F.lit(""))))
    return rows.alias("d").join(per.alias("p"), _same(F.col("d.source"), F.col("p.source"))).select(
        "d.*", "source_size", "target", digest.alias("_h"),
        (hex_number(digest) % F.col("n_shards")).alias("shard"))


def _plan(sizes: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame, Mix]:
    """The sources' targets and, per shard, the words it takes and from where."""
    per = source_targets(sizes, mix)
    shards = _sharded(sizes, per, mix).groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"))
    blocks = F.greatest(F.ceil(F.col("shard_size") / F.col("block")), F.lit(1))
    plan = shard_words(shards, mix).select(
        "source", "shard", "shard_size", (F.col("quota") * F.col("block")).alias("_words"),
        (F.col("digest") % blocks * F.col("block")).alias("_from"))
    return per, materialize(plan, "plan"), mix


def _place(rows: DataFrame, per: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """What the plan takes of each row."""
    rest = [c for c in rows.columns if c not in ("doc_id", "source", "size")]
    d = _sharded(rows, per, mix)
    line = Window.partitionBy("source", "shard").orderBy("_h", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_end", F.sum("size").over(line))
    x = d.alias("d").join(plan.alias("p"), _same(F.col("d.source"), F.col("p.source"))
                          & (F.col("d.shard") == F.col("p.shard")))
    size, end = F.col("size"), F.col("_end")
    start, whole = end - size, F.greatest(F.col("shard_size"), F.lit(1))
    x = x.select("d.*", "_words", "_from", whole.alias("_whole"), start.alias("_start"))
    x = x.withColumn("passes", F.floor(F.col("_words") / F.col("_whole"))) \
         .withColumn("_to", F.col("_from") + F.col("_words") % F.col("_whole"))
    start, whole = F.col("_start"), F.col("_whole")

    def within(a: Column, z: Column) -> tuple[Column, Column]:
        lo = F.least(F.greatest(a - start, F.lit(0)), size)
        return lo, F.greatest(lo, F.least(z - start, size))
    f1, t1 = within(F.col("_from"), F.least(F.col("_to"), whole))
    f2, t2 = within(F.lit(0), F.col("_to") - whole)
    x = x.select("doc_id", "source", "size", *rest, "source_size", "target", "passes",
                 f1.alias("from1"), t1.alias("to1"), f2.alias("from2"), t2.alias("to2"))
    return x.withColumn("taken", (F.col("passes") * size + F.col("to1") - F.col("from1")
                                  + F.col("to2") - F.col("from2")).cast("long"))


def mixed_texts(df: DataFrame, mix: Mix = Mix(), text_col: str = "text",
                source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The rows that the mix consists of, with the columns of ``df``: a row for
    each pass over a document and one for each cut piece of it (its words joined
    by one space; ``n_chars``, if there, is set anew)."""
    s = df.select(quoted(id_col).alias("doc_id"), quoted(source_col).alias("source"),
                  F.size(words_of(quoted(text_col))).cast("long").alias("size"),
                  F.struct(*map(quoted, df.columns)).alias("_row"))
    sizes = materialize(s.select("doc_id", "source", "size"), "sizes")
    x = _place(s, *_plan(sizes, mix))

    def piece(a, z):
        return F.struct(F.lit(True).alias("cut"), F.col(a).alias("a"), F.col(z).alias("z"))
    whole = F.struct(F.lit(False).alias("cut"), F.lit(0).cast("long").alias("a"),
                     F.col("size").alias("z"))
    parts = F.concat(F.array_repeat(whole, F.col("passes").cast("int")),
                     F.filter(F.array(piece("from1", "to1"), piece("from2", "to2")),
                              lambda p: p["z"] > p["a"]))
    x = x.filter("taken > 0").select("_row", "size", F.explode(parts).alias("_p"))
    text = F.col("_row").getField(text_col)
    cut = F.col("_p.cut") & (F.col("_p.z") - F.col("_p.a") < F.col("size"))
    out = F.when(cut, F.array_join(F.slice(
        words_of(text), (F.col("_p.a") + 1).cast("int"),
        (F.col("_p.z") - F.col("_p.a")).cast("int")), " ")).otherwise(text)
    cols = {c: F.col("_row").getField(c) for c in df.columns}
    cols[text_col] = F.col("_new")
    if "n_chars" in cols:
        cols["n_chars"] = F.char_length("_new").cast("long")
    return x.withColumn("_new", out).select(*(c.alias(n) for n, c in cols.items()))
