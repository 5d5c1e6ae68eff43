"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent.

1. Each row's leaf is a digest of its fields.  Rows are sorted by group and id
   across the cluster; a rank within the group is the place in the sorted
   partition plus what the group has in earlier partitions.
2. Level by level, every ``FAN`` consecutive nodes of a group become one record
   digest -> children.  A group's last node is its subroot; the subroots, in order
   of the groups, are the leaves of a last tree that gives the root.
3. Requests (group, rank) descend from the root by the digits of the rank in base
   ``FAN``: the record of the digest at hand is looked up, the digit selects the
   next digest, the other children are collected.  What requests share of a way is
   walked once: a level's requests are the distinct ranks without their last digits.
4. A leaf's segments, collected downwards, are reversed into the proof.  Folding a
   leaf with it gives the root that the leaf belongs to.

Digests are kept as 32 bytes; an inner node hashes its children's hex text.

Every level is written to the shared folder, so a lost executor costs one level.
No group passes through one task: a hot source is many runs of ``FAN`` nodes.

Defined cases: a null field is ``-`` in a leaf; a null group is a group of its own,
first in order; null ids come first in their group; equal ids follow each other by
leaf, so repeated rows have neighbouring ranks; an empty table has no root and gives
an empty result; a single row is its own subroot and root; other columns, of any
name, are ignored or, if named, carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludeme.llm.text import quoted
from ludeme.plans.session import materialize

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, fields)), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined(digests: Column) -> Column:
    """Digests of an array side by side, as bytes."""
    return F.aggregate(digests, F.unhex(F.lit("")), lambda a, x: F.concat(a, x))


def node_of(children: Column) -> Column:
    """The digest of side-by-side children (hashed as hex text)."""
    return F.unhex(F.sha2(hex_text(children), 256))


def group_key(group: Column) -> Column:
    """Sorts as required and joins plainly: nulls first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``rank`` (from 0) and ``n`` within ``grp`` to rows sorted by grp and ``order``.

    Rows that are alike in all of them are told apart by their place in the input, so
    the sort can deal them to several tasks."""
    s = rows.withColumn("_in", F.monotonically_increasing_id()) \
        .orderBy("grp", *[F.asc_nulls_first(c) for c in order], "_in").drop("_in") \
        .withColumn("_at", F.monotonically_increasing_id())
    s = materialize(s, name).withColumn("_part", F.shiftrightunsigned("_at", 33))
    per = s.groupBy("_part", "grp").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy("grp")    # a row for each sorted partition at most
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_part", "grp", "_first", F.sum("_n").over(own).alias("n"),
                     F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return s.join(per, ["_part", "grp"]).withColumn(
        "rank", F.col("_at") - F.col("_first") + F.col("_before")) \
        .drop("_part", "_at", "_first", "_before")


@dataclass
class Forest:
    """The records of each level and the top of each group's tree."""
    levels: list[DataFrame]      # level from 1: digest, children
    tops: DataFrame              # grp, height, digest


def grow(nodes: DataFrame, name: str) -> Forest:
    """A tree for each group of ``nodes`` (grp, rank, n, digest)."""
    now = nodes.select("grp", F.col("rank").alias("at"), "n", "digest")
    levels, tops, height = [], None, 0
    while True:
        done = now.filter("n = 1").select("grp", F.lit(height).alias("height"), "digest")
        tops = done if tops is None else tops.unionByName(done)
        most = now.agg(F.max("n")).first()[0]
        if most is None or most == 1:
            return Forest(levels, materialize(tops, f"{name}-tops"))
        height += 1
        run = F.floor(F.col("at") / FAN).alias("run")
        one = now.filter("n > 1").groupBy("grp", run).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("c"))
        one = one.withColumn("children", F.transform("c", lambda x: x["digest"]))
        one = materialize(one.select(
            "grp", F.col("run").alias("at"), F.ceil(F.col("n") / FAN).alias("n"),
            node_of(joined(F.col("children"))).alias("digest"), "children"), f"{name}-{height}")
        levels.append(one.select("digest", "children"))
        now = one.drop("children")


def descend(forest: Forest, starts: DataFrame, requests: DataFrame, keep: list[str]) -> DataFrame:
    """Requests (grp, rank, ``keep``) with the segments ``path`` between the root and
    their leaf, downwards.

    ``starts``: per group the top's digest, the path to it and further columns, which
    all requests of the group get."""
    further = [c for c in starts.columns if c not in ("grp", "height", "digest", "path")]
    high = len(forest.levels)
    # A level's requests: the ways to it that are asked for.
    asked = {0: requests}
    for level in range(1, high):
        lower = asked[level - 1].select("grp", F.floor(F.col("rank") / FAN).alias("rank"))
        asked[level] = lower.distinct()
    at_hand = None
    for level in range(high, 0, -1):
        enter = starts.filter(F.col("height") == level).withColumn("rank", F.lit(0).cast("long")) \
            .drop("height")
        at_hand = enter if at_hand is None else at_hand.unionByName(enter)
        # Content-addressed: equal subtrees have one record.
        records = forest.levels[level - 1].dropDuplicates(["digest"])
        here = at_hand.join(records, "digest").drop("digest") \
            .withColumnRenamed("rank", "run")
        below = asked[level - 1].withColumn("run", F.floor(F.col("rank") / FAN))
        digit = (F.col("rank") % FAN).cast("int")
        segment = F.struct(
            joined(F.slice("children", F.lit(1), digit)).alias("left"),
            joined(F.slice("children", digit + 2, F.lit(FAN))).alias("right"))
        step = below.join(here, ["grp", "run"]).select(
            "grp", "rank", F.get("children", digit).alias("digest"),
            F.concat("path", F.array(segment)).alias("path"), *further,
            *(keep if level == 1 else []))
        at_hand = materialize(step, f"descent-{level}") if level > 1 else step
    single = requests.join(starts.filter("height = 0").drop("height"), "grp").select(
        "grp", "rank", "digest", "path", *further, *keep)
    return single if at_hand is None else at_hand.unionByName(single)


@dataclass
class Manifest:
    leaves: DataFrame            # grp, rank, n, digest and what was carried
    trees: Forest                # of the groups
    over: Forest                 # of the subroots, one group ``""``
    subroots: DataFrame          # grp "", group, rank, digest
    carried: list[str]


def manifest(df: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             group_col: str = "source", carry: dict[str, Column] | None = None) -> Manifest:
    """Leaves, records and root of ``df``.  ``carry``: further columns kept with the leaves."""
    carry = carry or {}
    rows = df.select(group_key(quoted(group_col)).alias("grp"), quoted(id_col).alias("_id"),
                     leaf_of([quoted(c) for c in fields]).alias("digest"),
                     *(c.alias(n) for n, c in carry.items()))
    # Written before they are sorted: the sort reads its input twice, and texts are long.
    leaves = materialize(ranked(materialize(rows, "digests"), ["_id", "digest"], "leaves"), "ranked")
    trees = grow(leaves, "tree")
    tops = trees.tops.select(F.lit("").alias("grp"), F.col("grp").alias("group"), "digest")
    subroots = materialize(ranked(tops, ["group"], "subroots"), "ranked-subroots")
    return Manifest(leaves, trees, grow(subroots, "over"), subroots, list(carry))


def prove(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """leaf, subroot, root, ``path`` and the carried columns of the leaves that are asked
    for (grp, rank; all if not given)."""
    top = m.over.tops.withColumn("root", F.col("digest")) \
        .withColumn("path", F.expr("cast(array() as array<struct<left:binary, right:binary>>)"))
    of_groups = descend(m.over, top, m.subroots.select("grp", "rank", "group"), ["group"])
    starts = of_groups.select(F.col("group").alias("grp"), F.col("digest").alias("subroot"),
                              "root", "path")
    starts = materialize(starts.join(m.trees.tops, "grp"), "starts")
    leaves = m.leaves if requests is None else m.leaves.join(requests.distinct(), ["grp", "rank"])
    asked = leaves.select("grp", "rank", F.col("_id").alias("_leaf_id"), *m.carried)
    return descend(m.trees, starts, asked, ["_leaf_id", *m.carried]) \
        .withColumnRenamed("digest", "leaf")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings from the leaf up, left to right."""
    ends = F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(hex_text(joined(ends)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(F.reverse(path), leaf, lambda own, s: node_of(
        F.concat(s["left"], own, s["right"])))


def audit(m: Manifest, claim: str) -> DataFrame:
    """Per leaf its digests, the proof's digest, and the root which the carried digest
    ``claim`` folds to."""
    x = prove(m).withColumn("_folded", fold(F.col(claim), F.col("path")))
    return x.select(F.col("_leaf_id").alias("doc_id"), hex_text(F.col("leaf")).alias("leaf"),
                    hex_text(F.col("subroot")).alias("subroot"),
                    hex_text(F.col("root")).alias("root"),
                    proof_digest(F.col("path")).alias("proof_sha256"),
                    hex_text(F.col("_folded")).alias("folded_root"),
                    (F.col("_folded") == F.col("root")).alias("verified"))
