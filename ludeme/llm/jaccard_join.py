"""N-gram Jaccard join by grouped prefixes, with the classes that its links form.

1. Texts become sets of hashed word shingles in tasks.  Each slice of texts sends
   its shingles, packed, to shards by hash; a shard counts in how many documents
   each shingle occurs and sends those of two or more back to their slices.
   A shingle of one document can link nothing, so most documents end here.
2. A document's prefix is its rarest n - ceil(t n) + 1 shingles (in the order:
   number of documents, hash).  Two documents that link share one of them.
   Shingles that occur once take places in the prefix but need not be kept.
3. Documents with equal sets are one class; classes with equal prefix and size
   are one group.  Candidates are pairs of groups that share a prefix shingle
   and have enough left from there on; only then are groups expanded, and the
   classes' whole sets verified.
4. Only components are wanted, so no list of a shared shingle is expanded into
   all its pairs: in rounds, each list whose members are not yet one component
   verifies its groups against one pivot, and components are merged.  What is
   still in different components when rounds no longer pay is verified pair by
   pair, which is exact whatever the rounds did.

A verified overlap counts shingles shared by at least two documents, which
contains every overlap, so texts are read once.

Defined cases: a null or empty text has no shingles and links with nothing (its
component is its own id); a text with fewer words than a shingle is one shingle;
repeated ids are separate rows with their own sets, and a component's id is its
smallest id (null if it has none); an empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludeme.llm.text import (SALTS, every_salt, hash_words, mix, quoted, split_words,
                             text_slices)
from ludeme.plans.session import materialize, shuffle_partitions

LOW = np.uint64(0xFFFFFFFFFFFF)  # bits of a shingle's hash that are kept beside its shard


@dataclass(frozen=True)
class Join:
    words: int = 5
    percent: int = 75            # 100 * intersection >= percent * union
    slice_bytes: int = 8 << 20   # text that a task holds at once
    most_rounds: int = 3         # pivot rounds before the exact rest


# ------------------------------------------------------------------ shingles

def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles."""
    starts, codes, distinct = split_words(texts)
    h = hash_words(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    out = []
    odd = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        n = len(h) - words + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for k in range(words if n > 0 else 0):
            rolled = mix(rolled * odd + h[k:k + n])
        for a, z in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if z - a >= words:
                out.append(np.unique(rolled[a:z - words + 1]))
            else:
                one = np.uint64(z - a)
                for w in h[a:z]:
                    one = mix(np.atleast_1d(one * odd + w))[0]
                out.append(np.atleast_1d(one) if z > a else np.zeros(0, np.uint64))
    return out


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _shards(df: DataFrame, id_col: str, text_col: str, j: Join, shards: int) -> DataFrame:
    """(key, slice, blob): packed shingles by shard, and under negative keys the
    rows of a slice."""
    def emit(batches):
        own = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_slices(batch, "_text", j.slice_bytes):
                for lo in range(0, part.num_rows, 1 << 15):
                    some = part.slice(lo, 1 << 15)
                    yield _one_slice(some, own, j, shards)
                    own += 1
    kind = df.schema[id_col].dataType.simpleString()  # fields of a struct become nullable
    return df.select(quoted(id_col).cast(kind).alias("_id"), quoted(text_col).alias("_text")) \
        .mapInArrow(emit, "key long, slice long, blob binary")


def _one_slice(part: pa.RecordBatch, own: int, j: Join, shards: int) -> pa.RecordBatch:
    sets = shingle_sets(part.column("_text"), j.words)
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = pa.RecordBatch.from_arrays(
        [part.column("_id"), pa.array(sizes),
         pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())],
        names=["doc_id", "n", "sig"])
    keys, blobs = [-1 - own], [_ipc(rows)]
    if sizes.sum():
        h, at = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        shard = ((h >> np.uint64(48)) * np.uint64(shards)) >> np.uint64(16)
        h = (shard << np.uint64(48)) | (h & LOW)
        order = np.argsort(h)
        h, at = h[order], at[order].astype("<u2")
        shard, low, high = h >> np.uint64(48), h.astype("<u4"), (h >> np.uint64(32)).astype("<u2")
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(h)], strict=True):
            keys.append(int(shard[a]))
            blobs.append(low[a:z].tobytes() + high[a:z].tobytes() + at[a:z].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([own] * len(keys), pa.int64()),
         pa.array(blobs, pa.binary())], names=["key", "slice", "blob"])


def _shared(packed: DataFrame) -> DataFrame:
    """(slice, kind, blob): for each shard and slice the shingles that occur in
    two documents or more, with their number of documents; rows pass through."""
    def count(t: pa.Table) -> pa.Table:
        own = t.column("slice").to_numpy()
        blobs = t.column("blob").to_pylist()
        if len(own) and t.column("key")[0].as_py() < 0:
            return pa.table({"slice": own, "kind": np.zeros(len(own), np.int32),
                             "blob": pa.array(blobs, pa.binary())})
        sizes = np.array([len(b) // 8 for b in blobs])

        def column(kind, skip):  # what lies ``skip`` bytes an entry into each blob
            return np.concatenate([np.frombuffer(b, kind, n, skip * n)
                                   for b, n in zip(blobs, sizes, strict=True)])
        h = (np.uint64(t.column("key")[0].as_py()) << np.uint64(48)) \
            | (column("<u2", 4).astype(np.uint64) << np.uint64(32)) | column("<u4", 0)
        at = column("<u2", 6)
        where = np.repeat(np.arange(len(own), dtype=np.int32), sizes)
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        n = np.diff(np.append(first, len(h)))
        n = np.repeat(n, n)
        more = n > 1
        h, n, order = h[more], n[more], order[more]
        at, where = at[order], where[order]
        back = np.argsort(where, kind="stable")
        h, n, at, where = h[back], n[back].astype("<u4"), at[back], where[back]
        found, a = np.unique(where, return_index=True)
        z = np.append(a[1:], len(where))[:len(a)]  # none of two documents: nothing
        out = [h[i:k].tobytes() + n[i:k].tobytes() + at[i:k].tobytes()
               for i, k in zip(a, z, strict=True)]
        return pa.table({"slice": own[found], "kind": np.ones(len(found), np.int32),
                         "blob": pa.array(out, pa.binary())})
    return packed.groupBy("key").applyInArrow(count, "slice long, kind int, blob binary")


def _rows(shared: DataFrame, kind: str, j: Join) -> DataFrame:
    """Per document: row, doc_id, n, sig, and for those with a kept prefix the
    prefix and the shared shingles."""
    schema = f"row long, doc_id {kind}, n long, sig binary, prefix array<long>, shared array<long>"

    def gather(t: pa.Table) -> pa.Table:
        kinds = t.column("kind").to_numpy()
        blobs = t.column("blob").to_pylist()
        own = t.column("slice")[0].as_py()
        docs = pa.ipc.open_stream(blobs[int(np.argmin(kinds))]).read_all()
        size = docs.column("n").to_numpy()
        packs = [b for b, k in zip(blobs, kinds, strict=True) if k]
        counts = [len(b) // 14 for b in packs]

        def column(kind_, skip):
            parts = [np.frombuffer(b, kind_, n, skip * n) for b, n in zip(packs, counts, strict=True)]
            return np.concatenate(parts) if parts else np.zeros(0, kind_)
        h, n, at = column("<u8", 0), column("<u4", 8), column("<u2", 12).astype(np.int64)
        order = np.lexsort((h, n, at))
        h, at = h[order].view(np.int64), at[order]
        have = np.bincount(at, minlength=len(size))
        start = np.cumsum(have) - have
        length = size - -(-j.percent * size // 100) + 1
        keep = np.where(size > 0, length - (size - have), 0)
        prefix, shared_ = [None] * len(size), [None] * len(size)
        for i in np.flatnonzero(keep > 0):
            own_h = h[start[i]:start[i] + have[i]]
            prefix[i], shared_[i] = own_h[:keep[i]], own_h
        longs = pa.list_(pa.int64())
        return pa.table({
            "row": (own << 15) + np.arange(len(size)), "doc_id": docs.column("doc_id"),
            "n": size, "sig": docs.column("sig"), "prefix": pa.array(prefix, longs),
            "shared": pa.array(shared_, longs)})
    return shared.groupBy("slice").applyInArrow(gather, schema)


def shingled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             j: Join = Join()) -> DataFrame:
    """The written table of rows with prefixes and shared shingles."""
    shards = min(1 << 16, shuffle_partitions(df.sparkSession))
    packed = _shards(df, id_col, text_col, j, shards)
    kind = df.schema[id_col].dataType.simpleString()
    return materialize(_rows(_shared(packed), kind, j), "shingled")


# ------------------------------------------------------------------ components

def _fingerprint(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")) \
        .first()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node reaches over edges (u, v).

    Alternates two contractions, each one grouping and one join: every larger
    neighbour moves to the smallest one, then every node and its smaller
    neighbours do.  A node's neighbours are never gathered.  Each step is
    written, so a lost executor costs one step."""
    e = edges.filter("u != v").select(F.greatest("u", "v").alias("u"),
                                      F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "edges")
    before = None
    while True:
        now = _fingerprint(e)
        if now == before or now["n"] == 0:
            break
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        x = large.join(least, "u")
        small = x.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.withColumnRenamed("m", "v"))
        e = materialize(small.distinct(), "edges")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp"))


# ------------------------------------------------------------------ candidates

class _Links:
    """The rounds over one set of classes; ``comp`` maps classes to components."""

    def __init__(self, classes: DataFrame, j: Join):
        self.j, self.sets = j, classes.select("cls", "n", "shared")
        groups = classes.groupBy("n", "prefix").agg(
            F.min("cls").alias("grp"), F.count(F.lit(1)).alias("size"))
        member = classes.join(groups, ["n", "prefix"]).select("cls", "grp", "n")
        self.members = materialize(member, "members")
        # rest: what a class has from this shingle on, itself included.
        lists = groups.select("grp", "n", F.posexplode("prefix").alias("at", "token"))
        length = F.col("n") - F.ceil(j.percent * F.col("n") / 100) + 1
        lists = lists.join(groups.select("grp", F.size("prefix").alias("kept")), "grp").select(
            "token", "grp", "n", (F.col("n") - (length - F.col("kept")) - F.col("at")).alias("rest"))
        # A list of one group pairs nothing; of lists with the same groups at the
        # same places one is enough.
        h = F.xxhash64("grp", "rest")
        several = lists.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(h).alias("x"),
                                             F.bit_xor(F.xxhash64(h, F.lit(1))).alias("y"))
        several = several.filter("k > 1").groupBy("k", "x", "y").agg(F.min("token").alias("token"))
        self.lists = materialize(lists.join(several.select("token"), "token"), "lists")
        self.edges: list[DataFrame] = []
        self.comp = None

    def labelled(self, members: DataFrame) -> DataFrame:
        if self.comp is None:
            return members.withColumn("comp", F.col("cls"))
        return members.join(self.comp.withColumnRenamed("node", "cls"), "cls", "left") \
            .withColumn("comp", F.coalesce("comp", "cls"))

    def verify(self, pairs: DataFrame) -> None:
        """Adds the links among pairs (a, b) of classes and merges components."""
        a = self.sets.select(F.col("cls").alias("a"), F.col("n").alias("n_a"),
                             F.col("shared").alias("s_a"))
        b = self.sets.select(F.col("cls").alias("b"), F.col("n").alias("n_b"),
                             F.col("shared").alias("s_b"))
        both = F.size(F.array_intersect("s_a", "s_b"))
        found = pairs.join(a, "a").join(b, "b").select(
            "a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), both.alias("i"))
        found = found.filter(100 * F.col("i") >= self.j.percent * (F.col("n") - F.col("i")))
        self.edges.append(materialize(found.select(F.col("a").alias("u"), F.col("b").alias("v")),
                                      "links"))
        edges = self.edges[0]
        for e in self.edges[1:]:
            edges = edges.unionByName(e)
        self.comp = materialize(components(edges), "components")
        # The components' stars say the same with fewer rows.
        self.edges = [self.comp.select(F.col("node").alias("u"), F.col("comp").alias("v"))]

    def _fit(self, n1: str, rest1: str, n2: str, rest2: str):
        """Whether the overlap can be large enough if this is the first shingle
        that the two share: it lies within what both have from here on."""
        t = self.j.percent
        return (100 + t) * F.least(rest1, rest2) >= t * (F.col(n1) + F.col(n2))

    def groups(self) -> DataFrame:
        return self.labelled(self.members).groupBy("grp").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"))

    def open_lists(self, turn: int) -> DataFrame:
        """Lists (with a pivot) that are not yet within one component.

        The pivot is what has the smallest part of its own, as the text has from
        which copies were made; in later rounds, the one of such in a component
        drawn by a hash."""
        x = self.lists.join(self.groups(), "grp")
        drawn = F.xxhash64("lo", F.lit(turn)) if turn else F.lit(0).cast("long")
        pivot = F.min_by(F.struct("grp", "n", "rest"),
                         F.struct(drawn, (F.col("n") - F.col("rest")) / F.col("n"), "grp"))
        return x.groupBy("token").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), pivot.alias("pivot"),
            F.count(F.lit(1)).alias("k")).filter("lo < hi")

    def rest(self) -> tuple[int, int]:
        """Group pairs in different components left in the lists, and list rows."""
        x = self.lists.join(self.groups(), "grp").groupBy("token", "lo").agg(
            F.count(F.lit(1)).alias("k"))
        x = x.groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("q"))
        r = x.agg(F.sum((F.col("k") * F.col("k") - F.col("q")) / 2).alias("p"),
                  F.sum("k").alias("k")).first()
        return int(r["p"] or 0), int(r["k"] or 0)

    def round(self, turn: int) -> None:
        x = self.lists.join(self.open_lists(turn).select("token", "pivot"), "token")
        x = x.filter(self._fit("n", "rest", "pivot.n", "pivot.rest")).filter("grp != pivot.grp") \
            .select("grp", F.col("pivot.grp").alias("b")).distinct()
        if turn == 0:  # members of a group against its first
            x = x.unionByName(self.members.filter("cls != grp").select(
                "grp", F.col("grp").alias("b")).distinct())
        m = self.labelled(self.members)
        pairs = x.join(m, "grp").select(F.col("cls").alias("a"), "b", "comp")
        other = m.filter("cls = grp").select(F.col("cls").alias("b"), F.col("comp").alias("c2"))
        pairs = pairs.join(other, "b").filter("comp != c2").select("a", "b").distinct()
        self.verify(pairs)

    def finish(self) -> None:
        """Every pair of the lists and groups that is still in two components.

        Sets whose sizes differ by more than the threshold cannot link, so a list is joined
        with itself by classes of size, each with itself and the next one; and a class's left
        side is dealt to several parts, so no key holds a whole list."""
        g = self.groups()
        x = self.lists.join(self.open_lists(0).select("token"), "token").join(g, "grp")
        by = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / self.j.percent))).cast("int") \
            if self.j.percent < 100 else F.col("n").cast("int")
        x = materialize(x.withColumn("by", by), "open-lists")
        part = F.pmod(F.xxhash64("grp"), F.lit(SALTS))
        y = x.select("token", F.explode(F.array(F.col("by") - 1, F.col("by"))).alias("by"),
                     F.col("by").alias("by2"), every_salt().alias("part"),
                     F.col("grp").alias("g2"), F.col("n").alias("n2"), F.col("rest").alias("rest2"),
                     F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        far = (F.col("lo") != F.col("lo2")) | (F.col("lo") != F.col("hi")) \
            | (F.col("lo2") != F.col("hi2"))
        once = (F.col("by") < F.col("by2")) | (F.col("grp") < F.col("g2"))
        pairs = x.withColumn("part", part).join(y, ["token", "by", "part"]).filter(once & far) \
            .filter(self._fit("n", "rest", "n2", "rest2")).select("grp", "g2").distinct()
        pairs = pairs.unionByName(g.filter("lo < hi").select("grp", F.col("grp").alias("g2")))
        m = self.labelled(self.members).select("grp", "cls", "comp")
        p = pairs.join(m, "grp").select(F.col("cls").alias("a"), F.col("comp").alias("c1"), "g2")
        p = p.join(m.withColumnRenamed("grp", "g2"), "g2") \
            .filter((F.col("c1") != F.col("comp")) & (F.col("a") != F.col("cls")))
        self.verify(p.select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b"))
                    .distinct())


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       j: Join = Join()) -> DataFrame:
    """Per row: row (a number of its own), doc_id, n_shingles, class_id (rows of
    equal sets) and component_id."""
    rows = shingled(df, id_col, text_col, j)
    active = rows.filter("prefix IS NOT NULL")
    same = active.groupBy("n", "sig").agg(F.min("row").alias("cls"))
    classes = active.join(same.select("cls"), F.col("row") == F.col("cls"), "left_semi") \
        .select(F.col("row").alias("cls"), "n", "prefix", "shared")
    links = _Links(classes, j)
    last = None
    for turn in range(j.most_rounds):
        links.round(turn)
        left, k = links.rest()
        if left <= 4 * k or (last is not None and left > 0.7 * last):
            break
        last = left
    links.finish()
    comp = links.comp.withColumnRenamed("node", "cls")
    x = rows.select("row", "doc_id", "n", "sig", F.col("prefix").isNotNull().alias("on"))
    of = active.select("row", "n", "sig").join(same, ["n", "sig"]).select("row", "cls") \
        .join(comp, "cls", "left").select("row", "cls", F.coalesce("comp", "cls").alias("comp"))
    x = x.join(of, "row", "left").withColumn("cls", F.coalesce("cls", "row")) \
        .withColumn("comp", F.coalesce("comp", "row"))
    least = x.filter("on").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return x.join(least, "comp", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"),
        F.when(F.col("on"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                j: Join = Join()) -> DataFrame:
    """``df`` without the near copies: of each component the row with the
    smallest id stays, and every row that links with nothing.  Of rows with
    equal id and text one stays, the first by what its columns hold (as JSON)."""
    key = F.struct(quoted(id_col).alias("id"), F.md5(F.coalesce(quoted(text_col), F.lit("")))
                   .alias("text"))
    x = df.select(F.struct(*map(quoted, df.columns)).alias("_row"), key.alias("_of"))
    found = jaccard_components(df.select(key.alias("_key"), quoted(text_col).alias("_text")),
                               "_key", "_text", j)
    stay = found.filter("doc_id <=> component_id").select(
        F.col("doc_id.id").alias("_id"), F.col("doc_id.text").alias("_md5")).distinct()
    x = x.join(stay, F.col("_of.id").eqNullSafe(F.col("_id"))
               & (F.col("_of.text") == F.col("_md5")))
    own = Window.partitionBy("_id", "_md5").orderBy(F.to_json("_row"))
    x = x.withColumn("_nr", F.row_number().over(own)).filter("_nr = 1")
    return x.select(*(F.col("_row").getField(c).alias(c) for c in df.columns))
