"""Hard negatives, Merkle manifest and substring dedup against brute force, with the
cases that each docstring defines."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludeme.llm import hard_negatives, merkle, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ hard negatives

def vectors(seed, n, dims=7):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(4, dims))
    rows = []
    for i in range(n):
        v = (middle[i % 4] + 0.4 * rng.normal(size=dims)).astype(np.float32)
        rows.append((i, [float(x) for x in v], int(i % 4)))
    return rows


def brute_negatives(rows, m):
    good = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for a, label, q in good:
        if a % m.every:
            continue
        others = [(-score(q, v), i, other == label) for i, other, v in good if i != a]
        for s, p, _ in sorted(x for x in others if x[2])[: m.positives]:
            fit = sorted(x for x in others if not x[2] and -m.low * s <= -100 * x[0] <= -m.high * s)
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(fit[: m.negatives], 1)]
    return Counter(out)


SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, cell int"


def mined(spark, rows, m, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(parts)
    return Counter(tuple(r)[:6] for r in hard_negatives.mine(df, m).collect())


def test_hard_negatives(spark):
    rows = vectors(3, 240)
    rows += [(250, None, 1), (251, [1.0, None], 1), (252, [float("nan")] * 7, 1), (253, [], 2),
             (None, [1.0] * 7, 1), (254, [1.0] * 7, None), (255, [0.0] * 7, 1),
             (260, rows[0][1], 0), (261, rows[0][1], 1), (261, rows[0][1], 1), (262, [0.5] * 9, 3)]
    rows += [(300 + i, rows[20][1], i % 2) for i in range(40)]      # ties
    for m in (hard_negatives.Mining(every=10, cell_rows=4, shard_rows=16),
              hard_negatives.Mining(every=10, cell_rows=10_000)):
        assert mined(spark, rows, m) == brute_negatives(rows, m)


def test_hard_negatives_odd_tables(spark):
    m = hard_negatives.Mining(every=2)
    for rows in ([], [(0, [1.0, 2.0], 1)], [(i, [1.0, 0.0], 0) for i in range(6)],
                 [(i, None, None) for i in range(4)], [(i, [0.0, 0.0], i % 2) for i in range(6)],
                 [(i, [-1.0, float(i)], i % 2) for i in range(9)]):
        assert mined(spark, rows, m, 2) == brute_negatives(rows, m)


def test_multi_sequence_visits_every_cell_once_in_order():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 6, 9).astype(float), rng.integers(0, 6, 5).astype(float)
    got = list(hard_negatives.multi_sequence(a, b))
    assert sorted((i, j) for _, i, j in got) == [(i, j) for i in range(9) for j in range(5)]
    assert all(x[0] >= y[0] for x, y in zip(got, got[1:])) and all(s == a[i] + b[j] for s, i, j in got)


def test_walks_skip_cells(spark):
    rows = [(i, [100.0 * (i % 8 == k) + (i // 8) * 0.01 for k in range(8)], (i % 8) // 2)
            for i in range(800)]
    m = hard_negatives.Mining(every=50, cell_rows=8)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    out = hard_negatives.mine(df, m)
    assert out.agg(F.max("scored_positives")).first()[0] or 0 < 200
    assert Counter(tuple(r)[:6] for r in out.collect()) == brute_negatives(rows, m)


# ------------------------------------------------------------------ Merkle manifest

DOCS = "doc_id long, source string, lang string, n_chars long, text string, grp string, rank int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row, text):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}"
                       for x in (*row[:4], text)))


def brute_tree(nodes):
    """Levels of a tree, as lists of runs of children."""
    levels = []
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        levels.append(runs)
        nodes = [sha("".join(r)) for r in runs]
    return levels, nodes[0]


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        claim = r[4]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and claim is not None:
            claim = "".join(c.lower() if "A" <= c <= "Z" else c for c in claim)
        by[r[1]].append((r[0] is not None, r[0] or 0, brute_leaf(r, r[4]), brute_leaf(r, claim), r[0]))
    groups = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in groups:
        by[s].sort()
        trees[s] = brute_tree([x[2] for x in by[s]])
    over, root = brute_tree([trees[s][1] for s in groups])
    out = []
    for g, s in enumerate(groups):
        levels, sub = trees[s]
        for i, (_, _, leaf, claim, doc) in enumerate(by[s]):
            own, proof = claim, ""
            for at, ls in ((i, levels), (g, over)):
                for runs in ls:
                    run, k = runs[at // 16], at % 16
                    proof += "".join(run[:k] + run[k + 1:])
                    own = sha("".join(run[:k] + [own] + run[k + 1:]))
                    at //= 16
            out.append((doc, leaf, sub, root, sha(proof), own, own == root))
    return Counter(out)


def audited(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, "g", 1) for r in rows], DOCS).repartition(parts)
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when(number % 5 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                               "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    claim = merkle.leaf_of([text if c == "text" else F.col(c) for c in merkle.FIELDS])
    out = merkle.audit(merkle.manifest(df, carry={"claim": claim}), "claim")
    return Counter(tuple(r) for r in out.collect())


def test_merkle(spark):
    rows = [(i, "hot", "en", 3, f"Text {i} É") for i in range(290)]
    rows += [(1000 + i, f"s{i % 19}", None, None, "Two" if i % 3 else None) for i in range(57)]
    rows += [(5, None, "de", 1, ""), (None, "hot", "en", 0, "NO id"), (5, "", "x", 2, "EMPTY source"),
             (9, "ß", "x", 2, "a"), (9, "z", "x", 2, "a")]
    rows += [(7, "same", "en", 4, "Copy")] * 40
    got = audited(spark, rows)
    assert got == brute_manifest(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_merkle_small(spark, n):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(n)]
    assert audited(spark, rows, 2) == (brute_manifest(rows) if n else Counter())
    rows = [(i, f"s{i}", "en", 1, f"T{i}") for i in range(n)]
    assert audited(spark, rows, 2) == (brute_manifest(rows) if n else Counter())


def test_merkle_some_requests(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "en", 1, f"T{i}", "g", 1) for i in range(80)], DOCS)
    m = merkle.manifest(df)
    asked = spark.createDataFrame([("=a", 3), ("=b", 39), ("=b", 39), ("=c", 0), ("=a", 99)],
                                  "grp string, rank long")
    got = merkle.prove(m, asked).withColumn("ok", merkle.fold(F.col("leaf"), F.col("path"))
                                            == F.col("root"))
    assert sorted((r["grp"], r["rank"], r["_leaf_id"], r["ok"]) for r in got.collect()) \
        == [("=a", 3, 6, True), ("=b", 39, 79, True)]


# ------------------------------------------------------------------ substrings

def brute_removed(rows, n):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept)))
    return Counter(out)


def removed(spark, rows, r, parts=4):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id long, text string, slice string, kind int").repartition(parts)
    out = substrings.dedup(df, r=r).collect()
    assert all(x["n_removed"] == sum(s["to"] - s["from"] for s in x["spans"]) for x in out)
    return Counter((x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in out)


def passages(seed):
    rng = np.random.default_rng(seed)
    words = [f"w{x}" for x in range(30)] + ["The", "the", "É x", "#"]
    shared = [" ".join(rng.choice(words, 40)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice(words, int(rng.integers(0, 50))))]
        for k in rng.integers(0, 6, int(rng.integers(0, 3))):
            cut = shared[k].split(" ")
            parts += [" ".join(cut[int(rng.integers(0, 20)):]), " ".join(rng.choice(words, 9))]
        rows.append((i, " \t".join(parts) + "\n"))
    rows += [(i + 100, rows[3][1]) for i in range(25)] + [(3, rows[3][1]), (None, rows[3][1])]
    rows += [(200, None), (201, ""), (202, "the " * 400), (203, "the " * 13), (204, "the " * 12),
             (150, " ".join(words[:13])), (149, " ".join(words[:14]))]
    return rows


@pytest.mark.parametrize("r", [
    substrings.Repeats(), substrings.Repeats(group=20, slice_bytes=500, shard_bytes=200),
    substrings.Repeats(group=1, most_long=5, slice_bytes=2000),
    substrings.Repeats(words=5, gram=3, lengths=(1, 2), group=10, slice_bytes=900)])
def test_substrings(spark, r):
    rows = passages(8)
    assert removed(spark, rows, r) == brute_removed(rows, r.words)


def test_substrings_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(50))
    for rows in ([], [(1, text)], [(i, f"a{i} b c") for i in range(5)], [(1, text)] * 4,
                 [(None, text)] * 3, [(i, None) for i in range(3)], [(i, text) for i in range(9)]):
        assert removed(spark, rows, substrings.Repeats(), 2) == brute_removed(rows, 13)


def test_subtree_depths():
    path = np.array([[1, 2, 3], [1, 2, 4], [1, 2, 3], [0, 2, 3], [1, 2, 3]], "<u4")
    order, common = substrings.subtree(path)
    assert path[order].tolist() == sorted(path.tolist())
    assert common.tolist() == [0, 3, 3, 2]
    assert substrings.deep_nodes(common, 3).tolist() == [0, 1, 4]


def test_texts_without_repeats(spark):
    rows = [(i, t) for i, t in passages(9)[:60]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    shas = {r["doc_id"]: r["kept_sha256"] for r in substrings.dedup(df).collect()}
    out = {r["doc_id"]: r["text"] for r in substrings.without_repeats(df).collect()}
    assert len(out) == 60 and any(out[i] != t for i, t in rows)
    assert all(sha(" ".join(WORD.findall(t))) == shas[i] for i, t in out.items())
