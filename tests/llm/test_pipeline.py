"""The pipeline's stages on the smallest documents, each against brute force on
its own input; the last one's sequences by an exact round trip of the tokens."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from ludeme.llm import mixing, packing, secrets
from ludeme.plans.session import materialize
from tests.llm.test_llm import linked_components, measured

SMALL = "/root/testdata/sf0.001"


def passes(text):
    n, chars, symbols, duplicates, repeats = measured(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))
    upper = len(re.findall("[A-Z]", text or ""))
    return not (n < 10 or 100 * repeats > 20 * n or 100 * symbols > 25 * n
                or lines >= 4 and 100 * duplicates > 30 * lines
                or not 2 * n <= chars <= 20 * n or 100 * (text or "").count("!") > 50 * n
                or 100 * upper > 70 * chars)


def redacted(text):
    spans = sorted((m.start(), m.end()) for r in secrets.RULES
                   for m in re.finditer(r.pattern, text or "")
                   if len(m[r.group]) >= r.least)
    merged = []
    for a, z in spans:
        if merged and merged[-1][1] >= a:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    for a, z in reversed(merged):
        text = f"{text[:a]}[SECRET]{text[z:]}"
    return text


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents and after each stage but the last; the last one's result."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SMALL), name.replace(" ", "-")))
    return out


def test_stage_columns(stages):
    assert len(stages) == 6
    for s in stages[1:-1]:
        assert s.columns == stages[0].columns


def test_quality_stage(stages):
    before, after = stages[0].collect(), stages[1].collect()
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before if passes(r.text))
    assert 0 < len(after) < len(before)


def test_jaccard_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = Counter({c: 1 for _, _, c in linked_components(rows)})
    assert Counter(r.doc_id for r in stages[2].collect()) == want
    assert len(want) < len(rows)


def test_secrets_stage(stages):
    want = Counter((r.doc_id, redacted(r.text)) for r in stages[2].collect())
    after = stages[3].collect()
    assert Counter((r.doc_id, r.text) for r in after) == want
    assert any("[SECRET]" in r.text for r in after)


def test_mix_stage(stages):
    taken = {r.doc_id: r.taken for r in mixing.mix_documents(stages[3]).collect() if r.taken}
    whole = {r.doc_id: r.text.split() for r in stages[3].collect()}
    got, rows = Counter(), stages[4].collect()
    for r in rows:
        words = r.text.split()
        got[r.doc_id] += len(words)
        assert " ".join(words) in " ".join(whole[r.doc_id])
        assert r.n_chars == len(r.text)
    assert got == Counter(taken)


def test_pack_stage(stages):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.TOKENIZER)
    want = Counter()
    for r in stages[4].collect():
        ids = [*t.encode(r.text, add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            p = np.array(ids[a:a + 2048], "<u4")
            want[(r.doc_id, k, a, len(p), zlib.crc32(p.tobytes()))] += 1
    out = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048


def test_run(spark, stages):
    again = corpus_pipeline.run(spark, SMALL)
    want = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stages[5].collect())
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
                   for r in again.collect()) == want
