"""Every operator over clean, tiny and odd tables: results of the right rows, no crash."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ludeme.llm import (chat_format, html_main, jaccard_join, kn_lm, merkle, mixing, packing,
                        quality, secrets, substrings, url_lists)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(i, n=40):
    return " ".join(f"w{i}x{k}" for k in range(n))


def unlike(n):
    return [(i, prose(i), "en", "ab"[i % 2], 1) for i in range(n)]


TABLES = {
    "empty": [],
    "one": unlike(1),
    "two unlike": unlike(2),
    "unlike": unlike(20),
    "equal": [(7, prose(7), "en", "a", 1)] * 12,
    "copies": [(i, prose(7), "en", "a", 1) for i in range(12)],
    "two of three": [*unlike(2), (5, prose(0), "en", "a", 1)],
    "null": [(None, None, None, None, None)] * 5,
    "no words": [*unlike(6), (90, "", "en", "hollow", 0), (91, None, "en", "hollow", 0),
                 (92, " \n", "en", None, 0)],
    "only hollow": [(i, None if i % 2 else "", "en", "h", 0) for i in range(6)],
}


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Tiny tables, many jobs: two partitions are enough but where a test says otherwise."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def same_rows(got, want):
    return Counter(map(tuple, got)) == Counter(map(tuple, want))


def loaded(spark, name):
    rows = TABLES[name]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(2)


@pytest.mark.parametrize("name", ["empty", "one", "unlike", "equal", "null", "no words"])
def test_row_operators(spark, name):
    rows, df = loaded(spark, name)
    ids = Counter(r[0] for r in rows)

    def counted(out, col="doc_id"):
        return Counter(r[col] for r in out.collect())
    assert counted(quality.ledger(df)) == ids
    assert counted(jaccard_join.jaccard_components(df)) == ids
    assert counted(secrets.digest(secrets.secrets_of(df, secrets.find(df), ["doc_id"]))) == ids
    assert counted(substrings.dedup(df)) == ids
    assert counted(merkle.audit(merkle.manifest(df, carry={"claim": merkle.leaf_of(
        [F.col(c) for c in merkle.FIELDS])}), "claim").filter("verified")) == ids
    mixed = mixing.mix_documents(df).collect()
    assert Counter(r["doc_id"] for r in mixed) == ids
    size = sum(r["size"] for r in mixed)
    assert size == sum(len((r[1] or "").split()) for r in rows)
    assert abs(sum(r["taken"] for r in mixed) - size) <= 0.01 * size + 1
    assert all(r["target"] == 0 for r in mixed if r["source_size"] == 0)


@pytest.mark.parametrize("name", ["two unlike", "copies", "only hollow"])
def test_pipeline_stages(spark, name):
    rows, df = loaded(spark, name)
    good = [r for r in rows if r[1] and r[1].strip()]
    out = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, "")
        assert out.columns == df.columns
    distinct = {r[1] for r in good}
    assert all(any(r["text"] in t for t in distinct) for r in out.collect())   # or cut from it
    last = corpus_pipeline.STAGES[-1][1](spark, out, "")
    assert last.count() == out.count()


@pytest.mark.parametrize("name", ["empty", "equal", "null", "no words"])
def test_models_and_pages(spark, name):
    rows, df = loaded(spark, name)
    assert kn_lm.fit_and_score(df).count() == len(rows)
    pages = df.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"),
                      F.concat(F.lit("<p>"), "text").alias("html"))
    got = html_main.extract(pages, html_main.fit_weights(pages))
    assert Counter(r["page_id"] for r in got.collect()) == Counter(r[0] for r in rows)
    captures = pages.withColumn("fetched_at", F.lit(1_704_067_300))
    assert url_lists.judge(captures, url_lists.entries_of(pages)).count() == len(rows)


#: Names that operators use inside, verdicts' own names, and names with dots.
CLASHES = ["_id", "_md5", "_row", "_u", "_at", "_text", "_of", "_nr", "_h", "top", "n_block", "kept",
           "size", "shard", "comp", "cls", "row", "key", "slice", "blob", "rank", "grp", "digest",
           "leaf", "found", "_salt", "a.b", "x y", "votes", "block", "passes"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [*unlike(8), (3, prose(3), "en", "b", 1), (50, prose(3), "en", "b", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *(F.lit(f"v{i}").alias(c) for i, c in enumerate(CLASHES))), len(rows)


def test_clashing_names(clashing, tmp_path):
    df, n = clashing
    spark = df.sparkSession
    assert quality.ledger(df).count() == jaccard_join.jaccard_components(df).count() == n
    assert mixing.mix_documents(df).count() == substrings.dedup(df).count() == n
    assert merkle.prove(merkle.manifest(df)).count() == n
    assert secrets.secrets_of(df, secrets.find(df), ["doc_id", "a.b", "found"]).count() == n
    assert kn_lm.fit_and_score(df).count() == n and packing.pack_documents(df).count() == n
    out = df
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, out, "")
        assert out.columns == df.columns
        out.write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
    assert out.filter("`a.b` = 'v26'").count() == out.count() > 0
    captures = df.select("*", F.col("source").alias("url"), F.lit(1).alias("fetched_at"))
    judged = url_lists.judge(captures, url_lists.entries_of(
        captures.select(F.col("doc_id").alias("page_id"), "url")))
    judged.write.parquet(str(tmp_path / "judged"))
    assert judged.count() == n and judged.columns.count("kept") == 1
    pages = df.withColumn("page_id", F.col("doc_id")).withColumn("url", F.lit("u")) \
        .withColumn("html", F.concat(F.lit("<article>"), "text"))
    assert html_main.extract(pages, html_main.fit_weights(pages)).count() == n
    chats = df.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("u").alias("role"),
                      "text", "_id", "key", "`a.b`")
    assert chat_format.digest(chat_format.format_conversations(chats)).count() == 9


@pytest.mark.parametrize("name, parts", [("unlike", 2000), ("two of three", 1), ("sf0.001", 2000)])
def test_many_shuffle_partitions(spark, name, parts):
    """A shard in which no shingle occurs twice, as wide settings make them."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") if name == "sf0.001" \
        else loaded(spark, name)[1]

    def classes():
        return sorted((r["doc_id"], r["component_id"])
                      for r in jaccard_join.jaccard_components(df).collect())
    want = classes()
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert classes() == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_one_of_equal_rows_is_the_same_one(spark):
    rows = [(1, prose(1), note) for note in "cab"]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string")
    for parts in (1, 2, 3):
        assert [r["note"] for r in jaccard_join.one_of_each(df.repartition(parts)).collect()] == ["a"]


def test_small_sources_are_mixed_whole(spark):
    """Two thousand sources of one document of 1 to 10 words, and one large one."""
    rows = [(i, " ".join(["w"] * (i % 10 + 1)), f"s{i:04d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_documents(df).collect()
    total = sum(i % 10 + 1 for i in range(2000))
    assert abs(sum(r["taken"] for r in out) - total) <= 0.01 * total
    assert all(r["taken"] > 0 for r in out if r["target"] >= 1)
    assert all(abs(r["taken"] - r["target"]) <= 1 and r["taken"] <= 3 * r["size"] for r in out)
    big = spark.createDataFrame([(9000 + i, "w " * 3000, "big") for i in range(30)],
                                "doc_id long, text string, source string")
    small = df.filter("doc_id < 7")
    out = mixing.mix_documents(big.unionByName(small)).collect()
    assert all(r["taken"] == 3 * r["size"] for r in out if r["source_size"] < 100)
    assert abs(sum(r["taken"] for r in out) - sum(r["size"] for r in out)) < 33
    again = mixing.mix_documents(big.unionByName(small).repartition(7)).collect()
    assert same_rows([(r["doc_id"], r["taken"]) for r in out], [(r["doc_id"], r["taken"]) for r in again])


def test_equal_quotients_are_dealt_by_digest(spark):
    """More ties than are ranked: those with the smallest digests win, and the house is full."""
    rows = [(i, "one two three", f"s{i}") for i in range(300)] + [(1000, "w " * 60, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = mixing.mix_documents(df, mixing.Mix(weights=(1,), most_ranked=5)).collect()
    all_ = mixing.mix_documents(df, mixing.Mix(weights=(1,))).collect()
    assert same_rows([(r["doc_id"], r["taken"]) for r in few], [(r["doc_id"], r["taken"]) for r in all_])
    assert sum(r["taken"] for r in few) == 960


# ------------------------------------------------------------------ chat templates

def conversation(n, system=1):
    return [{"role": "system" if k < system else "user" if k % 2 else "assistant", "content": f"text {k}"}
            for k in range(n)]


def formatted(spark, messages, template, f=chat_format.Format()):
    df = spark.createDataFrame([(1, k, m["role"], m["content"]) for k, m in enumerate(messages)],
                               "conv_id long, turn long, role string, text string")
    rows = chat_format.format_conversations(df, f, template).orderBy("block").collect()
    return "".join(r["formatted"] for r in rows), sum(len(r["rewrites"]) for r in rows)


def test_system_turns_are_in_every_context(spark):
    def with_system(messages):
        lead = "".join(m["content"] for m in messages if m["role"] == "system")
        return "".join(f"[{lead}|{m['content']}]" for m in messages)
    for system in (1, 3):
        m = conversation(80, system)
        out, rewrites = formatted(spark, m, with_system)
        whole = with_system(m)
        assert out[-200:] == whole[-200:] and (rewrites == 0 if system == 1 else rewrites <= 3)


@pytest.mark.parametrize("template", [
    lambda ms: "".join(f"[{k}|{m['content']}]" for k, m in enumerate(ms)),            # numbered
    lambda ms: "".join(f"[{ms[0]['content'] if k else ''}|{m['content']}]" for k, m in enumerate(ms)),
    lambda ms: "".join(f"[{ms[k - 9]['content'] if k >= 9 else ''}|{m['content']}]"
                       for k, m in enumerate(ms)),                                     # nine before
], ids=["numbered", "first turn", "nine turns before"])
def test_history_beyond_the_context_is_reported(spark, template):
    m = conversation(80, 0)
    out, rewrites = formatted(spark, m, template)
    assert out == template(m) or rewrites > 0
    assert formatted(spark, m, chat_format.chatml) == (chat_format.chatml(m), 0)


# ------------------------------------------------------------------ main text

TEXT = " ".join(f"w{i}" for i in range(60))
W = {"word": 2.0, "tag": -1.0, "p": -0.05, "a": -4.0, "li": -3.0, "h1": -0.05}


@pytest.mark.parametrize("page", [
    f"<html><head><title>x</title><meta name=a><body><article><p>{TEXT}</p></article>",
    f"<body><form id='aspnetForm' action=x><div><input type=hidden><p>{TEXT}</p></div></form></body>",
    f'<article data-col2="hidden"><p>{TEXT}</p></article>',
    f"<div class=content hidden-xs><p>{TEXT}</p></div>",
    f'<div :class="ad" x.y:z="hidden"><p>{TEXT}</p></div>',
    f"<div><p class=ad>Buy<p>{TEXT}</div>",
    f"<div><p class=ad>Buy<div><p>{TEXT}</div></div>",
    f"<ul><li class=ad>Buy<li class=ad><b>x</b></ul><p>{TEXT}</p>",
    f"<p>{TEXT}</p><form><label>mail</label><input>subscribe to news</form>",
    f"<div hidden>no words of this</div><p>{TEXT}</p>",
    f"<table><tr><td class=sidebar>menu<td><p>{TEXT}</p></table>"])
def test_pages_that_came_out_empty(page):
    assert html_main.main_text(page, W) == TEXT


def test_weights_are_fitted_on_pages_as_they_are(spark):
    menu = "<ul>" + "".join(f"<li><a href=x>link {i}</a></li>" for i in range(30)) + "</ul>"
    rows = [(i, f"<div><nav>{menu}</nav><div><article><h1>t</h1>" + f"<p>{TEXT}</p>" * 5
             + f"</article></div><footer><a>x</a></footer></div>") for i in range(20)]
    df = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    w = html_main.fit_weights(df)
    assert w["a"] < -1 and w["li"] < -1 and w["div"] < 0 < w["word"] < 8 and w["tag"] < 0
    # Two unnamed menus around the story, and neither article nor main.
    page = f"<div><div>{menu}</div><div><h1>The title</h1><p>{TEXT}</p><p>{TEXT}</p></div><div>{menu}</div></div>"
    assert html_main.main_text(page, w) == f"The title\n\n{TEXT}\n\n{TEXT}"


def test_text_without_spaces():
    zh = "这是一个关于网页正文提取的测试段落它没有空格" * 4
    menu = "".join(f"<li><a href=x>目录{i}</a></li>" for i in range(8))
    w = {"word": 1.0, "tag": -1.0, "a": -3.0, "li": -3.0}
    assert html_main.main_text(f"<ul>{menu}</ul><div><p>{zh}</p><p>{zh}</p></div><ul>{menu}</ul>", w) \
        == f"{zh}\n\n{zh}"


def test_region_is_the_best_of_all_ranges():
    import itertools
    import random
    rnd = random.Random(3)
    w = {"word": 1.5, "tag": -1.0, "a": -2.5, "p": -0.25}
    for _ in range(200):
        tokens = [html_main.Token(rnd.choice(["p", "a", "div"]), "", False) if rnd.random() < 0.6
                  else html_main.Token("", "x " * rnd.randint(1, 3), False) for _ in range(14)]

        def total(a, z):
            return sum(w.get(t.name, w["tag"]) if t.name else w["word"] * len(t.text.split())
                       for t in tokens[a:z])
        best = max(total(a, z) for a, z in itertools.combinations_with_replacement(range(15), 2))
        assert total(*html_main.region(tokens, w)) == pytest.approx(best)


# ------------------------------------------------------------------ the secrets' ledger

def test_ledger_scans_only_new_pairs(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    text = 'password = "abcDEF123456" and ghp_' + "a" * 40
    df = spark.createDataFrame([(1, text), (2, text), (3, "nothing"), (4, None)], "doc_id long, text string")
    looked = []
    real = secrets.scan

    def scan(todo, rules=secrets.RULES):
        looked.extend((r["blob"], k) for r in todo.collect() for k in r["todo"])
        return real(todo, rules)
    monkeypatch.setattr(secrets, "scan", scan)
    first = secrets.find(df, rules=secrets.BASE_RULES, store=store).collect()
    assert len(looked) == 3 * len(secrets.BASE_RULES) and {r["kind"] for r in first} == {"assign"}
    looked.clear()
    found = secrets.find(df, store=store)
    assert len(looked) == 3 * len(secrets.EXTRA_RULES)
    assert Counter(r["kind"] for r in found.collect()) == {"assign": 1, "github": 1}
    whole = secrets.digest(secrets.secrets_of(df, real(secrets.new_blobs(df)), ["doc_id"]))
    assert same_rows(secrets.digest(secrets.secrets_of(df, found, ["doc_id"])).collect(), whole.collect())
    looked.clear()
    more = df.unionByName(spark.createDataFrame([(5, "token: abcdefghijkl99")], df.schema))
    assert secrets.find(more, store=store).count() == 3 and len(looked) == len(secrets.RULES)
    looked.clear()
    assert secrets.find(more, store=store).count() == 3 and not looked


def test_sha_of_hollow_text(spark):
    df = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert {r["kept_sha256"] for r in substrings.dedup(df).collect()} == {hashlib.sha256(b"").hexdigest()}
