"""The 10-row fixture of FIXTURES.md with its expected answers."""
import math

import pytest
from pyspark.sql import functions as F

from ludeme.operators import profile, ratings, toplists
from ludeme.operators.indexing import fit_index, index_ratings


def test_csv_scan_keeps_quoted_commas(log10):
    rows = log10.collect()
    assert len(rows) == 10
    assert rows[2]["game"] == "Beta, Deluxe"
    assert log10.schema["member_id"].dataType.simpleString() == "bigint"
    assert log10.schema["value"].dataType.simpleString() == "double"


def test_profile(log10):
    r = profile.dataset_profile(log10).first()
    assert (r["rows"], r["users"], r["items"]) == (10, 4, 4)
    approx = profile.dataset_profile(log10, exact=False).first()
    assert (approx["users"], approx["items"]) == (4, 4)
    counts = {x["behaviour"]: x["count"] for x in profile.behaviour_counts(log10).collect()}
    assert counts == {"purchase": 6, "play": 4}
    nulls = profile.null_audit(log10).first().asDict()
    assert nulls == {"member_id_nulls": 0, "game_nulls": 0, "behaviour_nulls": 0,
                     "value_nulls": 0}


def test_null_audit_empty_is_zero(spark, log10):
    empty = log10.limit(0)
    assert set(profile.null_audit(empty).first().asDict().values()) == {0}


def test_top_lists(spark, log10):
    view = toplists.register_view(log10, "fixture_log")
    played = [(r["game"], r["total_playtime"]) for r in
              toplists.sql_top_played(spark, view).collect()]
    assert played == [("Gamma", 7.0), ("Alpha", 3.5), ("Beta, Deluxe", 2.0)]
    bought = [(r["game"], r["total_purchased"]) for r in
              toplists.sql_top_purchased(spark, view).collect()]
    assert bought == [("Alpha", 2.0), ("Beta, Deluxe", 2.0), ("Delta", 1.0), ("Gamma", 1.0)]
    df_form = [(r["game"], r["total_playtime"]) for r in
               toplists.top_items_by_sum(log10, "play", "total_playtime").collect()]
    assert df_form == played


def test_playtime_stats(log10):
    r = profile.playtime_stats(log10).first()
    assert r["count"] == 4 and r["mean"] == pytest.approx(3.125)
    assert r["stddev"] == pytest.approx(2.780137886268713, rel=1e-12)
    assert (r["min"], r["max"]) == (0.5, 7.0)


def test_index_order(log10):
    users = fit_index(log10, "member_id", "user_id")
    got = {r["member_id"]: r["user_id"] for r in users.dictionary.collect()}
    assert got == {1: 0, 10: 1, 2: 2, 9: 3}
    games = fit_index(log10, "game", "game_id")
    assert {r["game"]: r["game_id"] for r in games.dictionary.collect()} == {
        "Alpha": 0, "Beta, Deluxe": 1, "Gamma": 2, "Delta": 3}
    plays = ratings.ratings_play(log10)
    pg = fit_index(plays, "game", "game_id")
    assert {r["game"]: r["game_id"] for r in pg.dictionary.collect()} == {
        "Alpha": 0, "Beta, Deluxe": 1, "Gamma": 2}
    assert (users.size, users.rows, users.nulls) == (4, 10, 0)


def test_index_matches_stringindexer(log10):
    from pyspark.ml.feature import StringIndexer
    ir = index_ratings(ratings.ratings_combined(log10))
    si = StringIndexer(inputCol="member_id", outputCol="u").fit(log10)
    gi = StringIndexer(inputCol="game", outputCol="g").fit(log10)
    ref = gi.transform(si.transform(log10)).select("member_id", "game", "u", "g").collect()
    mine = ir.df.select("member_id", "game", "user_id", "game_id").collect()
    key = lambda r: (r[0], r[1])
    assert sorted((r[0], r[1], int(r[2]), int(r[3])) for r in ref) == \
        sorted((r[0], r[1], r[2], r[3]) for r in mine)


def test_rating_rules(log10):
    comb = [r["rating"] for r in ratings.ratings_combined(log10).collect()]
    assert comb == [1, 3, 1, 1, 0.5, 1, 1, 7, 2, 1]
    lg = [r["rating"] for r in ratings.ratings_log(log10).collect()]
    exp = [1, 1.386294, 1, 1, 0.405465, 1, 1, 2.079442, 1.098612, 1]
    assert [round(x, 6) for x in lg] == exp
    play = ratings.ratings_play(log10).collect()
    assert [r["rating"] for r in play] == [3.0, 0.5, 7.0, 2.0]


def test_rule_report(log10):
    rep = {r["behaviour"]: (r["rows"], r["unmapped"], r["null_ratings"]) for r in
           ratings.rule_report(log10, "log").collect()}
    assert rep == {"purchase": (6, 0, 0), "play": (4, 4, 0)}


def test_pair_aggregation(log10):
    pairs = ratings.build_ratings(log10, "combined", pair_agg="sum")
    got = {(r["member_id"], r["game"]): r["rating"] for r in pairs.collect()}
    assert got[(1, "Alpha")] == 4.0 and len(got) == 7


def test_preview_is_ordered(log10):
    rows = profile.preview(log10, 3, ["member_id", "game", "behaviour"]).collect()
    assert [(r["member_id"], r["game"], r["behaviour"]) for r in rows] == [
        (1, "Alpha", "play"), (1, "Alpha", "purchase"), (1, "Beta, Deluxe", "purchase")]


def test_clean_drops_null_rows(spark):
    df = spark.createDataFrame(
        [(1, "A", "play", 1.0), (None, "A", "play", 1.0), (2, None, "purchase", 1.0),
         (3, "B", None, 2.0)], "member_id long, game string, behaviour string, value double")
    assert profile.clean_interactions(df).count() == 1


def test_schema_report(log10):
    rows = profile.schema_report(log10).collect()
    assert [(r["column"], r["type"]) for r in rows] == [
        ("member_id", "bigint"), ("game", "string"), ("behaviour", "string"),
        ("value", "double")]


def test_log_rating_edge_values(spark):
    df = spark.createDataFrame(
        [(1, "A", "play", 0.0), (1, "B", "play", -1.0), (1, "C", "play", -2.0),
         (1, "D", None, 3.0), (1, "E", "unknown", 1.0)],
        "member_id long, game string, behaviour string, value double")
    got = {r["game"]: r["rating"] for r in ratings.ratings_log(df).collect()}
    assert got["A"] == 0.0 and got["B"] is None and got["C"] is None
    assert got["D"] == pytest.approx(math.log1p(3.0)) and got["E"] == pytest.approx(math.log(2))
    rep = {r["behaviour"]: r["unmapped"] for r in ratings.rule_report(df, "log").collect()}
    assert rep[None] == 1 and rep["unknown"] == 1


def test_index_null_handling(spark):
    df = spark.createDataFrame([(1, "A"), (None, "A"), (2, "B")], "member_id long, game string")
    with pytest.raises(ValueError):
        fit_index(df, "member_id", "user_id")
    m = fit_index(df, "member_id", "user_id", handle_invalid="skip")
    assert m.size == 2 and m.nulls == 1
    assert m.transform(df, "skip").count() == 2
    kept = {r["member_id"]: r["user_id"] for r in m.transform(df, "keep").collect()}
    assert kept[None] == 2
    with pytest.raises(Exception):
        m.transform(df, "error").collect()
    _ = F  # keep import used


def test_empty_input_every_operator(spark, log10):
    from ludeme.operators import split
    from ludeme.operators.indexing import fit_indexes
    empty = log10.limit(0)
    r = profile.dataset_profile(empty).first()
    assert (r["rows"], r["users"], r["items"]) == (0, 0, 0)
    assert profile.behaviour_counts(empty).count() == 0
    assert profile.playtime_stats(empty).first()["count"] == 0
    view = toplists.register_view(empty, "empty_log")
    assert toplists.sql_top_played(spark, view).count() == 0
    for rule in ("play", "combined", "log"):
        assert ratings.build_ratings(empty, rule).count() == 0
    users, items = fit_indexes(empty, [("member_id", "user_id"), ("game", "game_id")])
    assert users.size == 0 and items.size == 0
    assert items.transform(users.transform(empty)).count() == 0
    assert sum(d.count() for d in split.hash_split(empty)) == 0


def test_index_offsets_across_many_partitions(spark):
    """Many labels with heavy ties, sorted output spread over many partitions
    (AQE off, so nothing is coalesced): ids must equal StringIndexer's."""
    import random as _r
    from pyspark.ml.feature import StringIndexer
    from ludeme.operators.indexing import fit_indexes
    rnd = _r.Random(11)
    rows = [(rnd.randint(0, 700), f"t{rnd.randint(0, 400)}") for _ in range(6000)]
    df = spark.createDataFrame(rows, "member_id long, game string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                          "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        users, items = fit_indexes(df, [("member_id", "user_id"), ("game", "game_id")])
        mine_u = {r["member_id"]: r["user_id"] for r in users.dictionary.collect()}
        mine_g = {r["game"]: r["game_id"] for r in items.dictionary.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    su = StringIndexer(inputCol="member_id", outputCol="u").fit(df)
    sg = StringIndexer(inputCol="game", outputCol="g").fit(df)
    assert mine_u == {int(lbl): i for i, lbl in enumerate(su.labels)}
    assert mine_g == {lbl: i for i, lbl in enumerate(sg.labels)}
    assert sorted(mine_u.values()) == list(range(users.size))
