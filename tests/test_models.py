"""Model invariants: ALS scores, top-N lists, metrics, persistence."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludeme.operators import evaluate, recommend
from ludeme.operators.als import ALSParams, cold_start_report, factor_tables, fit_als, sized
from ludeme.operators.indexing import fit_indexes
from ludeme.operators.joins import lookup_join
from ludeme.operators.split import hash_split, with_split
from ludeme.operators.tune import TrialLedger, best_trial, param_grid, tune
from ludeme.plans.pipelines import prepare
from ludeme.sources.sinks import ModelBundle, load_bundle, save_bundle

PARAMS = ALSParams(rank=4, reg_param=0.01, max_iter=5, seed=7, num_blocks=2)


def _two_groups(spark, n_users=20, n_items=15, seed=3):
    """Two disjoint groups: users of group g act only on items of group g."""
    rnd = random.Random(seed)
    rows, eid = [], 0
    for g in range(2):
        for u in range(n_users):
            member = g * 1000 + u
            for i in rnd.sample(range(n_items), 9):
                item = f"g{g}-item{i:02d}"
                rows.append((eid, member, item, "purchase", 1.0)); eid += 1
                rows.append((eid, member, item, "play", float(rnd.randint(1, 50)))); eid += 1
    return spark.createDataFrame(
        rows, "event_id long, member_id long, game string, behaviour string, value double")


@pytest.fixture(scope="module")
def planted(spark):
    log = _two_groups(spark)
    prep = prepare(log, "log", by="pair")
    model = fit_als(prep.train, PARAMS, rows=prep.rows)
    return log, prep, model


def test_prediction_is_factor_dot_product(planted):
    _, prep, model = planted
    pred = model.transform(prep.test).collect()
    uf = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    assert pred
    for r in pred:
        assert r["prediction"] == pytest.approx(float(uf[r["user_id"]] @ itf[r["game_id"]]),
                                                abs=1e-5)
    assert min(min(v) for v in uf.values()) >= 0 and min(min(v) for v in itf.values()) >= 0


def test_topn_lists_match_brute_force(planted):
    _, prep, model = planted
    n = 5
    recs = recommend.flatten(recommend.recommend_all(model, n)).collect()
    uf = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    by_user = {}
    for r in recs:
        by_user.setdefault(r["user_id"], []).append((r["rank"], r["game_id"], r["score"]))
    ids = sorted(itf)
    mat = np.stack([itf[i] for i in ids])
    for u, lst in by_user.items():
        lst.sort()
        assert len(lst) <= n and len({x[1] for x in lst}) == len(lst)
        scores = [x[2] for x in lst]
        assert scores == sorted(scores, reverse=True)
        brute = np.sort(mat @ uf[u])[::-1][:n]
        assert np.allclose(scores, brute, atol=1e-4)


def test_topn_stays_in_group(planted):
    _, prep, model = planted
    titled = recommend.titled_recs(model, prep.items, 5)
    users = prep.users.dictionary.select("member_id", "user_id")
    rows = titled.join(users, "user_id").collect()
    inside = sum((r["member_id"] // 1000) == int(r["game"][1]) for r in rows)
    assert inside / len(rows) > 0.95


def test_als_beats_popularity_on_precision(planted):
    _, prep, model = planted
    rel = evaluate.relevant_pairs(prep.test)
    unseen = recommend.recommend_unseen(model, prep.train, 5)
    als = evaluate.ranking_metrics(unseen, rel, 5).first()
    pop = evaluate.popularity_metrics(prep.train, rel, 5).first()
    assert als["precision_at_k"] > pop["precision_at_k"]


def test_ranking_metrics_match_mllib(spark, planted):
    from pyspark.ml.evaluation import RankingEvaluator
    _, prep, model = planted
    k = 5
    ranked = recommend.flatten(recommend.recommend_all(model, k))
    rel = evaluate.relevant_pairs(prep.test)
    mine = evaluate.ranking_metrics(ranked, rel, k).first()
    pred = ranked.groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "game_id"))),
                    lambda s: s["game_id"].cast("double")).alias("prediction"))
    truth = rel.groupBy("user_id").agg(
        F.collect_list(F.col("game_id").cast("double")).alias("label"))
    df = truth.join(pred, "user_id", "left").withColumn(
        "prediction", F.coalesce("prediction", F.array().cast("array<double>")))
    p = RankingEvaluator(metricName="precisionAtK", k=k).evaluate(df)
    m = RankingEvaluator(metricName="meanAveragePrecisionAtK", k=k).evaluate(df)
    assert mine["precision_at_k"] == pytest.approx(p, abs=1e-9)
    assert mine["map_at_k"] == pytest.approx(m, abs=1e-9)


def test_unseen_excludes_training_items(planted):
    _, prep, model = planted
    recs = recommend.recommend_unseen(model, prep.train, 3)
    seen = prep.train.select("user_id", "game_id").distinct()
    assert recs.join(seen, ["user_id", "game_id"]).count() == 0
    per_user = recs.groupBy("user_id").count().collect()
    assert all(r["count"] <= 3 for r in per_user)


def test_unseen_matches_brute_force(planted):
    _, prep, model = planted
    n = 4
    got = {}
    for r in recommend.recommend_unseen(model, prep.train, n).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["game_id"]))
    uf = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    seen = {}
    for r in prep.train.select("user_id", "game_id").collect():
        seen.setdefault(r["user_id"], set()).add(r["game_id"])
    for u, vec in uf.items():
        cand = sorted(((-float(vec @ f), i) for i, f in itf.items() if i not in seen.get(u, ())))
        want = [i for _, i in cand[:n]]
        mine = [i for _, i in sorted(got.get(u, []))]
        scores = {i: float(vec @ itf[i]) for i in set(want) | set(mine)}
        # same scores (ties may order differently)
        assert np.allclose(sorted(scores[i] for i in mine), sorted(scores[i] for i in want),
                           atol=1e-4)


def test_three_way_split(planted):
    log, _, _ = planted
    p3 = prepare(log, "log", weights=(0.6, 0.2, 0.2), by="pair")
    n = p3.train.count() + p3.validation.count() + p3.test.count()
    assert n == log.count() and p3.validation.count() > 0


def test_rmse_formula_matches_evaluator(planted):
    from pyspark.ml.evaluation import RegressionEvaluator
    _, prep, model = planted
    pred = model.transform(prep.test)
    r, n = evaluate.evaluate_rmse(pred)
    ev = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    assert r == pytest.approx(ev.evaluate(pred), rel=1e-9)
    assert n == pred.count()


def test_iterations_axis_in_grid():
    grid = param_grid(PARAMS, ranks=(5,), regs=(0.1,), iters=(5, 10))
    assert [g.max_iter for g in grid] == [5, 10]


def test_rmse_on_empty_is_null(planted):
    _, prep, model = planted
    r, n = evaluate.evaluate_rmse(model.transform(prep.test.limit(0)))
    assert r is None and n == 0


def test_refit_same_seed_same_scores(planted):
    _, prep, model = planted
    again = fit_als(prep.train, PARAMS, rows=prep.rows)
    a = {(r["user_id"], r["game_id"]): r["prediction"] for r in model.transform(prep.test).collect()}
    b = {(r["user_id"], r["game_id"]): r["prediction"] for r in again.transform(prep.test).collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-5


def test_bundle_round_trip(spark, planted, tmp_path):
    _, prep, model = planted
    path = str(tmp_path / "bundle")
    save_bundle(ModelBundle(model, prep.users, prep.items, PARAMS), path)
    back = load_bundle(spark, path)
    a = sorted(model.transform(prep.test).select("prediction").toPandas()["prediction"])
    b = sorted(back.model.transform(prep.test).select("prediction").toPandas()["prediction"])
    assert np.allclose(a, b)
    assert back.items.size == prep.items.size and back.params == PARAMS


def test_cold_start_report(spark, planted):
    _, prep, model = planted
    extra = spark.createDataFrame([(10_000, 0, 1.0), (0, 10_000, 1.0)],
                                  "user_id int, game_id int, rating double")
    rows = prep.test.select("user_id", "game_id", "rating").unionByName(extra)
    r = cold_start_report(model, rows).first()
    assert r["dropped"] == 2 and r["unseen_user"] == 1 and r["unseen_item"] == 1
    assert r["scored"] == model.transform(rows).count()


def test_factor_tables(planted):
    _, prep, model = planted
    f = factor_tables(model)
    sides = {r["side"]: r["count"] for r in f.groupBy("side").count().collect()}
    assert sides["user"] == model.userFactors.count()
    assert all(len(r["features"]) == PARAMS.rank for r in f.collect())


def test_tuning_grid_and_best(spark, planted, tmp_path):
    _, prep, _ = planted
    grid = param_grid(PARAMS, ranks=(2, 4), regs=(0.01, 0.1))
    ledger = TrialLedger(spark, str(tmp_path / "ledger"))
    res = tune(prep.train, prep.test, grid, parallelism=2, rows=prep.rows, ledger=ledger,
               run_id="r", users=prep.users, items=prep.items, runs_table=str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 4
    assert ledger.bundle("r", 3).model.rank == 4
    trials = res.trials.orderBy("trial").collect()
    assert [(r["rank"], r["reg_param"]) for r in trials] == [(2, 0.01), (2, 0.1), (4, 0.01),
                                                              (4, 0.1)]
    best = best_trial(res.trials).first()
    assert best["rmse"] == min(r["rmse"] for r in trials)
    t, p, _m, r = res.best()
    assert t == best["trial"] and p == sized(grid[t], prep.rows)


def test_hash_split_is_layout_independent(spark, planted):
    log, _, _ = planted
    a = with_split(log).select("event_id", "split")
    b = with_split(log.repartition(7)).select("event_id", "split")
    assert a.exceptAll(b).count() == 0
    by_pair = with_split(log, by="pair").groupBy("member_id", "game").agg(
        F.countDistinct("split").alias("k"))
    assert by_pair.filter("k > 1").count() == 0
    tr, te = hash_split(log)
    assert tr.count() + te.count() == log.count()


def test_salted_lookup_equals_broadcast(spark):
    # one hot key holds a third of the rows
    rows = [(i, 0 if i % 3 == 0 else i % 50) for i in range(3000)]
    facts = spark.createDataFrame(rows, "row long, k long")
    dims = fit_indexes(facts, [("k", "k_id")])[0]
    dim = dims.dictionary
    b = lookup_join(facts, dim, "k", dim_bytes=dims.bytes, how="left")
    s = lookup_join(facts, dim, "k", dim_bytes=dims.bytes, how="left", broadcast_bytes=0,
                    partitions=8)
    assert b.select("row", "k", "k_id").exceptAll(s.select("row", "k", "k_id")).count() == 0
    assert s.count() == 3000
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # only the bounded hot-key list is broadcast


def test_content_scores_with_dictionaries(spark, planted):
    """The size-checked / salted path gives the same scores as plain joins,
    also when member ids and dense ids do not coincide."""
    from ludeme.operators import hybrid
    _, prep, _ = planted
    items = prep.items.dictionary.select("game").collect()
    vecs = spark.createDataFrame(
        [(r["game"], [float(len(r["game"]) % 3), float(int(r["game"][-2:])), 1.0])
         for r in items], "game string, vector array<double>")
    pairs = prep.test.select("user_id", "game")
    plain = hybrid.content_scores(pairs, hybrid.user_profiles(prep.train, vecs), vecs)
    prof = hybrid.user_profiles(prep.train, vecs, items=prep.items)
    checked = hybrid.content_scores(pairs, prof, vecs, users=prep.users, items=prep.items)
    a = {(r["user_id"], r["game"]): r["content_score"] for r in plain.collect()}
    b = {(r["user_id"], r["game"]): r["content_score"] for r in checked.collect()}
    assert a.keys() == b.keys() and all(v is not None for v in b.values())
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_hybrid_scores_every_item(spark, planted):
    """Equal to blending all items, with an item without a vector."""
    from ludeme.operators import hybrid
    _, prep, model = planted
    rnd = np.random.default_rng(5)
    titles = {r["game_id"]: r["game"] for r in prep.items.dictionary.collect()}
    vec = {t: rnd.normal(size=3).tolist() for i, t in sorted(titles.items()) if i != 2}
    vectors = spark.createDataFrame(list(vec.items()), "game string, vector array<double>")
    prof = {r["user_id"]: np.array(r["profile"])
            for r in hybrid.user_profiles(prep.train, vectors).collect()}
    uf = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    got = {}
    for r in hybrid.hybrid_recs(model, prep.items, prep.train, vectors, n=6, weight=0.2,
                                users=prep.users).orderBy("user_id", "hybrid_rank").collect():
        got.setdefault(r["user_id"], []).append(r["hybrid_score"])

    def cos(u, i):
        if u not in prof or titles[i] not in vec:
            return 0.0
        a, b = prof[u], np.array(vec[titles[i]])
        return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
    assert set(got) == set(uf)
    for u, scores in got.items():
        brute = sorted((0.2 * float(uf[u] @ itf[i]) + 0.8 * cos(u, i) for i in itf),
                       reverse=True)[:6]
        assert scores == pytest.approx(brute, abs=1e-5)


def test_lineitem_row_key_is_unique(spark):
    from ludeme.sources.interactions import lineitem_log
    rows = lineitem_log(spark, "/root/testdata/sf0.01")
    assert rows.count() == rows.select("event_id").distinct().count()


def test_lineitem_log_deals_more_lines_to_more_tasks(spark, tmp_path, monkeypatch):
    from ludeme.sources import interactions
    lines = [(i // 4 if i % 10 else None, i % 7, 1 + i % 2, float(i % 3)) for i in range(400)]
    orders = [(k, 1000 + k % 9) for k in range(90)] + [(5, 77), (None, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(
        str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(interactions, "LINE_ROWS", 10, raising=False)
    rows = interactions.lineitem_log(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() >= 40
    got = sorted(rows.select("event_id", "member_id", "game", "value").collect())
    joined = sorted((*x, c) for x in lines for k, c in orders if x[0] is not None and x[0] == k)
    want, n = [], {}
    for k, p, line, q, c in joined:
        n[k, p, line, q] = i = n.get((k, p, line, q), 0) + 1
        want.append((f"{k}-{line}-{p}-{q}-{i}", c, f"part-{p}", q))
    assert [tuple(r) for r in got] == sorted(want)
