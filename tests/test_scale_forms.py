"""The forms that have to hold at scale: lists with an early stop and a mask, block-index
neighbours, the fit's own equations, cold splits, resumable tuning, and the plans of joins,
filters and stored splits.  Results against brute force, plans against what they must show."""

from __future__ import annotations

import threading

import numpy as np
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from ludeme.operators import fit_check, neighbours, recommend, split, topn, toplists, tune
from ludeme.operators.als import (EXPLICIT_PARAMS, LOG_PARAMS, ALSParams, cold_start_report, fit_als,
                                  sized)
from ludeme.operators.indexing import fit_indexes
from ludeme.operators.joins import hot_keys, lookup_join
from ludeme.operators.ratings import build_ratings
from ludeme.plans.pipelines import prepare, run_variant
from ludeme.sources.interactions import events_log

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def prep(spark):
    return prepare(events_log(spark, SF), "log")


@pytest.fixture(scope="module")
def model(prep):
    return fit_als(prep.train, LOG_PARAMS, rows=prep.rows)


# ------------------------------------------------------------------ top-N

def factor_table(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows],
                                 "id int, features array<float>").repartition(3)


def brute_lists(users, items, n, seen=frozenset()):
    out = {}
    for u, x in users:
        s = [(-float(np.float32(np.dot(np.float64(np.float32(x)), np.float64(np.float32(v))))), i)
             for i, v in items if (u, i) not in seen]
        out[u] = [(i, -s) for s, i in sorted(s)[:n]]
    return out


def lists_of(df):
    return {r["id"]: list(zip(r["items"], r["scores"], strict=True)) for r in df.collect()}


@pytest.mark.parametrize("b", [topn.Blocks(), topn.Blocks(items=7, users=5, chunk_bytes=8 * 4 * 20)])
@pytest.mark.parametrize("n", [1, 4, 500])
def test_lists_match_brute_force(spark, b, n):
    rng = np.random.default_rng(2)
    users = [(u, rng.normal(size=4)) for u in range(40)] + [(40, np.zeros(4))]
    items = [(100 + i, rng.normal(size=4) * rng.exponential()) for i in range(90)]
    items += [(300 + i, items[3][1]) for i in range(12)] + [(50, np.zeros(4)), (400, -items[3][1])]
    pairs = {(int(u), int(i)) for u in range(30) for i, _ in items if rng.random() < u / 40}
    seen = spark.createDataFrame(sorted(pairs) * 2, "user_id int, game_id int")
    got = topn.top_n(factor_table(spark, users), factor_table(spark, items), n, blocks=b)
    assert lists_of(got) == brute_lists(users, items, n)
    got = topn.top_n(factor_table(spark, users), factor_table(spark, items), n, seen, blocks=b)
    assert lists_of(got) == brute_lists(users, items, n, pairs)


def test_lists_of_empty_tables(spark):
    none = spark.createDataFrame([], "id int, features array<float>")
    some = factor_table(spark, [(1, [1.0, 2.0])])
    assert topn.top_n(none, some, 3).count() == 0
    assert [r["items"] for r in topn.top_n(some, none, 3).collect()] == [[]]
    assert topn.as_recommendations(topn.top_n(some, none, 3)).count() == 0


def test_lists_stop_early(spark):
    """With falling norms most items are never scored, whatever the chunks."""
    rng = np.random.default_rng(4)
    items = [(i, np.abs(rng.normal(size=6)) / (1 + i / 20)) for i in range(2000)]
    users = [(u, np.abs(rng.normal(size=6))) for u in range(50)]
    for b in (topn.Blocks(items=64), topn.Blocks(items=64, chunk_bytes=8 * 6 * 200)):
        got = topn.top_n(factor_table(spark, users), factor_table(spark, items), 5, blocks=b)
        assert lists_of(got) == brute_lists(users, items, 5)
        assert got.agg(F.avg("scored")).first()[0] < 0.3 * len(items)


def test_heavy_user_needs_no_longer_list(spark, prep, model):
    """A user who has seen nearly all of the catalogue still gets the rest, in order."""
    items = [r["id"] for r in model.itemFactors.orderBy("id").collect()]
    seen = spark.createDataFrame([(0, i) for i in items[3:]], "user_id int, game_id int")
    out = recommend.recommend_unseen(model, seen, 10).filter("user_id = 0").collect()
    assert sorted(r["game_id"] for r in out) == items[:3]
    assert "Window" not in plan_of(recommend.recommend_unseen(model, seen, 10))


def test_lists_equal_mllib(prep, model):
    own = {r["user_id"]: [x["rating"] for x in r["recommendations"]]
           for r in recommend.recommend_all(model, 10).collect()}
    ml = {r["user_id"]: [x["rating"] for x in r["recommendations"]]
          for r in model.recommendForAllUsers(10).collect()}
    assert own.keys() == ml.keys()
    assert all(own[u] == pytest.approx(ml[u], rel=1e-5) for u in own)


# ------------------------------------------------------------------ neighbours

def unit(v):
    return np.array(v, float) / np.sqrt(np.dot(v, v))


@pytest.mark.parametrize("p", [
    neighbours.IndexParams(), neighbours.IndexParams(block_rows=20, part_rows=15, part_queries=7),
    neighbours.IndexParams(block_rows=10, probes=1, part_rows=9)])
def test_neighbours_match_brute_force(spark, p):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 5)) * 4
    rows = [(i, list(map(float, centres[i % 8] + rng.normal(size=5)))) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]          # one vector, many ids
    odd = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0]), (2002, [0.0] * 5), (2003, [1.0]),
           (None, [1.0] * 5), (2004, [float("nan")] * 5)]
    df = spark.createDataFrame(rows + odd, "id long, v array<double>").repartition(4)
    ask = spark.createDataFrame([(i,) for i in (0, 5, 5, 77, 1003, 2000, 2002, 9999, None)], "id long")
    index = neighbours.build_index(df, "id", "v", p)
    got = {}
    for r in neighbours.neighbours(index, ask, 6, p).collect():
        got.setdefault(r["query"], []).append((r["rank"], r["id"], r["similarity"]))
    assert set(got) == {0, 5, 77, 1003}
    u = {i: unit(v) for i, v in rows}
    for q, found in got.items():
        want = sorted((-round(float(u[q] @ u[i]), 9), i) for i in u if i != q)[:6]
        assert [(k + 1, i) for k, (_, i) in enumerate(want)] == [x[:2] for x in sorted(found)]
        assert [-s for s, _ in want] == pytest.approx([x[2] for x in sorted(found)], abs=2e-9)


def test_neighbours_skip_blocks(spark):
    rng = np.random.default_rng(6)
    centres = np.eye(10) * 20
    rows = [(i, list(map(float, centres[i % 10] + rng.normal(size=10)))) for i in range(1000)]
    p = neighbours.IndexParams(block_rows=50, probes=1)
    index = neighbours.build_index(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", p)
    ask = spark.range(0, 1000, 20)
    r = neighbours.visited_blocks(index, ask, 5, p).agg(F.avg(F.col("visited") / F.col("blocks"))).first()
    assert r[0] < 0.5
    empty = neighbours.build_index(spark.createDataFrame([], "id long, v array<double>"), "id", "v")
    assert neighbours.neighbours(empty, ask).count() == 0


# ------------------------------------------------------------------ the fit

def changed(model, tmp_path, factor):
    """The model with every user's first coordinate changed by a few per cent."""
    path = str(tmp_path / "changed")
    model.write().save(path + "/a")
    spark = model.userFactors.sparkSession
    spark.read.text(path + "/a/metadata").coalesce(1).write.text(path + "/b/metadata")
    f = F.col("features")
    model.userFactors.withColumn("features", F.transform(
        f, lambda x, i: F.when(i == 0, x * factor + 0.01).otherwise(x).cast("float"))) \
        .write.parquet(path + "/b/userFactors")
    model.itemFactors.write.parquet(path + "/b/itemFactors")
    return ALSModel.load(path + "/b")


@pytest.mark.parametrize("params", [LOG_PARAMS, EXPLICIT_PARAMS, EXPLICIT_PARAMS.with_(nonnegative=True),
                                    LOG_PARAMS.with_(nonnegative=False, alpha=3.0)])
def test_fit_solves_its_equations_and_a_changed_one_does_not(prep, params, tmp_path):
    m = fit_als(prep.train, params, rows=prep.rows)
    r = fit_check.fit_report(m, prep.train, params).first()
    assert r["users"] == prep.train.select("user_id").distinct().count()
    assert (r["unsolved"], r["below_zero"]) == (0, 0)
    bad = fit_check.fit_report(changed(m, tmp_path, 1.05), prep.train, params).first()
    assert bad["unsolved"] > 0.9 * bad["users"]
    wrong = fit_check.fit_report(m, prep.train, params.with_(reg_param=params.reg_param * 50)).first()
    assert wrong["unsolved"] > 0


def test_same_model_on_any_number_of_cores_needs_blocks_from_rows():
    assert sized(ALSParams(), 6_000).num_blocks == 1
    assert sized(ALSParams(), 250_001).item_blocks == 3
    assert sized(ALSParams(num_blocks=7), 10).item_blocks == 7


def test_item_blocks_stay_few_and_leave_the_model_as_it_is(prep):
    few = [sized(LOG_PARAMS, n) for n in (360_000, 3_600_000, 21_600_000, 100_000_000)]
    assert [p.num_blocks for p in few] == [4, 36, 216, 1000]
    assert [p.item_blocks for p in few] == [4, 8, 8, 25]
    one, many = (fit_als(prep.train, LOG_PARAMS.with_(num_blocks=4, item_blocks=b)) for b in (1, 4))
    for a, b in ((one.userFactors, many.userFactors), (one.itemFactors, many.itemFactors)):
        a, b = ({r["id"]: r["features"] for r in x.collect()} for x in (a, b))
        assert set(a) == set(b)
        assert all(b[i] == pytest.approx(v, rel=1e-3, abs=1e-4) for i, v in a.items())


# ------------------------------------------------------------------ cold start, splits

def test_cold_split_has_cold_rows(spark):
    p = prepare(events_log(spark, SF), "log", split="entity", weights=(0.2, 0.8))
    r = cold_start_report(run_variant(p, LOG_PARAMS).model, p.test).first()
    assert r["unseen_user"] > 0 and r["unseen_item"] > 0
    assert r["dropped"] + r["scored"] == r["rows"] == p.test.count() and r["dropped"] > 0
    both = p.train.select("user_id").distinct().join(
        p.test.select("user_id").distinct(), "user_id").count()
    assert both < p.users.size


def test_stored_split_prunes(prep):
    for part in (prep.train, prep.test):
        assert "PartitionFilters: [isnotnull(split" in plan_of(part)
    assert prep.train.count() + prep.test.count() == prep.data.count()


def test_row_keys_by_content(spark):
    rows = [(1, "a|b", "play", 1.0)] * 250 + [(1, "a", "b|play", 1.0)] * 3 + [(None, None, None, None)] * 2
    rows += [(1, "a\\", "play", 2.0), (1, "\\N", "play", 2.0)]
    df = spark.createDataFrame(rows, "member_id long, game string, behaviour string, value double")
    out = split.with_row_keys(df, run=100)
    assert out.drop("event_id").exceptAll(df).count() == 0 and out.count() == len(rows)
    assert out.select("event_id").distinct().count() == len(rows)
    again = split.with_row_keys(df.repartition(5), run=7)
    assert out.exceptAll(again).count() == 0
    sides = split.with_split(out, (0.5, 0.5)).filter("game = 'a|b'").groupBy("split").count().collect()
    assert len(sides) == 2 and all(r["count"] > 80 for r in sides)


def test_log_without_ids_is_split_by_row(spark):
    log = events_log(spark, SF).drop("event_id").filter("member_id IS NOT NULL")
    p = prepare(log, "combined")
    assert p.train.count() + p.test.count() == log.count()
    again = prepare(log.repartition(7), "combined")
    assert p.test.drop("user_id", "game_id").exceptAll(again.test.drop("user_id", "game_id")).count() == 0


# ------------------------------------------------------------------ tuning

class Broken(Exception):
    pass


def test_run_resumes_where_it_broke(spark, prep, tmp_path, monkeypatch):
    grid = tune.param_grid(LOG_PARAMS, ranks=(2, 3), regs=(0.01, 0.1), iters=(1, 2))[:6]
    ledger = tune.TrialLedger(spark, str(tmp_path / "ledger"))
    assert ledger.rows().count() == 0
    own = dict(ledger=ledger, run_id="r1", users=prep.users, items=prep.items, rows=prep.rows,
               parallelism=1)
    fits = []

    def fit(train, p, rows=None):
        if len(fits) == 3 and p.max_iter == 2 and not hasattr(fit, "mended"):
            raise Broken
        fits.append(p)
        return fit_als(train, p, rows)
    monkeypatch.setattr(tune, "fit_als", fit)
    with pytest.raises(Broken):
        tune.tune(prep.train, prep.test, grid, **own)
    assert sorted(ledger.finished("r1")) == [0, 1, 2]
    fit.mended = True
    res = tune.tune(prep.train, prep.test, grid, **own)
    assert len(fits) == 6 and res.resumed == [0, 1, 2]
    whole = tune.tune(prep.train, prep.test, grid, rows=prep.rows)
    assert [r["rmse"] for r in res.trials.orderBy("trial").collect()] \
        == pytest.approx([r["rmse"] for r in whole.trials.orderBy("trial").collect()], rel=1e-6)
    b = ledger.bundle("r1", 4)
    assert b.params == res.params[4] and b.model.rank == 3
    assert recommend.titled_recs(b.model, b.items, 3).filter("game IS NULL").count() == 0
    with pytest.raises(ValueError):
        tune.tune(prep.train, prep.test, [g.with_(seed=1) for g in grid], **own)
    with pytest.raises(ValueError):
        tune.tune(prep.test, prep.test, grid, **own)
    tune.tune(prep.train, prep.test, grid[:1], **{**own, "run_id": "r2"})
    assert ledger.rows().filter("run_id = 'r2'").count() == 1


def test_two_fits_run_at_once_however_many_blocks_a_fit_has(prep, monkeypatch):
    both = threading.Barrier(2, timeout=60)

    def fit(train, p, rows=None):
        both.wait()     # breaks if the other fit starts only when this one has ended
        return fit_als(train, p.with_(num_blocks=1, item_blocks=1), rows)
    monkeypatch.setattr(tune, "fit_als", fit)
    grid = tune.param_grid(LOG_PARAMS.with_(num_blocks=1000), ranks=(2, 3), regs=(0.1,), iters=(1,))
    assert tune.tune(prep.train, prep.test, grid, rows=prep.rows).trials.count() == 2


def test_trials_scored_in_one_pass(spark, prep, model):
    other = fit_als(prep.train, LOG_PARAMS.with_(rank=4), rows=prep.rows)
    extra = spark.createDataFrame([(10_000, 0, 1.0), (0, 10_000, 1.0)],
                                  "user_id int, game_id int, rating double")
    test = prep.test.select("user_id", "game_id", "rating").unionByName(extra)
    from ludeme.operators.evaluate import evaluate_rmse
    got = tune.score_trials([model, other], test)
    for (r, n), m in zip(got, (model, other), strict=True):
        want = evaluate_rmse(m.transform(test))
        assert n == want[1] and r == pytest.approx(want[0], rel=1e-6)
    assert tune.score_trials([model], test.limit(0)) == [(None, 0)]
    assert tune.score_trials([], test) == []


# ------------------------------------------------------------------ joins and filters

def test_action_filters_reach_the_scan(spark):
    log = events_log(spark, SF, branches=True)
    view = toplists.register_view(log, "by_action")
    for df, pushed in ((toplists.sql_top_played(spark, view), "In(event_type, [click,view])"),
                       (toplists.sql_top_purchased(spark, view), "EqualTo(event_type,purchase)"),
                       (build_ratings(log, "play"), "In(event_type, [click,view])")):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1 and "Union" not in plan and pushed in plan
    assert log.exceptAll(events_log(spark, SF)).count() == 0
    assert log.count() == events_log(spark, SF).count()


def test_wide_dimension_is_not_broadcast(spark):
    facts = spark.createDataFrame([(i, i % 40) for i in range(400)], "row long, k long")
    wide = spark.createDataFrame([(k, "x" * 4000) for k in range(40)], "k long, title string")
    dims = fit_indexes(wide.select(F.concat("title", F.col("k").cast("string")).alias("t")),
                       [("t", "id")])[0]
    assert dims.bytes > 40 * 4000
    big = lookup_join(facts, wide, "k", dim_bytes=dims.bytes, how="left", broadcast_bytes=100_000)
    assert "_ldm_salt" in plan_of(big)
    small = lookup_join(facts, wide.select("k"), "k", dim_bytes=40 * 64, broadcast_bytes=100_000)
    assert "_ldm_salt" not in plan_of(small) and "BroadcastHashJoin" in plan_of(small)
    assert big.exceptAll(facts.join(wide, "k", "left").select(big.columns)).count() == 0


def test_hot_and_null_keys_are_dealt(spark):
    """An item that most lists hold, and rows without a key, spread over the tasks."""
    rows = [(i, 7 if i % 2 else (None if i % 4 else i % 30)) for i in range(4000)]
    facts = spark.createDataFrame(rows, "row long, k long")
    dim = spark.createDataFrame([(k, f"t{k}") for k in range(25)], "k long, title string")
    assert [r["k"] for r in hot_keys(facts, "k", 8).collect()] == [7]
    out = lookup_join(facts, dim, "k", dim_bytes=1 << 40, how="left", partitions=8)
    plain = facts.join(dim, "k", "left").select(out.columns)
    assert out.exceptAll(plain).count() == 0 and out.count() == 4000
    inner = lookup_join(facts, dim, "k", dim_bytes=1 << 40, partitions=8)
    assert inner.exceptAll(facts.join(dim, "k").select(inner.columns)).count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(facts, dim, "k", dim_bytes=1 << 40, how="left", partitions=8)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 2000
