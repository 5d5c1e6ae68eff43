"""Grid search over ALS parameters, with a ledger that a broken run resumes from.

The train and test inputs are written once by the caller and every trial reads them; fits run on
a small driver thread pool (``parallelism``), each trial scheduled as its own Spark jobs.

All trials are scored in one pass: a table per side holds, for each id, the factors of every
trial, so the test rows meet two tables however many trials there are, and one aggregation gives
all errors.

With a ``TrialLedger`` each fit, as it ends, saves its bundle (model, dictionaries, parameters) to
a fresh folder and then commits one row that names it.  A run that is started again under its id
fits only what has no row; a fit that was cut off leaves no row.
"""

from __future__ import annotations

import itertools
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludeme.functions.metrics import dot
from ludeme.operators.als import ALSParams, fit_als, sized
from ludeme.operators.indexing import IndexModel
from ludeme.plans.session import default_parallelism
from ludeme.sources.schema import ITEM_ID, LEDGER_SCHEMA, RATING, TUNING_RUNS_SCHEMA, USER_ID
from ludeme.sources.sinks import ModelBundle, load_bundle, save_bundle

# The notebook's grid.
GRID_RANKS = (5, 10, 15)
GRID_REGS = (0.001, 0.01, 0.1)
GRID_ITERS = (5,)


def param_grid(base: ALSParams, ranks: Sequence[int] = GRID_RANKS,
               regs: Sequence[float] = GRID_REGS,
               iters: Sequence[int] = GRID_ITERS) -> list[ALSParams]:
    """Rank-major order (rank, then reg, then iterations), as the notebook loops."""
    return [base.with_(rank=r, reg_param=g, max_iter=i)
            for r, g, i in itertools.product(ranks, regs, iters)]


# ------------------------------------------------------------------ ledger

class TrialLedger:
    """Trials of runs under ``path``: ``trials/run_id=R/trial=T`` holds a finished trial's row,
    ``bundles`` what the rows name.  A trial is written to its own folder, so trials that end at
    the same time do not meet."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        """One row per finished trial of all runs."""
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/trials")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def finished(self, run_id: str) -> dict[int, dict]:
        return {r["trial"]: r.asDict() for r in
                self.rows().filter(F.col("run_id") == run_id).collect()}

    def commit(self, run_id: str, trial: int, variant: str, data: str, seconds: float,
               bundle: ModelBundle) -> dict:
        """Saves the bundle, then the row: a bundle that a row names is whole."""
        folder = f"{self.path}/bundles/{run_id}-{trial}-{uuid.uuid4().hex[:8]}"
        save_bundle(bundle, folder)
        p = bundle.params
        row = {"variant": variant, "rank": p.rank, "reg_param": float(p.reg_param),
               "max_iter": p.max_iter, "seed": int(p.seed), "num_blocks": p.num_blocks,
               "item_blocks": p.item_blocks, "data": data, "fit_seconds": seconds, "bundle": folder}
        names = [f for f in LEDGER_SCHEMA if f.name in row]
        self.spark.createDataFrame([tuple(row[f.name] for f in names)], type(LEDGER_SCHEMA)(names)) \
            .coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/trials/run_id={run_id}/trial={trial}")
        return row | {"run_id": run_id, "trial": trial}

    def bundle(self, run_id: str, trial: int) -> ModelBundle:
        return load_bundle(self.spark, self.finished(run_id)[trial]["bundle"])


def fingerprint(train: DataFrame) -> str:
    """Rows of ``train`` and a hash of them in any order: what a run was trained on."""
    h = F.xxhash64(USER_ID, ITEM_ID, RATING)
    r = train.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                  F.sum(F.pmod(h, F.lit(1 << 31))).alias("s")).first()
    return f"{r['n']}:{r['x']}:{r['s']}"


# ------------------------------------------------------------------ scoring

def stacked_factors(factors: Sequence[DataFrame]) -> DataFrame:
    """(id, by_trial: trial -> features) of one side of several models."""
    out = None
    for t, f in enumerate(factors):
        one = f.select("id", F.struct(F.lit(t).alias("trial"), "features").alias("of"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("id").agg(F.map_from_entries(F.collect_list("of")).alias("by_trial"))


def score_trials(models: Sequence[ALSModel], test: DataFrame, label: str = RATING
                 ) -> list[tuple[float | None, int]]:
    """(rmse, rows scored) of every model: one join per side, one aggregation.  Rows with an id
    that a model does not know are not scored by it."""
    if not models:
        return []
    u = stacked_factors([m.userFactors for m in models]).select(
        F.col("id").alias(USER_ID), F.col("by_trial").alias("_u"))
    v = stacked_factors([m.itemFactors for m in models]).select(
        F.col("id").alias(ITEM_ID), F.col("by_trial").alias("_v"))
    x = test.select(USER_ID, ITEM_ID, label).join(u, USER_ID).join(v, ITEM_ID)
    aggs = []
    for t in range(len(models)):
        p = dot(F.try_element_at("_u", F.lit(t)), F.try_element_at("_v", F.lit(t)))
        d = F.col(label).cast("double") - p.cast("float").cast("double")
        aggs += [F.sqrt(F.avg(d * d)).alias(f"rmse{t}"), F.count(d).alias(f"rows{t}")]
    r = x.agg(*aggs).first()
    return [(r[f"rmse{t}"], r[f"rows{t}"]) for t in range(len(models))]


# ------------------------------------------------------------------ grid

@dataclass
class TuningResult:
    trials: DataFrame               # TUNING_RUNS_SCHEMA rows, one per trial
    models: list[ALSModel]
    params: list[ALSParams]
    resumed: list[int] = field(default_factory=list)    # trials that the ledger had

    def best(self) -> tuple[int, ALSParams, ALSModel, float | None]:
        """Lowest RMSE; the earlier trial wins a tie (strict <, as the notebook)."""
        row = best_trial(self.trials).first()
        t = int(row["trial"])
        return t, self.params[t], self.models[t], row["rmse"]


def _same_trial(row: dict, p: ALSParams, variant: str, data: str) -> bool:
    return (row["variant"], row["rank"], row["reg_param"], row["max_iter"], row["seed"],
            row["num_blocks"], row["item_blocks"], row["data"]) == (
        variant, p.rank, float(p.reg_param), p.max_iter, int(p.seed), p.num_blocks,
        p.item_blocks, data)


def tune(train: DataFrame, test: DataFrame, grid: Sequence[ALSParams], variant: str = "log",
         parallelism: int | None = None, rows: int | None = None, label: str = RATING,
         ledger: TrialLedger | None = None, run_id: str | None = None,
         users: IndexModel | None = None, items: IndexModel | None = None,
         runs_table: str | None = None) -> TuningResult:
    """Fit every grid point on ``train``, score all on ``test`` in one job.

    ``rows``: the ratings that block counts are set by (counted if not given).
    ``ledger``: commits each trial with its dictionaries ``users`` and ``items`` under ``run_id``,
    and takes from it what is finished there.
    ``runs_table``: append the scored trials to that Parquet table.
    ``parallelism`` None: as many concurrent fits as the cores hold fits of ``num_blocks`` blocks
    each, and two at least: item half-steps have few blocks, and each half-step ends on the driver,
    so one fit alone leaves cores idle however many user blocks it has.
    """
    rows = train.count() if rows is None else rows
    grid = [sized(p, rows) for p in grid]
    if parallelism is None:
        per_fit = max((p.num_blocks for p in grid), default=1)
        parallelism = min(len(grid), max(2, default_parallelism(train.sparkSession) // per_fit))
    done: dict[int, dict] = {}
    data = ""
    if ledger is not None:
        if run_id is None or users is None or items is None:
            raise ValueError("a ledger needs a run id and the dictionaries of the bundles")
        data = fingerprint(train)
        done = {t: r for t, r in ledger.finished(run_id).items() if t < len(grid)}
        for t, r in done.items():
            if not _same_trial(r, grid[t], variant, data):
                raise ValueError(f"trial {t} of run {run_id} has other parameters or data")

    def trial(t: int) -> ALSModel:
        if t in done:
            return load_bundle(train.sparkSession, done[t]["bundle"]).model
        start = time.monotonic()
        model = fit_als(train, grid[t])
        if ledger is not None:
            ledger.commit(run_id, t, variant, data, time.monotonic() - start,
                          ModelBundle(model, users, items, grid[t]))
        return model

    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            models = list(pool.map(trial, range(len(grid))))
    else:
        models = [trial(t) for t in range(len(grid))]
    out = [(variant, t, p.rank, float(p.reg_param), p.max_iter, int(p.seed),
            None if r is None else float(r), int(n))
           for t, (p, (r, n)) in enumerate(zip(grid, score_trials(models, test, label), strict=True))]
    trials = train.sparkSession.createDataFrame(out, TUNING_RUNS_SCHEMA)
    if runs_table:
        append_trials(trials, runs_table)
    return TuningResult(trials, models, grid, sorted(done))


def best_trial(trials: DataFrame) -> DataFrame:
    """The one best trial row: lowest rmse, then lowest trial number (NULLs last)."""
    return trials.orderBy(F.asc_nulls_last("rmse"), F.asc("trial")).limit(1)


def append_trials(trials: DataFrame, path: str) -> None:
    """Log trials to the ``tuning_runs`` Parquet table (append-only)."""
    trials.write.mode("append").parquet(path)
