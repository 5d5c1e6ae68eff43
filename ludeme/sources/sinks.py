"""Sinks: the fitted model bundle (ALS model + the dictionaries it was trained
with + its parameters) and the append-only trial table."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import SparkSession

from ludeme.operators.als import ALSParams
from ludeme.operators.indexing import IndexModel


@dataclass
class ModelBundle:
    model: ALSModel
    users: IndexModel
    items: IndexModel
    params: ALSParams


def save_bundle(bundle: ModelBundle, path: str) -> None:
    """Writes to a folder that must not hold a bundle yet; ``meta`` is written last, so a
    bundle that can be loaded is whole."""
    spark = bundle.model.userFactors.sparkSession
    path = path.rstrip("/")
    bundle.model.write().save(f"{path}/model")
    bundle.users.dictionary.write.parquet(f"{path}/users")
    bundle.items.dictionary.write.parquet(f"{path}/items")
    meta = {
        "params": bundle.params.as_dict(),
        "users": [bundle.users.input_col, bundle.users.output_col, bundle.users.size,
                  bundle.users.rows, bundle.users.nulls, bundle.users.bytes],
        "items": [bundle.items.input_col, bundle.items.output_col, bundle.items.size,
                  bundle.items.rows, bundle.items.nulls, bundle.items.bytes],
    }
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.json(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str) -> ModelBundle:
    path = path.rstrip("/")
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    model = ALSModel.load(f"{path}/model")

    def idx(name: str) -> IndexModel:
        ic, oc, size, rows, nulls, bytes_ = meta[name]
        return IndexModel(ic, oc, spark.read.parquet(f"{path}/{name}"), size, rows, nulls, bytes_)

    return ModelBundle(model, idx("users"), idx("items"), ALSParams(**meta["params"]))

