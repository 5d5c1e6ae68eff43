"""A corpus pipeline: quality rules, near copies, secrets, mixing, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``:

quality   documents that the web policy rejects go
jaccard   one document of each group of near copies stays (the smallest id)
secrets   found secrets are replaced by a mark in the text
mix       rows as the mix takes them: one for each pass over a document and one
          for each cut piece of it; documents it takes nothing of go
pack      the packed pieces (doc_id, piece, start, length, ids_crc32,
          sequence_id, offset)

Null texts fail the quality rules; empty tables pass through all stages; further
columns of ``documents`` are carried to the last stage.  SQL has no tokenizer,
so ``ORACLE_SQL`` is None; the tests hold run() against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ludeme.llm import jaccard_join, mixing, packing, quality, secrets
from ludeme.plans.session import materialize, scratch_path

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.WEB)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    store = spark.conf.get(secrets.STORE, None) or scratch_path(spark, "secrets")
    return secrets.redact(docs, materialize(secrets.find(docs, store=store), "findings"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_texts(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mix_stage),
    ("best-fit packing", pack_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
