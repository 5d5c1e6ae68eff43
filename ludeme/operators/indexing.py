"""Dense integer ids per distinct label (user, item), fitted and applied at scale.

Id order is the one ``StringIndexer(stringOrderType="frequencyDesc")`` uses:
by count descending, ties by the label *as a string* (so ``'10'`` precedes
``'9'``).  Unlike ``StringIndexer`` the labels never travel to the driver:

1. ``groupBy(label).count()`` -- partial aggregation, so a hot label is combined
   map-side (users and items are counted in the same scan and shuffle);
2. a global sort by (count desc, label) -- range-partitioned, no single task;
3. each row's position inside its sorted partition comes from
   ``monotonically_increasing_id`` (partition index in the upper bits); the
   sorted table is written once so both passes read the same positions;
4. per-partition row counts (one small row per partition) give the offsets,
   broadcast back (bounded by the partition count) to form ``offset + pos``.

The sorted counts are written once to the shared checkpoint folder; the
dictionary (label, id, n) is a deterministic projection of that copy, and its
exact size is known from the fit, so joins against it can check it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludeme.operators.joins import DEFAULT_BROADCAST_BYTES, ROW_BYTES, lookup_join
from ludeme.plans.session import ensure_checkpoint_dir, materialize
from ludeme.sources.schema import ITEM, ITEM_ID, MEMBER, USER_ID

_MID = "_ldm_mid"
_PID = "_ldm_pid"
_LBL = "_ldm_label"
_INT_MAX = 2**31 - 1


@dataclass
class IndexModel:
    input_col: str
    output_col: str
    dictionary: DataFrame      # (input_col, output_col int, n long), from a written table
    size: int                  # distinct non-NULL labels
    rows: int                  # non-NULL rows the counts came from
    nulls: int                 # NULL rows seen while fitting
    bytes: int | None = None   # of the labels and what a row takes beside

    def transform(self, df: DataFrame, handle_invalid: str = "error",
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
        return apply_index(self, df, handle_invalid, broadcast_bytes)

    def labels(self) -> DataFrame:
        """id -> label, ordered by id (the dictionary view of the model)."""
        return self.dictionary.select(self.output_col, self.input_col).orderBy(self.output_col)


def fit_index(df: DataFrame, input_col: str, output_col: str,
              handle_invalid: str = "error") -> IndexModel:
    return fit_indexes(df, [(input_col, output_col)], handle_invalid)[0]


def fit_indexes(df: DataFrame, specs: list[tuple[str, str]],
                handle_invalid: str = "error") -> list[IndexModel]:
    """Fit several dictionaries (e.g. users and items) in ONE scan of ``df``:
    every row is exploded into one (kind, label-as-text) pair per dictionary,
    partially aggregated, shuffled once and sorted once by (kind, NULL last,
    count desc, label)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    types = {c: df.schema[c].dataType for c, _ in specs}
    pairs = F.explode(F.array(*[
        F.struct(F.lit(k).alias("_k"), F.col(c).cast("string").alias(_LBL))
        for k, (c, _) in enumerate(specs)]))
    counts = (df.select(pairs.alias("_p")).select("_p._k", f"_p.{_LBL}")
              .groupBy("_k", _LBL).agg(F.count(F.lit(1)).alias("n")))
    lbl = F.col(_LBL)
    ordered = (counts
               .orderBy(F.asc("_k"), lbl.isNull().asc(), F.desc("n"), lbl.asc())
               .withColumn(_MID, F.monotonically_increasing_id()))
    # positions must be read from ONE materialisation of the sort
    ordered = materialize(ordered, "index")
    pid = F.shiftrightunsigned(F.col(_MID), 33)
    per_part = (ordered.groupBy(pid.alias(_PID), "_k")
                .agg(F.count_if(lbl.isNotNull()).alias("labels"),
                     F.min(F.when(lbl.isNotNull(), F.col(_MID))).alias("first"),
                     F.sum(F.when(lbl.isNotNull(), F.col("n"))).alias("rows"),
                     F.sum(F.when(lbl.isNull(), F.col("n"))).alias("nulls"),
                     F.sum(F.octet_length(lbl)).alias("text"))
                .collect())                 # <= (partitions x kinds) small rows
    per_part.sort(key=lambda r: (r["_k"], r[_PID]))
    offsets, stats = [], {}
    for r in per_part:
        k = int(r["_k"])
        size, rows, nulls, text = stats.get(k, (0, 0, 0, 0))
        if r["first"] is not None:
            # id = labels of this kind in earlier partitions + rank inside this one
            offsets.append((k, int(r[_PID]), size - int(r["first"])))
        stats[k] = (size + int(r["labels"]), rows + int(r["rows"] or 0),
                    nulls + int(r["nulls"] or 0), text + int(r["text"] or 0))
    for k, (c, _) in enumerate(specs):
        size, _rows, nulls, _text = stats.get(k, (0, 0, 0, 0))
        if nulls and handle_invalid == "error":
            raise ValueError(f"{c} has {nulls} NULL rows; use handle_invalid='skip' or 'keep'")
        if size > _INT_MAX:
            raise ValueError(f"{size} distinct {c} values do not fit an int id")
    off_df = spark.createDataFrame(offsets, T.StructType([
        T.StructField("_k", T.IntegerType(), False),
        T.StructField(_PID, T.LongType(), False),
        T.StructField("_off", T.LongType(), False)]))
    ids = (ordered.filter(lbl.isNotNull())
           .withColumn(_PID, pid)
           .join(F.broadcast(off_df), ["_k", _PID])     # bounded by partition count
           .withColumn("_id", (F.col("_off") + F.col(_MID)).cast("int")))
    models = []
    for k, (c, out) in enumerate(specs):
        size, rows, nulls, text = stats.get(k, (0, 0, 0, 0))
        dictionary = (ids.filter(F.col("_k") == k)
                      .select(lbl.cast(types[c]).alias(c), F.col("_id").alias(out), "n"))
        models.append(IndexModel(c, out, dictionary, size, rows, nulls,
                                 text + ROW_BYTES * size))
    return models


def apply_index(model: IndexModel, df: DataFrame, handle_invalid: str = "error",
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Attach ``output_col``.  ``handle_invalid``: ``error`` fails the job on a
    NULL or unseen label (as StringIndexer does), ``skip`` drops such rows,
    ``keep`` gives them id = size."""
    how = "inner" if handle_invalid == "skip" else "left"
    out = lookup_join(df, model.dictionary.select(model.input_col, model.output_col),
                      model.input_col, dim_bytes=model.bytes, how=how,
                      broadcast_bytes=broadcast_bytes)
    idc = F.col(model.output_col)
    if handle_invalid == "keep":
        out = out.withColumn(model.output_col, F.coalesce(idc, F.lit(model.size)))
    elif handle_invalid == "error":
        out = out.withColumn(model.output_col, F.when(idc.isNull(), F.raise_error(
            F.concat(F.lit(f"unseen or NULL label in {model.input_col}: "),
                     F.coalesce(F.col(model.input_col).cast("string"), F.lit("NULL")))
        )).otherwise(idc).cast("int"))
    # keep the caller's column order, id columns appended
    cols = [c for c in df.columns if c != model.output_col] + [model.output_col]
    return out.select(*cols)


@dataclass
class IndexedRatings:
    df: DataFrame
    users: IndexModel
    items: IndexModel


def index_ratings(ratings: DataFrame, user_col: str = MEMBER, item_col: str = ITEM,
                  handle_invalid: str = "error",
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> IndexedRatings:
    """Fit user and item dictionaries on ``ratings`` and attach int ``user_id``,
    ``game_id`` (the indexers are returned so titles can be mapped back with the
    very ids the model was trained on)."""
    users, items = fit_indexes(ratings, [(user_col, USER_ID), (item_col, ITEM_ID)],
                               handle_invalid)
    df = items.transform(users.transform(ratings, handle_invalid, broadcast_bytes),
                         handle_invalid, broadcast_bytes)
    return IndexedRatings(df, users, items)
