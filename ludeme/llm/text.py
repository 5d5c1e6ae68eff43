"""Words of texts: Spark expressions for native operators, Arrow kernels for the others.

A word is a run of characters other than ``[\\x20\\x09-\\x0D]``.  A null text has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE[1:], " " * 5)
    return F.array_remove(F.split(spaced, " "), "")


def squeezed(text: Column) -> Column:
    """The text without its white space: its length is the code points in words."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def hex_number(digest: Column, digits: int = 8) -> Column:
    """The first hex digits of a digest as a number (the same in any SQL engine)."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


#: Rows of one hot key are dealt to so many parts of a join; what is still large,
#: Spark's skew join splits, as both sides are then plain shuffles of the join.
SALTS = 8


def row_salt(df: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """A part from 0 by a row's own values (so retries agree), without the columns
    ``but`` and those that cannot be hashed."""
    cols = [quoted(f.name) for f in df.schema.fields
            if f.name not in but and "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)) if cols else F.lit(0).cast("long")


def every_salt() -> Column:
    """One copy of a row for each part."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))


# ------------------------------------------------------------------ Arrow side

def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most_bytes`` of text each (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def split_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words, lower-cased (A-Z) unless told not to: per text the start in the
    word list (one more entry than texts), the code of each word, and the
    distinct words by code."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(full)))
    offsets = lists.offsets.to_numpy()
    starts = before[offsets - offsets[0]]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return starts, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def hash_words(words: list[str]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of :func:`mix`."""
    def unshift(x, by):
        y = x
        for _ in range(64 // by):
            y = x ^ (y >> np.uint64(by))
        return y
    h = unshift(h, 31) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    h = unshift(h, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return unshift(h, 30)
