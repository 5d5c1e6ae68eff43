"""Quality rules as a bitmask ledger (native).

Every rule is evaluated once per document.  The ledger keeps the measurements
and one integer, ``fail_bits``, with bit i set if rule i fails.  A policy is a
named, versioned set of rules; applying it is one bitwise AND, so a changed
policy never reads the texts again, and an ablation is an aggregation over the
few distinct values of ``fail_bits``.

Defined cases: a null or empty text has no words and fails ``few_words``;
repeated rows are measured one by one; an empty table gives an empty ledger;
columns other than the id and the text are ignored (the ledger has the id,
the measurements and the bits only); a null id stays null.
Rules hold no state across rows: the job is one scan without any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludeme.llm.text import quoted, squeezed, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rule name and the condition under which a document fails; the position is
#: the bit.  Append only: a stored ledger keeps its meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("shouting", "100 * n_shouts > 50 * n_words"),
    ("upper_case", "100 * n_upper > 70 * word_chars"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        at = {name: i for i, (name, _) in enumerate(RULES)}
        return sum(1 << at[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
WEB = Policy("web", 1, ("few_words", "repeated_windows", "symbols", "duplicate_lines",
                        "word_length", "shouting", "upper_case"))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_shouts", "n_upper")


def _without(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _covered(hits: Column) -> Column:
    """Words covered by windows that start at the sorted positions ``hits``."""
    steps = F.transform(hits, lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(hits, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the id and the columns of ``MEASURES``."""
    d = df.select(quoted(id_col), F.coalesce(quoted(text_col), F.lit("")).alias("_t"))
    d = d.withColumn("_w", words_of(F.col("_t")))
    d = d.withColumn("_lines", F.filter(
        F.split("_t", "\n"), lambda x: F.char_length(squeezed(x)) > 0))
    n = F.size("_w")
    d = d.withColumn("_win", F.transform(
        F.slice("_w", 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(F.col("_w"), i + k) for k in range(1, WINDOW)))))
    # Few texts repeat a window; only those pay for the sort.
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    d = d.withColumn("_pairs", F.when(repeats, F.sort_array(F.transform(
        "_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    hit = F.filter(F.transform("_pairs", lambda x, i: F.when(
        (F.get(F.col("_pairs"), i + 1)["h"] == x["h"])
        | ((i > 0) & (F.get(F.col("_pairs"), i - 1)["h"] == x["h"])), x["i"])),
        lambda p: p.isNotNull())
    d = d.withColumn("_hits", F.when(F.col("_pairs").isNotNull(), F.sort_array(hit)))
    t = F.col("_t")
    # A zero that is no constant to Spark: a later filter on the measurements
    # then stays above this step, where they are computed once, instead of being
    # moved below it with all steps spelled out for every word.
    zero = F.shiftright(F.monotonically_increasing_id(), 63)
    return d.select(
        quoted(id_col),
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(squeezed(t)).cast("long").alias("word_chars"),
        _without(t, SYMBOLS).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        (F.when(F.col("_hits").isNull(), F.lit(0)).otherwise(_covered(F.col("_hits")))
         + zero).cast("long").alias("n_repeat_words"),
        _without(t, "!").cast("long").alias("n_shouts"),
        _without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
    )


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``fail_bits`` of every document."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits + F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0))
    return measure(df, id_col, text_col).withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    """Adds ``name``: whether a document passes all rules of the policy."""
    return led.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablation(led: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, documents that fail it
    alone, and documents kept if the rule is left out."""
    per_bits = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")) \
        .agg(F.count(F.lit(1)).alias("n"))
    at = {name: i for i, (name, _) in enumerate(RULES)}
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << at[r]).cast("long")
                                         .alias("bit")) for r in policy.rules))).alias("r")
    x = per_bits.select("bits", "n", rules)
    bit = F.col("bits").bitwiseAND(F.col("r.bit"))
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(bit != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when((bit != 0) & (rest == 0), F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("kept_without"))


def keep_good(df: DataFrame, policy: Policy = WEB, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text passes the policy.

    The verdict is attached row by row, not by a join, so repeated and null ids
    keep their own verdicts."""
    packed = df.select(F.struct(*map(quoted, df.columns)).alias("_row"),
                       quoted(text_col).alias("_text_"))
    kept = apply_policy(ledger(packed, "_row", "_text_"), policy).filter("kept")
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in df.columns))
