"""Secret scans over an incremental blob ledger (native).

Every version of a text is addressed by its content (SHA-256).  A store keeps the
distinct texts by address, a ledger of the (blob, rule version) pairs that were
scanned, and the findings.  A run compares addresses with the store and adds the
texts that are new; it scans the blobs for which some rule version is missing, with
only those rules, and joins the findings back to every path that holds the blob.

Positions come from marking the matches of a rule and cutting the text at the
marks, so a span costs no Python.  The marks are two noncharacters; where a
text holds one itself, it is first replaced by another character that no rule
matches, which moves nothing.

Defined cases: a null text is the empty blob; equal rows share a blob and each
gets its findings; an empty table gives empty results; columns other than those
named are ignored; a null id stays null.  Copies of one text are dealt to several
tasks when findings are joined back, so a text that holds a third of all rows
does not land in one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ludeme.llm.text import every_salt, quoted, row_salt
from ludeme.plans.session import materialize

OPEN, CLOSE, OTHER = "﷐", "﷑", "�"


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = ("(" + "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


#: From the BEGIN line to the END line.  Where the next marker is no END of a private key:
#: to the end of the header and base64 lines that follow, the last of which may be short.
#: Line ends may be written out (\n), and lines may be indented, quoted or joined.
_KEY = r"[A-Z0-9\x20]*PRIVATE\x20KEY(?:\x20BLOCK)?-----"
_GAP = r"""(?:\\[rn]|[\x20\t\r\n"'+,>])"""
PRIVATE_KEY = (
    rf"-----BEGIN\x20{_KEY}(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END\x20{_KEY}"
    rf"|(?:{_GAP}*+(?:(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset):[^\r\n\\]*+"
    r"|[A-Za-z0-9+/]{16,}+={0,2}+|[A-Za-z0-9+/]{1,15}+={1,2}+|=[A-Za-z0-9+/]{4}))*+"
    r"(?:(?<=[A-Za-z0-9+/]{16})(?:\\[rn]|[\r\n])++[\x20\t]*+[A-Za-z0-9+/]{1,15}+"
    r"""(?=[\x20\t]*+(?:[\r\n\\"']|$)))?)""")


@dataclass(frozen=True)
class Rule:
    """``hint``: a text without any of these strings has no match.  ``group``
    and ``least``: the group's length (0: the match's) below which a match is
    dropped.  A changed pattern gets a new version."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base rules come first; the position orders spans of equal start.
BASE_RULES = (
    Rule("assign", 1, ASSIGN, 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 18, ("AKIA",)),
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
)
EXTRA_RULES = (
    Rule("private_key", 2, PRIVATE_KEY, 0, 1, ("PRIVATE KEY",)),
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1,
         ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, ("xox",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", 0, 1, ("eyJ",)),
    Rule("google", 1, "AIza[0-9A-Za-z_-]{35}", 0, 1, ("AIza",)),
)
RULES = BASE_RULES + EXTRA_RULES


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """Adds ``todo``, the rule versions not yet run on a blob, and drops blobs
    without any.  ``ledger``: blob, rule (a rule version's key)."""
    keys = F.array(*(F.lit(r.key) for r in rules))
    if ledger is None:
        return blobs.withColumn("todo", keys)
    done = ledger.groupBy("blob").agg(F.collect_set("rule").alias("_done"))
    x = blobs.join(done, "blob", "left")
    return x.withColumn("todo", F.array_except(keys, F.coalesce("_done", F.array().cast(
        "array<string>")))).drop("_done").filter(F.size("todo") > 0)


def _pieces(text: Column, rule: Rule) -> Column:
    """The text cut at the matches' starts; null where there is no match."""
    marked = F.regexp_replace(text, F.lit(rule.pattern), F.lit(f"{OPEN}$0{CLOSE}"))
    cut = F.split(marked, OPEN)
    return F.when(F.size(cut) > 1, cut)


def _measured(rule: Rule):
    """(length in the text, length of the match, whether it passes) of a piece."""
    def of(piece: Column) -> Column:
        k = F.instr(piece, CLOSE)
        what = F.substring(piece, F.lit(1), F.greatest(k - 1, F.lit(0)))
        if rule.group:
            what = F.regexp_extract(what, rule.pattern, rule.group)
        return F.struct(
            (F.char_length(piece) - F.when(k > 0, 1).otherwise(0)).cast("long").alias("n"),
            F.greatest(k - 1, F.lit(0)).cast("long").alias("m"),
            ((k > 0) & (F.char_length(what) >= rule.least)).alias("ok"))
    return of


def scan(todo: DataFrame, rules=RULES) -> DataFrame:
    """Findings (blob, kind, ord, start, end) of the rule versions in ``todo``
    (columns blob, text, todo); code points, end exclusive."""
    text = F.translate(F.coalesce("text", F.lit("")), OPEN + CLOSE, OTHER * 2)
    x = todo.select("blob", "todo", text.alias("_t"))
    kinds = []
    for i, r in enumerate(rules):
        runs = F.array_contains("todo", r.key)
        for j, h in enumerate(r.hints):
            hint = F.col("_t").contains(h) if not j else hint | F.col("_t").contains(h)
        if r.hints:
            runs = runs & hint
        lens = F.transform(F.when(runs, _pieces(F.col("_t"), r)), _measured(r))
        kinds.append(F.struct(F.lit(i).alias("ord"), lens.alias("pieces")))
    x = x.select("blob", F.explode(F.array(*kinds)).alias("k")).filter("k.pieces IS NOT NULL")
    x = x.select("blob", F.col("k.ord").alias("ord"), F.posexplode("k.pieces").alias("at", "p"))
    before = Window.partitionBy("blob", "ord").orderBy("at") \
        .rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("start", F.coalesce(F.sum("p.n").over(before), F.lit(0)).cast("long"))
    names = F.array(*(F.lit(r.kind) for r in rules))
    return x.filter("p.ok").select("blob", F.get(names, F.col("ord")).alias("kind"), "ord", "start",
                                   (F.col("start") + F.col("p.m")).alias("end"))


def new_blobs(df: DataFrame, text_col: str = "text", ledger: DataFrame | None = None,
              rules=RULES) -> DataFrame:
    """(blob, text, todo) of the distinct texts that some rule has not seen.

    Only 32-byte addresses are compared with the ledger before the texts are
    grouped, and equal texts of a task are combined before the shuffle."""
    x = df.select(blob_of(quoted(text_col)).alias("blob"),
                  F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    if ledger is not None:
        x = unseen(x, ledger, rules).drop("todo")
    return unseen(x.dropDuplicates(["blob"]), ledger, rules)


def scanned(todo: DataFrame) -> DataFrame:
    """The ledger rows (blob, rule) that a scan of ``todo`` adds."""
    return todo.select("blob", F.explode("todo").alias("rule"))


#: Setting that names the folder of the ledger and the findings; unset: nothing is kept.
STORE = "spark.ludeme.secrets.store"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def add_blobs(df: DataFrame, store: str, text_col: str = "text") -> None:
    """Adds the texts of ``df`` that the store does not hold.

    Addresses are compared first, so only texts that are new are shuffled."""
    spark = df.sparkSession
    x = df.select(blob_of(quoted(text_col)).alias("blob"),
                  F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    have = _stored(spark, f"{store}/blobs", BLOBS).select("blob")
    if not have.isEmpty():
        new = materialize(x.select("blob").distinct().join(have, "blob", "left_anti"), "addresses")
        if new.isEmpty():
            return
        x = x.join(new, "blob", "left_semi")
    x.dropDuplicates(["blob"]).write.mode("append").parquet(f"{store}/blobs")


BLOBS, LEDGER = "blob string, text string", "blob string, rule string"
FINDINGS = "blob string, rule string, start long, end long"


def unscanned(spark: SparkSession, store: str, rules=RULES) -> DataFrame:
    """(blob, text, todo) of the store's blobs that some rule version has not seen.

    Where all lack the same versions, as after a new text or a new rule, no text is joined."""
    blobs = _stored(spark, f"{store}/blobs", BLOBS)
    done = _stored(spark, f"{store}/ledger", LEDGER)
    lacking = materialize(unseen(blobs.select("blob"), done, rules), "lacking")
    sets = lacking.groupBy("todo").agg(F.count(F.lit(1)).alias("n")).limit(2).collect()
    if not sets:
        return blobs.limit(0).withColumn("todo", F.array().cast("array<string>"))
    if len(sets) == 1 and sets[0]["n"] == blobs.count():
        return blobs.withColumn("todo", F.array(*map(F.lit, sets[0]["todo"])))
    return blobs.join(lacking, "blob")


def find(df: DataFrame, text_col: str = "text", rules=RULES, store: str | None = None) -> DataFrame:
    """Findings of all ``rules`` in the texts of ``df`` (and in others of the store).

    With a ``store`` (or the setting STORE) only the blob and rule version pairs that its
    ledger does not list are scanned; texts, findings and ledger are appended to, in this
    order, and the findings of earlier runs by the same rule versions are read back.  A run
    that ends in between is scanned again, and equal findings count once."""
    spark = df.sparkSession
    store = store or spark.conf.get(STORE, None)
    if store is None:
        return scan(new_blobs(df, text_col, None, rules), rules)
    add_blobs(df, store, text_col)
    todo = unscanned(spark, store, rules)
    keys, kinds = (F.array(*(F.lit(x) for x in xs))
                   for xs in ([r.key for r in rules], [r.kind for r in rules]))
    scan(todo, rules).select("blob", F.get(keys, F.col("ord")).alias("rule"), "start", "end") \
        .write.mode("append").parquet(f"{store}/findings")
    scanned(todo).write.mode("append").parquet(f"{store}/ledger")
    x = _stored(spark, f"{store}/findings", FINDINGS)
    place = (F.array_position(keys, F.col("rule")) - 1).cast("int")
    return x.withColumn("ord", place).filter("ord >= 0").select(
        "blob", F.get(kinds, F.col("ord")).alias("kind"), "ord", "start", "end")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def per_blob(findings: DataFrame) -> DataFrame:
    """(blob, found): a blob's findings by start, then rule."""
    return findings.distinct().groupBy("blob").agg(F.sort_array(F.collect_list(
        F.struct("start", "ord", "end", "kind"))).alias("found"))


def secrets_of(df: DataFrame, findings: DataFrame, keep: list[str],
               text_col: str = "text") -> DataFrame:
    """Findings joined back to every path: the columns ``keep`` of each row of
    ``df`` and ``found`` (an empty array if none)."""
    kept = [quoted(c) for c in keep]
    paths = df.select(F.struct(*kept).alias("_row"), blob_of(quoted(text_col)).alias("blob"),
                      row_salt(df.select(*kept)).alias("_salt"))
    found = per_blob(findings).select("*", every_salt().alias("_salt"))
    none = F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string>>")
    return paths.join(found, ["blob", "_salt"], "left").select(
        *(F.col("_row").getField(c).alias(c) for c in keep),
        F.coalesce("found", none).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the base spans' SHA-256 and all spans of ``found``."""
    base = F.filter("found", lambda s: s["ord"] < len(BASE_RULES))
    counts = [F.size(F.filter(F.col("found.ord"), F.lit(i).eqNullSafe)).cast("long")
              .alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)]
    rest = [c for c in found.columns if c != "found"]
    return found.select(*rest, *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("found")).alias("spans"))


def redact(df: DataFrame, findings: DataFrame, text_col: str = "text",
           mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every found span replaced by ``mark`` (overlapping spans by
    one); a text without findings is left as it is.  Sets ``n_chars`` anew if
    there is such a column."""
    cols = df.columns
    x = df.select(F.struct(*map(quoted, cols)).alias("_row"), blob_of(quoted(text_col)).alias("_blob"),
                  row_salt(df, (text_col,)).alias("_salt"))
    found = per_blob(findings)
    # Of overlapping spans, one that starts inside an earlier one adds its tail only.
    found = found.select(F.col("blob").alias("_blob"), F.aggregate(
        "found", F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))).otherwise(
            F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    ).alias("_cuts")).select("*", every_salt().alias("_salt"))
    x = x.join(found, ["_blob", "_salt"], "left")
    row, cuts = F.col("_row"), F.col("_cuts")
    t = row.getField(text_col)
    kept = F.transform(F.sequence(F.lit(0), F.size(cuts)), lambda i: F.substring(
        t, (F.when(i > 0, F.get(cuts, i - 1)["end"]).otherwise(0) + 1).cast("int"),
        (F.coalesce(F.get(cuts, i)["start"], F.char_length(t).cast("long"))
         - F.when(i > 0, F.get(cuts, i - 1)["end"]).otherwise(0)).cast("int")))
    new = F.when(cuts.isNull(), t).otherwise(F.array_join(kept, mark))
    out = {c: row.getField(c) for c in cols}
    out[text_col] = new
    if "n_chars" in out:
        out["n_chars"] = F.when(cuts.isNull(), row["n_chars"]).otherwise(
            F.char_length(new).cast("long"))
    return x.select(*(c.alias(n) for n, c in out.items()))
