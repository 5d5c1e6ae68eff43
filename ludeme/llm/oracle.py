"""DuckDB SQL for the queries that SQL expresses on whole tables."""

from __future__ import annotations

from ludeme.llm.secrets import BASE_RULES, CLOSE, OPEN, OTHER
from ludeme.llm.url_lists import DAY, EPOCH, NO_END, SPAN

#: Vectors become integers; every query against every other row.  Doubles hold
#: the products exactly at these magnitudes.
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

#: All scores of all anchors; positives first, then negatives within their windows.
HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
    list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER
    AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 3
"""

#: Measurements by regular expressions and positions of repeated windows.
QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
k AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) > 4)),
hit AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM k) WHERE n > 1),
rep AS (
  SELECT rid, sum(n)::BIGINT AS n FROM (
    SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS n FROM hit)
  GROUP BY rid),
m AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^!]+', '', 'g')) AS n_shouts,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper
  FROM w LEFT JOIN rep USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 25 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_shouts > 50 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_upper > 70 * word_chars THEN 64 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words,
  fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""

_HEX = "('0x' || substr({}, {}, 8))::BIGINT"

#: Keys of a URL (domain suffixes, path prefixes), entries and captures from the
#: digests that the query names, and a plain range join.
URL_LISTS = rf"""
WITH u AS (
  SELECT DISTINCT url, lower(coalesce(url, '')) AS u FROM pages),
p AS (
  SELECT url, regexp_extract(u, '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1) AS host,
    list_filter(string_split(regexp_extract(u, '^[a-z][a-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'),
                lambda x: x <> '') AS parts FROM u),
l AS (SELECT *, string_split(host, '.') AS labels FROM p WHERE host <> ''),
keys AS (
  SELECT url, 'd:' || array_to_string(labels[len(labels) - k + 1:], '.') AS key, k AS depth
  FROM (SELECT *, unnest(range(2, len(labels) + 1)) AS k FROM l)
  UNION ALL
  SELECT url, 'u:' || host || '/' || array_to_string(parts[:k], '/') AS key, k + 1000 AS depth
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM l)),
h AS (
  SELECT key, {_HEX.format('g', 1)} AS a, {_HEX.format('g', 9)} AS b, {_HEX.format('g', 17)} AS c
  FROM (SELECT DISTINCT key, md5('entry:' || key) AS g FROM keys)),
e AS (
  SELECT CASE WHEN c % 3 = 0 THEN 'allow' ELSE 'block' END AS list, key, a,
    b % {SPAN * DAY} + {EPOCH} AS t0, b % {SPAN * DAY} + {EPOCH} + c % {90 * DAY} + 1 AS t1
  FROM h WHERE a % 4 = 0),
held AS (
  SELECT list, key, t0 AS since, CASE WHEN a % 8 = 0 THEN t1 ELSE {NO_END} END AS until FROM e
  UNION ALL
  SELECT list, key, t1 + {30 * DAY}, {NO_END} FROM e WHERE a % 16 = 0),
c AS (
  SELECT page_id, url, {_HEX.format("md5('fetch:' || page_id)", 1)} % {SPAN * DAY} + {EPOCH}
    AS fetched_at FROM pages),
once AS (SELECT DISTINCT url, fetched_at FROM c),
v AS (
  SELECT o.url, o.fetched_at, count(*) FILTER (list = 'block') AS n_block,
    count(*) FILTER (list = 'allow') AS n_allow,
    arg_max(k.key, (depth, list = 'allow', k.key)) AS decided_by,
    arg_max(list = 'allow', (depth, list = 'allow', k.key)) AS allowed
  FROM once o JOIN keys k ON o.url = k.url JOIN held x ON x.key = k.key
    AND x.since <= o.fetched_at AND o.fetched_at < x.until
  GROUP BY o.url, o.fetched_at)
SELECT page_id, c.url, c.fetched_at, coalesce(n_block, 0) AS n_block,
  coalesce(n_allow, 0) AS n_allow, decided_by, coalesce(allowed, true) AS kept
FROM c LEFT JOIN v ON c.url = v.url AND c.fetched_at = v.fetched_at
"""

#: Bits of a CRC-32, a byte of the text and eight shifts each.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
  range(1, length({0}) + 1), lambda i: [(1000 + ascii({0}[i]))::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, x: CASE WHEN x >= 1000 THEN xor(a, x - 1000)
                    ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END), 4294967295::BIGINT)"""


def _leaf(text: str) -> str:
    parts = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(
        f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in parts) + ")"


def _merkle(doc_levels: int = 7, source_levels: int = 4) -> str:
    """Trees level by level and each leaf's run on every level, for up to 16 ** 7
    documents of a source and 16 ** 4 sources."""
    lower = f"translate(text, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"
    out = [f"""d AS (
  SELECT doc_id, coalesce('=' || source, '') AS s, {_leaf('text')} AS leaf,
    {_leaf(f"CASE WHEN c % 5 = 0 THEN {lower} ELSE text END")} AS claim
  FROM (SELECT *, {_CRC.format('(doc_id::VARCHAR)')} AS c FROM documents))""",
           """t0 AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY s) AS n, leaf AS g FROM d)"""]

    def levels(t, count):
        for k in range(1, count + 1):
            out.append(f"""{t}{k} AS (
  SELECT s, pos // 16 AS pos, (max(n) + 15) // 16 AS n, CASE WHEN max(n) > 1
    THEN sha256(string_agg(g, '' ORDER BY pos)) ELSE max(g) END AS g
  FROM {t}{k - 1} GROUP BY s, pos // 16)""")
            out.append(f"""{t}r{k} AS (SELECT s, pos // 16 AS run, list(g ORDER BY pos) AS kids
  FROM {t}{k - 1} WHERE n > 1 GROUP BY s, pos // 16)""")

    def climb(f, t, count, own):
        for k in range(1, count + 1):
            out.append(f"""{f}{k} AS (
  SELECT f.* REPLACE (f.pos // 16 AS pos,
      CASE WHEN kids IS NULL THEN acc ELSE sha256(array_to_string(kids[1:f.pos % 16], '') || acc
        || array_to_string(kids[f.pos % 16 + 2:], '')) END AS acc,
      CASE WHEN kids IS NULL THEN proof ELSE proof || array_to_string(kids[1:f.pos % 16], '')
        || array_to_string(kids[f.pos % 16 + 2:], '') END AS proof)
  FROM {f}{k - 1} f LEFT JOIN {t}r{k} r ON r.run = f.pos // 16 AND r.s = {own})""")
    levels("t", doc_levels)
    out.append(f"""u0 AS (SELECT '' AS s, s AS source, row_number() OVER (ORDER BY s) - 1 AS pos,
  count(*) OVER () AS n, g FROM t{doc_levels})""")
    levels("u", source_levels)
    out.append("f0 AS (SELECT doc_id, s, leaf, pos, claim AS acc, '' AS proof FROM t0)")
    climb("f", "t", doc_levels, "f.s")
    out.append(f"""h0 AS (SELECT f.* REPLACE (u.pos AS pos), u.g AS subroot
  FROM f{doc_levels} f JOIN u0 u ON f.s = u.source)""")
    climb("h", "u", source_levels, "''")
    return "WITH " + ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, u.g AS root, sha256(proof) AS proof_sha256, acc AS folded_root,
  acc = u.g AS verified FROM h{source_levels} h, u{source_levels} u"""


#: Targets by filling up the sources in the order in which they reach their cap; every
#: quotient of every shard, ranked; and the overlap of each document with its shard's runs.
SOURCE_MIX = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, md5('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (size > 0) AS n_docs,
    3 * sum(size)::BIGINT AS most FROM d GROUP BY source),
w AS (
  SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    sum(source_size) OVER ()::BIGINT AS total FROM per),
f AS (
  SELECT *, sum(weight) OVER () AS weights, coalesce(sum(most) OVER o, 0) AS gone,
    coalesce(sum(weight) OVER o, 0) AS passed FROM w
  WINDOW o AS (ORDER BY most / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, most <= (total - gone)::DOUBLE / (weights - passed) * weight AS capped FROM f),
t AS (
  SELECT *, CASE WHEN capped THEN most::DOUBLE ELSE
    (total - coalesce(sum(most) FILTER (capped) OVER (), 0))::DOUBLE
    / (weights - coalesce(sum(weight) FILTER (capped) OVER (), 0)) * weight END AS target FROM g),
s AS (
  SELECT *, greatest(1, least(ceil(n_docs / 4000), floor(target)))::BIGINT AS n_shards FROM t),
ds AS (
  SELECT d.*, source_size, target, total, {_HEX.format('h', 1)} % n_shards AS shard
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
sh AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size, max(total) AS total,
    CASE WHEN max(source_size) = 0 THEN 0 ELSE max(target) * sum(size)::BIGINT / max(source_size) END
      AS votes,
    ('0x' || substr(md5(concat_ws(':', 'start:42', source, shard::VARCHAR)), 1, 15))::BIGINT AS digest
  FROM ds GROUP BY source, shard),
b AS (SELECT *, CASE WHEN votes >= 2048 THEN 32 ELSE 1 END AS block FROM sh),
q AS (
  SELECT source, shard, block, row_number() OVER (PARTITION BY block
      ORDER BY votes / (2 * j - 1) DESC, digest, source NULLS LAST, shard) AS place
  FROM (SELECT *, unnest(range(1, (3 * shard_size) // block + 1)) AS j FROM b) WHERE votes > 0),
large AS (
  SELECT q.source, q.shard, count(*) AS quota FROM q WHERE block = 32
    AND place <= (SELECT floor(sum(votes) / 32 + 0.5) FROM b WHERE block = 32) GROUP BY ALL),
quotas AS (
  SELECT * FROM large UNION ALL
  SELECT source, shard, count(*) FROM q WHERE block = 1
    AND place <= (SELECT floor(sum(votes) + 0.5) FROM b WHERE block = 1) GROUP BY ALL),
plan AS (
  SELECT b.*, coalesce(quota, 0) * block AS words,
    digest % greatest(ceil(shard_size / block), 1)::BIGINT * block AS a,
    greatest(shard_size, 1) AS whole
  FROM b LEFT JOIN quotas q ON b.source IS NOT DISTINCT FROM q.source AND b.shard = q.shard),
x AS (
  SELECT ds.*, words, a, whole, a + words % whole AS z, sum(size) OVER (
      PARTITION BY ds.source, ds.shard ORDER BY h, doc_id NULLS FIRST, size
      ROWS UNBOUNDED PRECEDING) - size AS p
  FROM ds JOIN plan ON ds.source IS NOT DISTINCT FROM plan.source AND ds.shard = plan.shard)
SELECT doc_id, size, source_size, target, (words // whole * size
    + greatest(0, least(least(z, whole) - p, size) - least(greatest(a - p, 0), size))
    + greatest(0, least(z - whole - p, size) - least(greatest(0 - p, 0), size)))::BIGINT AS taken
FROM x
"""

#: All pairs that share a shingle, and everything that a document reaches over links.
JACCARD_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT rid, unnest(list_distinct(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM d),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid
  GROUP BY a.rid, b.rid),
l AS (
  SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y
  WHERE 100 * i >= 75 * (a.n + b.n - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT rid, rid AS other FROM d UNION SELECT r.rid, e.y FROM r JOIN e ON r.other = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN r ON d.rid = r.rid JOIN d o ON r.other = o.rid LEFT JOIN n ON d.rid = n.rid
GROUP BY d.rid, d.doc_id, n.n
"""


def _spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """Matches of a pattern: marked, cut at the marks, and placed by the pieces' lengths."""
    pattern = pattern.replace("'", "''")
    return rf"""
  SELECT rid, '{kind}' AS kind, {order} AS ord, p AS "start", p + length(m) AS "end" FROM (
    SELECT rid, i, split_part(piece, '{CLOSE}', 1) AS m, sum(length(piece) - (i > 1)::INT) OVER (
      PARTITION BY rid ORDER BY i) - (length(piece) - (i > 1)::INT) AS p FROM (
      SELECT rid, unnest(k) AS piece, generate_subscripts(k, 1) AS i FROM (
        SELECT rid, string_split(regexp_replace(t, '{pattern}', '{OPEN}\0{CLOSE}', 'g'), '{OPEN}') AS k
        FROM d)))
  WHERE i > 1 AND length(regexp_extract(m, '{pattern}', {group})) >= {least}"""


SECRETS_BASE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    translate(coalesce(text, ''), '{OPEN}{CLOSE}', '{OTHER}{OTHER}') AS t FROM documents),
f AS ({" UNION ALL ".join(_spans(r.kind, i, r.pattern, r.group, r.least)
                          for i, r in enumerate(BASE_RULES))})
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(concat_ws(':', kind, "start"::BIGINT, "end"::BIGINT), ','
                             ORDER BY "start", ord), '')) AS base_sha256
FROM d LEFT JOIN f USING (rid) GROUP BY rid, doc_id
"""

#: Every window with the smallest document that it starts in.
SUBSTRINGS = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (
  SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
g AS (
  SELECT rid, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM (
    SELECT *, min(doc_id) OVER (PARTITION BY k) AS least FROM k)
  WHERE least < doc_id GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce((
    SELECT string_agg(w[i], ' ' ORDER BY i) FROM (SELECT unnest(range(1, len(w) + 1)) AS i)
    WHERE NOT list_contains(gone, i)), '') END) AS kept_sha256
FROM d LEFT JOIN g USING (rid)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_url_lists": URL_LISTS,
    "op6_exact_top_k": TOP_K,
    "op7_quality_rules": QUALITY,
    "op8_source_mix": SOURCE_MIX,
    "op9_ngram_jaccard_join": JACCARD_JOIN,
    "op10_base_spans": SECRETS_BASE,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_merkle_manifest": _merkle(),
    "op13_substring_dedup": SUBSTRINGS,
}
