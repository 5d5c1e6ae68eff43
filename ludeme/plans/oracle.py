"""Independent DuckDB SQL for the SQL-expressible queries of the registry.

Views ``events``, ``embeddings`` etc. are the supplied parquet tables.  The CTEs
re-derive the interaction log, the frequency-ordered ids and the md5 hash split
from scratch, so a match checks the Spark operators end to end.
"""

from __future__ import annotations

# The events binding of the log.
LOG = """log AS (
  SELECT event_id, user_id AS member_id, json_extract_string(props, '$.k') AS game,
         CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE 'play' END AS behaviour,
         value
  FROM events
  WHERE event_type IN ('purchase', 'view', 'click'))"""

# Frequency-ordered dense ids (count desc, label as text), the md5 hash split and
# the log-scaled rating.
INDEXED = LOG + """,
uc AS (SELECT member_id, count(*) AS n FROM log GROUP BY member_id),
ud AS (SELECT member_id, n,
              CAST(row_number() OVER (ORDER BY n DESC, CAST(member_id AS VARCHAR)) - 1 AS INTEGER)
                AS user_id FROM uc),
gc AS (SELECT game, count(*) AS n FROM log GROUP BY game),
gd AS (SELECT game, n,
              CAST(row_number() OVER (ORDER BY n DESC, game) - 1 AS INTEGER) AS game_id FROM gc),
r AS (
  SELECT l.event_id, l.member_id, ud.user_id, l.game, gd.game_id, l.behaviour,
         CASE WHEN l.behaviour = 'purchase' THEN 1.0 ELSE ln(1 + l.value) END AS rating,
         CASE WHEN (('0x' || substr(md5('42|' || CAST(l.event_id AS VARCHAR)), 1, 8))::BIGINT
                    % 1000000) < 800000 THEN 'train' ELSE 'test' END AS split
  FROM log l JOIN ud USING (member_id) JOIN gd USING (game))"""


def _top(action: str, alias: str) -> str:
    return f"""WITH {LOG}
SELECT game, ROUND(SUM(value), 6) AS {alias}
FROM log WHERE behaviour = '{action}'
GROUP BY game ORDER BY {alias} DESC, game LIMIT 10"""


# Users' mean vectors of what they rated, as hybrid lists use them.
PROFILES = INDEXED + """,
emb AS (SELECT CAST(vec_id AS VARCHAR) AS game, CAST(embedding AS DOUBLE[]) AS vector
        FROM embeddings),
tr AS (SELECT r.user_id, r.rating, e.vector
       FROM r JOIN emb e USING (game) WHERE r.split = 'train' AND r.rating > 0),
el AS (SELECT user_id, rating, generate_subscripts(vector, 1) AS i, unnest(vector) AS x
       FROM tr),
pe AS (SELECT user_id, i, sum(rating * x) / sum(rating) AS v FROM el GROUP BY user_id, i),
prof AS (SELECT user_id, list(v ORDER BY i) AS profile FROM pe GROUP BY user_id)"""


def _unit(vector: str) -> str:
    return (f"list_transform({vector}, lambda x: CAST(CAST(x / sqrt(list_dot_product({vector}, "
            f"{vector})) AS FLOAT) AS DOUBLE))")


ORACLE_SQL: dict[str, str] = {
    "load_interactions": f"WITH {LOG} SELECT * FROM log",
    "preview": f"WITH {LOG} SELECT * FROM log ORDER BY event_id LIMIT 10",
    "dataset_profile": f"""WITH {LOG}
SELECT count(*) AS rows, count(DISTINCT member_id) AS users, count(DISTINCT game) AS items
FROM log""",
    "behaviour_counts": f"WITH {LOG} SELECT behaviour, count(*) AS count FROM log GROUP BY 1",
    "null_audit": f"""WITH {LOG}
SELECT count(*) FILTER (WHERE event_id IS NULL) AS event_id_nulls,
       count(*) FILTER (WHERE member_id IS NULL) AS member_id_nulls,
       count(*) FILTER (WHERE game IS NULL) AS game_nulls,
       count(*) FILTER (WHERE behaviour IS NULL) AS behaviour_nulls,
       count(*) FILTER (WHERE value IS NULL) AS value_nulls
FROM log""",
    "playtime_stats": f"""WITH {LOG}
SELECT count(value) AS count, ROUND(avg(value), 6) AS mean,
       ROUND(stddev_samp(value), 6) AS stddev, min(value) AS min, max(value) AS max
FROM log WHERE behaviour = 'play'""",
    "clean_interactions": f"""WITH {LOG}
SELECT * FROM log
WHERE member_id IS NOT NULL AND game IS NOT NULL AND behaviour IS NOT NULL
  AND value IS NOT NULL""",
    "sql_top_played": _top("play", "total_playtime"),
    "sql_top_purchased": _top("purchase", "total_purchased"),
    "ratings_play": f"""WITH {LOG}
SELECT event_id, member_id, game, value AS rating FROM log WHERE behaviour = 'play'""",
    "ratings_combined": f"""WITH {LOG}
SELECT event_id, member_id, game, behaviour,
       CASE WHEN behaviour = 'purchase' THEN 1.0 ELSE value END AS rating
FROM log""",
    "ratings_log": f"""WITH {LOG}
SELECT event_id, member_id, game, behaviour,
       ROUND(CASE WHEN behaviour = 'purchase' THEN 1.0 ELSE ln(1 + value) END, 6) AS rating
FROM log""",
    "index_users": f"WITH {INDEXED} SELECT member_id, user_id, n FROM ud",
    "index_games": f"WITH {INDEXED} SELECT game, game_id, n FROM gd",
    "game_dictionary": f"WITH {INDEXED} SELECT game, game_id FROM gd",
    "indexed_ratings": f"""WITH {INDEXED}
SELECT event_id, user_id, game, game_id, ROUND(rating, 6) AS rating FROM r""",
    "split_hash": f"""WITH {INDEXED}
SELECT l.event_id, l.member_id, l.game,
       CASE WHEN (('0x' || substr(md5('42|' || CAST(l.event_id AS VARCHAR)), 1, 8))::BIGINT
                  % 1000000) < 800000 THEN 'train' ELSE 'test' END AS split
FROM log l""",
    "split_hash_small": f"""WITH {LOG}, s AS (
SELECT CASE WHEN (('0x' || substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8))::BIGINT
                  % 1000000) < 995000 THEN 'train' ELSE 'test' END AS split FROM log)
SELECT split, count(*) AS rows FROM s GROUP BY split""",
    "rejected_ratings": f"""WITH {LOG}
SELECT 'play' AS rule, count(*) AS rows, count(*) FILTER (value IS NULL) AS rejected
FROM log WHERE behaviour = 'play'
UNION ALL SELECT 'combined', count(*),
       count(*) FILTER (behaviour = 'play' AND value IS NULL) FROM log
UNION ALL SELECT 'log', count(*),
       count(*) FILTER (behaviour = 'play' AND (value IS NULL OR value <= -1)) FROM log""",
    "ratings_with_titles": f"""WITH {INDEXED},
tc AS (SELECT game, count(*) AS n FROM r WHERE split = 'train' GROUP BY game),
td AS (SELECT game, CAST(row_number() OVER (ORDER BY n DESC, game) - 1 AS INTEGER)
                      AS train_game_id FROM tc)
SELECT r.event_id, r.user_id, r.game, td.train_game_id
FROM r LEFT JOIN td USING (game) WHERE r.split = 'test'""",
    "rmse_baseline": f"""WITH {INDEXED},
m AS (SELECT avg(rating) AS m FROM r WHERE split = 'train')
SELECT ROUND(sqrt(avg(rating * rating)), 6) AS rmse_zero,
       ROUND(sqrt(avg((rating - m.m) * (rating - m.m))), 6) AS rmse_mean,
       count(*) AS rows
FROM r, m WHERE r.split = 'test'""",
    "ranking_popularity": f"""WITH {INDEXED},
rel AS (SELECT DISTINCT user_id, game_id FROM r WHERE split = 'test' AND rating > 0),
pc AS (SELECT game_id, count(*) AS c FROM r WHERE split = 'train' GROUP BY game_id),
top AS (SELECT game_id, row_number() OVER (ORDER BY c DESC, game_id) AS rnk
        FROM (SELECT * FROM pc ORDER BY c DESC, game_id LIMIT 10)),
hits AS (SELECT rel.user_id, top.rnk,
                row_number() OVER (PARTITION BY rel.user_id ORDER BY top.rnk) AS h
         FROM rel JOIN top USING (game_id)),
pu AS (SELECT user_id, count(*) AS hits, sum(CAST(h AS DOUBLE) / rnk) AS prec_sum
       FROM hits GROUP BY user_id),
nr AS (SELECT user_id, count(*) AS nrel FROM rel GROUP BY user_id)
SELECT 10 AS k, count(*) AS users,
       ROUND(avg(coalesce(pu.hits, 0) / 10.0), 6) AS precision_at_k,
       ROUND(avg(coalesce(pu.prec_sum, 0) / least(nr.nrel, 10)), 6) AS map_at_k
FROM nr LEFT JOIN pu USING (user_id)""",
    "content_scores": f"""WITH {PROFILES},
t AS (SELECT r.event_id, r.user_id, r.game, p.profile, e.vector
      FROM r LEFT JOIN prof p USING (user_id) LEFT JOIN emb e USING (game)
      WHERE r.split = 'test')
SELECT event_id, user_id, game,
       ROUND(CASE WHEN sqrt(list_dot_product(profile, profile))
                       * sqrt(list_dot_product(vector, vector)) > 0
                  THEN list_dot_product(profile, vector)
                       / (sqrt(list_dot_product(profile, profile))
                          * sqrt(list_dot_product(vector, vector))) END, 6) AS content_score
FROM t""",
    "item_neighbours": f"""WITH {LOG},
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v),
q AS (SELECT * FROM u WHERE vec_id IN (SELECT TRY_CAST(game AS BIGINT) FROM log)),
s AS (SELECT q.vec_id AS item, u.vec_id AS neighbour,
             ROUND(list_dot_product(q.e, u.e), 9) AS similarity
      FROM q JOIN u ON q.vec_id <> u.vec_id)
SELECT * FROM (
  SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY similarity DESC, neighbour)
                    AS INTEGER) AS rank, neighbour, similarity FROM s)
WHERE rank <= 10
""",
    "ranking_content": f"""WITH {PROFILES},
f AS (SELECT user_id, {_unit('profile')} AS p FROM prof),
g AS (SELECT gd.game_id, {_unit('vector')} AS v FROM gd JOIN emb USING (game)),
top AS (SELECT user_id, game_id, row_number() OVER (
          PARTITION BY user_id ORDER BY CAST(list_dot_product(p, v) AS FLOAT) DESC, game_id) AS rnk
        FROM f, g QUALIFY rnk <= 10),
rel AS (SELECT DISTINCT user_id, game_id FROM r WHERE split = 'test' AND rating > 0),
hits AS (SELECT user_id, rnk, row_number() OVER (PARTITION BY user_id ORDER BY rnk) AS h
         FROM top JOIN rel USING (user_id, game_id)),
pu AS (SELECT user_id, count(*) AS hits, sum(CAST(h AS DOUBLE) / rnk) AS prec_sum
       FROM hits GROUP BY user_id),
nr AS (SELECT user_id, count(*) AS nrel FROM rel GROUP BY user_id)
SELECT 10 AS k, count(*) AS users,
       ROUND(avg(coalesce(pu.hits, 0) / 10.0), 6) AS precision_at_k,
       ROUND(avg(coalesce(pu.prec_sum, 0) / least(nr.nrel, 10)), 6) AS map_at_k
FROM nr LEFT JOIN pu USING (user_id)""",
    "cold_start_entities": f"""WITH {LOG},
h AS (SELECT *, ('0x' || substr(md5('42|cold-user|' || member_id), 1, 8))::BIGINT % 1000000 < 100000
             OR ('0x' || substr(md5('42|cold-item|' || game), 1, 8))::BIGINT % 1000000 < 100000 AS test
      FROM log WHERE behaviour = 'purchase' OR value > -1),
tu AS (SELECT DISTINCT member_id FROM h WHERE NOT test),
ti AS (SELECT DISTINCT game FROM h WHERE NOT test),
t AS (SELECT tu.member_id IS NULL AS u_cold, ti.game IS NULL AS i_cold
      FROM h LEFT JOIN tu ON h.member_id = tu.member_id LEFT JOIN ti ON h.game = ti.game
      WHERE h.test)
SELECT count(*) AS rows,
       count(*) FILTER (WHERE NOT u_cold AND NOT i_cold) AS scored,
       count(*) FILTER (WHERE u_cold OR i_cold) AS dropped,
       count(*) FILTER (WHERE u_cold) AS unseen_user,
       count(*) FILTER (WHERE i_cold) AS unseen_item
FROM t""",
    "cold_start_report": f"""WITH {LOG},
p AS (SELECT event_id, member_id, game,
             CASE WHEN (('0x' || substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8))::BIGINT
                        % 1000000) < 800000 THEN 'train' ELSE 'test' END AS split
      FROM log WHERE behaviour = 'play'),
tu AS (SELECT DISTINCT member_id FROM p WHERE split = 'train'),
ti AS (SELECT DISTINCT game FROM p WHERE split = 'train'),
t AS (SELECT tu.member_id IS NULL AS u_cold, ti.game IS NULL AS i_cold
      FROM p LEFT JOIN tu ON p.member_id = tu.member_id LEFT JOIN ti ON p.game = ti.game
      WHERE p.split = 'test')
SELECT count(*) AS rows,
       count(*) FILTER (WHERE NOT u_cold AND NOT i_cold) AS scored,
       count(*) FILTER (WHERE u_cold OR i_cold) AS dropped,
       count(*) FILTER (WHERE u_cold) AS unseen_user,
       count(*) FILTER (WHERE i_cold) AS unseen_item
FROM t""",
    "schema_report": f"""WITH {LOG}
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS "column",
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
                        WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int'
                        ELSE lower(column_type) END AS type,
       "null" = 'YES' AS nullable
FROM (DESCRIBE SELECT * FROM log)""",
}
ORACLE_SQL["item_similarity"] = ORACLE_SQL["content_scores"]
