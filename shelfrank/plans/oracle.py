"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Views available: the driver's tables. The CTEs below re-state the adapters in
DuckDB SQL; each query then states its operator in plain SQL.
"""

from __future__ import annotations

from shelfrank.operators import als
from shelfrank.plans import catalog as C

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS productId,
         l_quantity / 10 AS score, CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS INTEGER) AS productId, p_name AS name,
         'img/' || CAST(p_partkey AS VARCHAR) AS imageUrl,
         p_type || '|' || p_brand AS categories,
         replace(p_name, ' ', '|') || '|' || lower(p_type) AS tags
  FROM part)"""

EVENTS = """ev AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS userId,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId,
         round(least(10, greatest(1, ceil(value / 10))) / 2, 2) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events)"""

AVGS = """avgs AS (SELECT productId, avg(score) AS avg FROM ratings GROUP BY productId)"""

MONTH = """strftime(make_timestamp(CASE WHEN "timestamp" >= 100000000000
             THEN CAST(floor("timestamp" / 1000) AS BIGINT) ELSE "timestamp" END * 1000000), '%Y-%m')"""

MONTHLY = f"""monthly AS (
  SELECT productId, count(productId) AS "count", yearmonth
  FROM (SELECT productId, {MONTH} AS yearmonth FROM ratings) GROUP BY productId, yearmonth)"""

SERVED = """served AS (
  SELECT p.productId, p.name, p.imageUrl, p.categories, p.tags,
         round(coalesce(a.avg, 0.0), 6) AS score
  FROM products p LEFT JOIN avgs a ON p.productId = a.productId)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["load_products"] = _with(PRODUCTS) + "SELECT * FROM products"

SQL["load_ratings"] = _with(RATINGS) + "SELECT * FROM ratings"

SQL["table_roundtrip"] = _with(RATINGS) + "SELECT * FROM ratings"

SQL["preview"] = (
    _with(RATINGS)
    + f'SELECT * FROM ratings ORDER BY userId, productId, "timestamp", score LIMIT {C.PREVIEW_N}'
)

SQL["rate_more"] = _with(RATINGS) + 'SELECT productId, count(productId) AS "count" FROM ratings GROUP BY productId'

SQL["monthly_counts"] = _with(RATINGS, MONTHLY) + 'SELECT productId, "count", yearmonth FROM monthly'

SQL["rate_more_sql"] = SQL["rate_more"]

SQL["monthly_counts_ms"] = SQL["monthly_counts"]

SQL["average_score"] = _with(RATINGS) + "SELECT productId, round(avg(score), 6) AS avg FROM ratings GROUP BY productId"

SQL["distinct_keys"] = (
    _with(RATINGS)
    + "SELECT DISTINCT 'user' AS kind, userId AS id FROM ratings "
    + "UNION ALL SELECT DISTINCT 'product' AS kind, productId AS id FROM ratings"
)

SQL["hot_products"] = _with(
    RATINGS,
    PRODUCTS,
    AVGS,
    MONTHLY,
    SERVED,
    f"""top AS (
  SELECT productId, CAST(row_number() OVER (ORDER BY yearmonth DESC, "count" DESC, productId) AS INTEGER) AS rank
  FROM monthly ORDER BY yearmonth DESC, "count" DESC, productId LIMIT {C.HOT_N})""",
    """best AS (SELECT productId, min(rank) AS rank FROM top GROUP BY productId)""",
) + "SELECT b.rank, s.* FROM best b JOIN served s ON b.productId = s.productId"

SQL["most_rated"] = _with(
    RATINGS,
    PRODUCTS,
    AVGS,
    SERVED,
    """counts AS (SELECT productId, count(productId) AS "count" FROM ratings GROUP BY productId)""",
    f"""top AS (
  SELECT productId, CAST(row_number() OVER (ORDER BY "count" DESC, productId) AS INTEGER) AS rank
  FROM counts ORDER BY "count" DESC, productId LIMIT {C.HOT_N})""",
) + "SELECT t.rank, s.* FROM top t JOIN served s ON t.productId = s.productId"

SQL["product_info"] = _with(RATINGS, PRODUCTS, AVGS, SERVED) + "SELECT * FROM served"

SQL["product_search"] = (
    _with(RATINGS, PRODUCTS, AVGS, SERVED)
    + f"SELECT * FROM served WHERE regexp_matches(name, '{C.SEARCH_PATTERN}')"
)

SQL["recent_n"] = _with(RATINGS) + """SELECT userId, rank, productId, score,
       CAST(productId AS VARCHAR) || ':' || CAST(score AS VARCHAR) AS entry
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY userId
        ORDER BY "timestamp" DESC, productId, score DESC) AS INTEGER) AS rank FROM ratings)
WHERE rank <= 20"""

SQL["recent_queue"] = _with(EVENTS) + """SELECT userId, rank, productId, score,
       CAST(productId AS VARCHAR) || ':' || CAST(score AS VARCHAR) AS entry
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY userId
        ORDER BY "timestamp" DESC, event_id DESC) AS INTEGER) AS rank FROM ev)
WHERE rank <= 40"""

SQL["queue_entries"] = f"SELECT userId, rank, productId, score FROM ({SQL['recent_queue']})"

SQL["rating_upsert"] = _with(
    RATINGS,
    EVENTS,
    """w AS (
  SELECT userId, productId, score, "timestamp", 0 AS src, CAST(-1 AS BIGINT) AS seq FROM ratings
  UNION ALL
  SELECT userId, productId, score, "timestamp", 1 AS src, event_id AS seq FROM ev)""",
) + """SELECT userId, productId, score, first_ts AS "timestamp" FROM (
  SELECT userId, productId, score, min("timestamp") OVER (PARTITION BY userId, productId) AS first_ts,
         row_number() OVER (PARTITION BY userId, productId
                            ORDER BY "timestamp" DESC, src DESC, seq DESC, score DESC) AS rn
  FROM w) WHERE rn = 1"""

SQL["rating_upsert_table"] = SQL["rating_upsert"]

SQL["monthly_rollup_table"] = (
    _with(RATINGS)
    + f"""SELECT productId, {MONTH} AS yearmonth, count(productId) AS "count", round(sum(score), 6) AS score_sum
FROM ratings GROUP BY ALL"""
)

SQL["log_events"] = _with(EVENTS) + "SELECT * FROM ev"
SQL["stream_parse"] = _with(EVENTS) + "SELECT * FROM ev"
SQL["rating_json"] = _with(EVENTS) + "SELECT * FROM ev"

JAVA_HASH = """CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER)"""

SQL["user_dedupe"] = (
    """WITH req AS (SELECT c_name AS username FROM customer UNION ALL SELECT s_name FROM supplier),
registered AS (SELECT c_name AS username FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)),
fresh AS (SELECT DISTINCT username FROM req WHERE username IS NOT NULL
          AND username NOT IN (SELECT username FROM registered)),
hashed AS (SELECT username, list_reduce(list_transform(string_split(username, ''),
             lambda c: CAST(ascii(c) AS BIGINT)), lambda a, c: (a * 31 + c) % 4294967296) AS h FROM fresh)
"""
    + f"SELECT username, {JAVA_HASH} AS userId FROM hashed"
)

# ------------------------------------------------------------- similarity
# Brute force over all pairs: fine for an oracle at sf0.01.

FACTORS = """f AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""

ITEM_SIMS = f"""sims AS (
  SELECT a.id AS productId, b.id AS simId, list_cosine_similarity(a.v, b.v) AS sim
  FROM f a JOIN f b ON a.id <> b.id
  WHERE list_dot_product(a.v, a.v) > 0 AND list_dot_product(b.v, b.v) > 0
    AND list_cosine_similarity(a.v, b.v) > {C.ITEM_SIM_THRESHOLD})"""

SQL["item_similarity"] = _with(FACTORS, ITEM_SIMS) + "SELECT productId, simId, round(sim, 6) AS sim FROM sims"

SQL["sim_map"] = SQL["item_similarity"]

SQL["product_recs_nested"] = _with(FACTORS, ITEM_SIMS) + """SELECT productId,
  CAST(row_number() OVER (PARTITION BY productId ORDER BY round(sim, 9) DESC, simId) AS INTEGER) AS rank,
  simId, round(sim, 6) AS sim FROM sims"""

SQL["factor_topk"] = _with(
    FACTORS,
    """s AS (SELECT a.id AS userId, b.id AS productId, list_dot_product(a.v, b.v) AS score
  FROM f a CROSS JOIN f b)""",
    """r AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY round(score, 9) DESC, productId) AS rk
  FROM s WHERE score > 0)""",
) + "SELECT userId, CAST(rk AS INTEGER) AS rank, productId, round(score, 6) AS score FROM r WHERE rk <= 20"

ITEMCF = [
    RATINGS,
    """up AS (SELECT DISTINCT userId, productId FROM ratings)""",
    """n AS (SELECT productId, count(*) AS n FROM up GROUP BY productId)""",
    f"""p AS (SELECT x.productId AS a, y.productId AS b, count(*) AS n_ab
  FROM up x JOIN up y ON x.userId = y.userId AND x.productId < y.productId
  GROUP BY 1, 2 HAVING count(*) >= {C.ITEMCF_MIN_SUPPORT})""",
    """s AS (SELECT a, b, n_ab / sqrt(CAST(na.n AS DOUBLE) * nb.n) AS sim
  FROM p JOIN n na ON na.productId = a JOIN n nb ON nb.productId = b)""",
    """both_ AS (SELECT a AS productId, b AS simId, sim FROM s UNION ALL SELECT b, a, sim FROM s)""",
    """r AS (SELECT *, CAST(row_number() OVER (PARTITION BY productId ORDER BY round(sim, 9) DESC, simId) AS INTEGER)
  AS rank FROM both_)""",
]

SQL["itemcf_recs"] = _with(*ITEMCF) + "SELECT productId, rank, simId, round(sim, 6) AS sim FROM r WHERE rank <= 20"

CONTENT = [
    PRODUCTS,
    """tok AS (SELECT productId, unnest(string_split(tags, '|')) AS tag FROM products)""",
    """tf AS (SELECT productId, tag, count(*) AS tf FROM tok WHERE tag <> '' GROUP BY 1, 2)""",
    """nd AS (SELECT count(DISTINCT productId) AS N FROM tf)""",
    """idf AS (SELECT tag, ln((max(nd.N) + 1.0) / (count(*) + 1.0)) AS idf FROM tf, nd GROUP BY tag)""",
    """w AS (SELECT productId, tag, tf * idf AS w FROM tf JOIN idf USING (tag))""",
    """nrm AS (SELECT productId, sqrt(sum(w * w)) AS nrm FROM w GROUP BY 1 HAVING sum(w * w) > 0)""",
    """dotp AS (SELECT x.productId AS a, y.productId AS b, sum(x.w * y.w) AS d
  FROM w x JOIN w y ON x.tag = y.tag AND x.productId <> y.productId GROUP BY 1, 2)""",
    """s AS (SELECT a AS productId, b AS simId, d / (na.nrm * nb.nrm) AS sim
  FROM dotp JOIN nrm na ON na.productId = a JOIN nrm nb ON nb.productId = b WHERE d > 0)""",
    """r AS (SELECT *, CAST(row_number() OVER (PARTITION BY productId ORDER BY round(sim, 9) DESC, simId) AS INTEGER)
  AS rank FROM s)""",
]

SQL["itemcf_upkeep"] = SQL["itemcf_recs"]

SQL["content_recs"] = _with(*CONTENT) + "SELECT productId, rank, simId, round(sim, 6) AS sim FROM r WHERE rank <= 20"

_NEIGHBOURS = """SELECT r.productId AS sourceId, r.rank, round(r.sim, 6) AS recScore, s.*
FROM r JOIN served s ON s.productId = r.simId WHERE r.rank <= 20"""

SQL["similar_products"] = _with(*ITEMCF, PRODUCTS, AVGS, SERVED) + _NEIGHBOURS

SQL["content_neighbors"] = _with(*CONTENT, RATINGS, AVGS, SERVED) + _NEIGHBOURS

# -------------------------------------------------------------- streaming

STREAM = [
    FACTORS,
    ITEM_SIMS,
    EVENTS,
    """latest AS (SELECT userId, productId FROM (SELECT *, row_number() OVER (PARTITION BY userId
  ORDER BY "timestamp" DESC, event_id DESC) AS rn FROM ev) WHERE rn = 1)""",
    """rated AS (SELECT DISTINCT userId, productId FROM ev)""",
    """nb AS (SELECT l.userId, s.simId AS productId, s.sim FROM latest l JOIN sims s ON s.productId = l.productId
  WHERE NOT EXISTS (SELECT 1 FROM rated r WHERE r.userId = l.userId AND r.productId = s.simId))""",
    """cand AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY userId
  ORDER BY round(sim, 9) DESC, productId) AS INTEGER) AS rank FROM nb) WHERE rank <= 20)""",
    """recent AS (SELECT userId, productId, score FROM (SELECT *, row_number() OVER (PARTITION BY userId
  ORDER BY "timestamp" DESC, event_id DESC) AS rn FROM ev) WHERE rn <= 20)""",
    f"""t AS (SELECT c.userId, c.productId AS q, s.sim, r.score FROM cand c
  JOIN recent r ON r.userId = c.userId
  JOIN sims s ON s.productId = c.productId AND s.simId = r.productId WHERE s.sim > {C.ITEM_SIM_THRESHOLD})""",
    """agg AS (SELECT userId, q AS productId, avg(sim * score)
     + log10(greatest(count(*) FILTER (WHERE score > 3), 1))
     - log10(greatest(count(*) FILTER (WHERE score <= 3), 1)) AS score FROM t GROUP BY 1, 2)""",
    """scored AS (SELECT userId, CAST(row_number() OVER (PARTITION BY userId ORDER BY round(score, 9) DESC, productId)
  AS INTEGER) AS rank, productId, score FROM agg)""",
]

SQL["stream_candidates"] = _with(*STREAM) + "SELECT userId, rank, productId, round(sim, 6) AS sim FROM cand"

SQL["stream_scores"] = _with(*STREAM) + "SELECT userId, rank, productId, round(score, 6) AS score FROM scored"

SQL["stream_recs"] = _with(*STREAM) + """SELECT userId, rank, productId, round(score, 6) AS score FROM scored
UNION ALL
SELECT DISTINCT userId, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE) FROM ev
WHERE userId NOT IN (SELECT userId FROM scored)"""

SQL["upsert_user_recs"] = SQL["stream_recs"]

_USER_SERVE = """SELECT x.userId, x.rank, round(x.score, 6) AS recScore, s.*
FROM {src} x JOIN served s ON s.productId = x.productId WHERE x.rank <= {n}"""

SQL["serve_stream_recs"] = _with(*STREAM, RATINGS, PRODUCTS, AVGS, SERVED) + _USER_SERVE.format(
    src="scored", n=C.SERVE_N
)

FACTOR_RECS = [
    FACTORS,
    """fs AS (SELECT a.id AS userId, b.id AS productId, list_dot_product(a.v, b.v) AS score
  FROM f a CROSS JOIN f b)""",
    """fr AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY userId
  ORDER BY round(score, 9) DESC, productId) AS INTEGER) AS rank FROM fs WHERE score > 0) WHERE rank <= 20)""",
]

SQL["serve_user_recs"] = _with(*FACTOR_RECS, RATINGS, PRODUCTS, AVGS, SERVED) + _USER_SERVE.format(
    src="fr", n=C.SERVE_N
)

SQL["recs_enrich"] = _with(*FACTOR_RECS, RATINGS, PRODUCTS, AVGS, SERVED) + _USER_SERVE.format(src="fr", n=20)

# -------------------------------------------------------------------- ALS
# Model fits (als_predict, als_user_recs, als_item_similarity, als_grid) are
# not reproducible in SQL; their checks below are, and tests/ has invariants.

LABELLED = f"""lab AS (SELECT *, CASE WHEN CAST('0x' || substr(md5('{als.SPLIT_SEED}:' || userId || ':' || productId), 1, 8)
  AS BIGINT) / 4294967296.0 < {als.TRAIN_FRACTION} THEN 'train' ELSE 'test' END AS split FROM ratings)"""

SQL["als_user_recs_check"] = (
    _with(RATINGS) + "SELECT DISTINCT userId, 1 AS short, 1 AS positive, 1 AS ordered, 1 AS agrees FROM ratings"
)

SQL["als_predict_check"] = _with(RATINGS, LABELLED) + """SELECT DISTINCT userId, productId, 1 AS agrees FROM lab
WHERE split = 'test' AND userId IN (SELECT userId FROM lab WHERE split = 'train')
  AND productId IN (SELECT productId FROM lab WHERE split = 'train')"""

SQL["als_item_similarity_check"] = "SELECT 0 AS asymmetric, 0 AS below, 0 AS differs, 0 AS lost"

SQL["als_grid_check"] = f"SELECT {len(C.ALS_GRID_RANKS) * len(C.ALS_GRID_REGS)} AS fits, 1 AS best, 1 AS lowest"

SQL["holdout_split"] = _with(RATINGS, LABELLED) + "SELECT * FROM lab"

SQL["rmse"] = _with(
    RATINGS,
    LABELLED,
    """means AS (SELECT productId, avg(score) AS prediction FROM lab WHERE split = 'train' GROUP BY productId)""",
    """pred AS (SELECT DISTINCT t.userId, t.productId, m.prediction FROM lab t JOIN means m USING (productId)
  WHERE t.split = 'test')""",
    """j AS (SELECT t.score, p.prediction FROM lab t JOIN pred p USING (userId, productId) WHERE t.split = 'test')""",
) + "SELECT round(sqrt(avg((prediction - score) * (prediction - score))), 6) AS rmse, count(*) AS n FROM j"
