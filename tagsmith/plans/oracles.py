"""DuckDB oracles for the registered queries.

Each statement is written directly against the raw tables (views named like
the parquet files); fixtures (tag rules, dimension tables, score bands,
centres) are inlined as literal ``VALUES`` / ``CASE`` text from the same
constants the Spark side uses.  Column names and types follow the Spark
result: counts BIGINT, day differences INTEGER, money as DOUBLE (from the
exact DECIMAL(20,2) sum).
"""

from __future__ import annotations

from tagsmith.functions.scores import RFE_BANDS, RFM_BANDS
from tagsmith.plans import standins as SI
from tagsmith.plans.catalog import ALL_TAGS, rules_of, values_sql
from tagsmith.plans.queries import (
    EAS, FIXED_CENTERS, OAS, OLD_AS_OF, PRICE_BANDS, TEST_RFE_BANDS, TEST_RFM_BANDS,
)

# multiclass metrics of the (label l, prediction p) rows of x
_METRICS = """labels AS (SELECT l, count(*) AS actual, count(*) FILTER (WHERE l = p) AS tp FROM x GROUP BY l),
preds AS (SELECT p AS l, count(*) AS predicted FROM x GROUP BY p),
per AS (SELECT a.actual, a.tp,
               CASE WHEN COALESCE(b.predicted, 0) > 0 THEN a.tp / b.predicted ELSE 0.0 END AS prec,
               a.tp / a.actual AS rec
        FROM labels a LEFT JOIN preds b USING (l))
SELECT round(sum(tp) / sum(actual), 6) AS accuracy,
       round(sum(actual * prec) / sum(actual), 6) AS weighted_precision,
       round(sum(actual * rec) / sum(actual), 6) AS weighted_recall,
       round(sum(actual * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) / sum(actual), 6)
         AS f1
FROM per"""

YESTERDAY = "DATE '2001-08-01'"


def _rules(tag_id: int) -> str:
    """Level-5 rules, one name per rule value (lowest id)."""
    return (f"(SELECT rule, arg_min(name, id) AS name FROM "
            f"{values_sql(rules_of(tag_id), ['id', 'name', 'rule'])} GROUP BY rule)")


def _ranges(tag_id: int) -> str:
    pat = r"'^\s*(\d+)\s*-\s*(\d+)\s*$'"
    return (f"(SELECT name, CAST(regexp_extract(rule, {pat}, 1) AS BIGINT) AS s, "
            f"CAST(regexp_extract(rule, {pat}, 2) AS BIGINT) AS e "
            f"FROM {values_sql(rules_of(tag_id), ['id', 'name', 'rule'])} "
            f"WHERE regexp_matches(rule, {pat}))")


def _rfm_metrics() -> str:
    return f"""
SELECT o_custkey AS userId,
       CAST(datediff('day', CAST(max(o_orderdate) AS DATE), DATE '{OAS}') AS INTEGER) AS recency,
       count(o_orderkey) AS frequency,
       CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS DOUBLE) AS monetary
FROM orders WHERE o_orderdate < TIMESTAMP '{OAS}' GROUP BY o_custkey"""


def _scores(metrics_sql: str, bands: dict, extra_cols: list[str]) -> str:
    arms = ", ".join(f"{b.sql(m)} AS {m[0]}_score" for m, b in bands.items())
    return f"SELECT userId, {', '.join(extra_cols)}, {arms} FROM ({metrics_sql}) AS m"


def _rfm_scores(bands=None) -> str:
    return _scores(_rfm_metrics(), bands or TEST_RFM_BANDS, ["recency", "frequency", "monetary"])


def _rfe_metrics() -> str:
    return f"""
SELECT user_id AS userId,
       CAST(datediff('day', CAST(max(ts) AS DATE), DATE '{EAS}') AS INTEGER) AS recency,
       count(event_type || props) AS frequency,
       count(DISTINCT event_type || props) AS engagements
FROM events WHERE ts < TIMESTAMP '{EAS}' GROUP BY user_id"""


def _rfe_scores(bands=None) -> str:
    return _scores(_rfe_metrics(), bands or TEST_RFE_BANDS, ["recency", "frequency", "engagements"])


def _dist_list(cols=("r_score", "f_score", "m_score")) -> str:
    ds = []
    for c in FIXED_CENTERS:
        ds.append(" + ".join(f"(({col} - CAST({float(v)} AS DOUBLE)) * ({col} - CAST({float(v)} AS DOUBLE)))"
                            for col, v in zip(cols, c)))
    return "list_value(" + ", ".join(ds) + ")"


def _assigned() -> str:
    return (f"SELECT *, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS prediction, list_min(ds) AS dist "
            f"FROM (SELECT *, {_dist_list()} AS ds FROM ({_rfm_scores()}) AS s) AS x")


def _hash_pct(key: str, start: int) -> str:
    return f"(CAST(('0x' || substr(md5({key}), {start}, 8)) AS BIGINT) % 100)"


def _noisy_goods() -> str:
    key = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"
    return (f"SELECT l_orderkey, l_linenumber, color, product, CASE WHEN {_hash_pct(key, 9)} < {SI.NOISE_PCT} "
            f"THEN 1 - label ELSE label END AS label, {_hash_pct(key, 1)} < 80 AS is_train FROM ({_goods()})")


def _majority() -> str:
    """Class of each (colour, product) pair: the majority of its training
    lines, which is what a deep enough tree predicts."""
    return (f"SELECT color, product, CASE WHEN 2 * sum(label) > count(*) THEN 1 ELSE 0 END AS cls "
            f"FROM ({_noisy_goods()}) WHERE is_train GROUP BY color, product")


def _goods() -> str:
    colors = values_sql(SI.COLORS, ["id", "name"])
    products = values_sql(SI.PRODUCTS, ["id", "name"])
    fem_c = ", ".join(f"'{c}'" for c in SI.FEMALE_COLORS)
    fem_p = ", ".join(f"'{p}'" for p in SI.FEMALE_PRODUCTS)
    return f"""
SELECT l.l_orderkey, l.l_linenumber,
       COALESCE(c.id, 0) AS color, COALESCE(pr.id, 0) AS product,
       CASE WHEN split_part(p.p_name, ' ', 1) IN ({fem_c}) OR p.p_type IN ({fem_p}) THEN 1 ELSE 0 END AS label
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN (SELECT name, min(id) AS id FROM {colors} GROUP BY name) c ON split_part(p.p_name, ' ', 1) = c.name
LEFT JOIN (SELECT name, min(id) AS id FROM {products} GROUP BY name) pr ON p.p_type = pr.name"""


def _votes(order_filter: str = "TRUE") -> str:
    return f"""
SELECT o.o_custkey AS userId, count(*) AS total,
       CAST(sum(CASE WHEN g.label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS male,
       CAST(sum(CASE WHEN g.label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS female
FROM ({_goods()}) g JOIN orders o ON g.l_orderkey = o.o_orderkey
WHERE {order_filter} GROUP BY o.o_custkey"""


def _vote_class() -> str:
    return ("CASE WHEN male / total >= 0.6 THEN '0' WHEN female / total >= 0.6 THEN '1' ELSE '-1' END")


def _pay_type(order_filter: str) -> str:
    return f"""
SELECT r.o_custkey AS userId, t.name AS payment FROM (
  SELECT o_custkey, v, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, v ASC) AS rn
  FROM (SELECT o_custkey, o_orderpriority AS v, count(*) AS n FROM orders WHERE {order_filter} GROUP BY 1, 2) c
) r JOIN {_rules(356)} t ON r.v = t.rule WHERE r.rn = 1"""


def _consume_cycle(as_of: str) -> str:
    return f"""
SELECT d.o_custkey AS userId, t.name AS consumercycle FROM (
  SELECT o_custkey, datediff('day', CAST(max(o_orderdate) AS DATE), DATE '{as_of}') AS days
  FROM orders WHERE o_orderdate < TIMESTAMP '{as_of}' GROUP BY o_custkey
) d JOIN {_ranges(347)} t ON d.days BETWEEN t.s AND t.e"""


def _segment() -> str:
    return (f"SELECT c.c_custkey AS userId, t.name AS segment FROM customer c "
            f"JOIN {_rules(390)} t ON c.c_mktsegment = t.rule")


def _age_band() -> str:
    return f"""
SELECT b.o_custkey AS userId, t.name AS agerange FROM (
  SELECT o_custkey, CAST(strftime(min(o_orderdate), '%Y%m%d') AS INTEGER) AS born FROM orders GROUP BY o_custkey
) b JOIN {_ranges(338)} t ON b.born BETWEEN t.s AND t.e"""


def _profile(as_of: str, with_segment: bool = True) -> str:
    parts = [
        f"SELECT userId, payment, NULL AS consumercycle, NULL AS segment, NULL AS agerange "
        f"FROM ({_pay_type(f'o_orderdate < TIMESTAMP {chr(39)}{as_of}{chr(39)}')})",
        f"SELECT userId, NULL, consumercycle, NULL, NULL FROM ({_consume_cycle(as_of)})",
    ]
    if with_segment:
        parts.append(f"SELECT userId, NULL, NULL, segment, NULL FROM ({_segment()})")
        parts.append(f"SELECT userId, NULL, NULL, NULL, agerange FROM ({_age_band()})")
    cols = "max(payment) AS payment, max(consumercycle) AS consumercycle"
    if with_segment:
        cols += ", max(segment) AS segment, max(agerange) AS agerange"
    return f"SELECT userId, {cols} FROM ({' UNION ALL '.join(parts)}) u GROUP BY userId"


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["condition_filter"] = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus <> 'P' AND o_totalprice >= 50000 AND o_totalprice <= 450000
  AND o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'
  AND o_orderpriority = '1-URGENT'"""
    q["rolling_window"] = " UNION ALL ".join(
        f"SELECT '{label}' AS \"window\", o_orderkey, o_custkey, o_orderdate FROM orders "
        f"WHERE o_orderdate >= {YESTERDAY} - INTERVAL {days} DAY AND o_orderdate < DATE '{OAS}'"
        for label, days in (("o_orderdate#day#30", 30), ("o_orderdate#month#6", 180), ("o_orderdate#year#1", 365)))
    q["business_scan"] = f"""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_orderstatus <> 'P' AND o_orderdate >= {YESTERDAY} - INTERVAL 180 DAY AND o_orderdate < DATE '{OAS}'"""
    q["match_inner"] = _segment()
    q["match_left"] = (f"SELECT c.c_custkey AS userId, t.name AS nationality FROM customer c "
                       f"LEFT JOIN {_rules(332)} t ON CAST(c.c_nationkey AS VARCHAR) = t.rule")
    q["match_multi"] = f"""
SELECT c.c_custkey AS userId, s.name AS segment, n.name AS nationality FROM customer c
LEFT JOIN {_rules(390)} s ON c.c_mktsegment = s.rule
LEFT JOIN {_rules(332)} n ON CAST(c.c_nationkey AS VARCHAR) = n.rule
WHERE s.name IS NOT NULL OR n.name IS NOT NULL"""
    q["unmatched_values"] = f"""
SELECT CAST(c_nationkey AS VARCHAR) AS value, count(*) AS "rows" FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM {_rules(332)} t WHERE t.rule = CAST(c.c_nationkey AS VARCHAR))
GROUP BY 1"""
    q["age_band"] = _age_band()
    q["consume_cycle"] = _consume_cycle(OAS)
    q["order_span"] = f"""
SELECT o_custkey AS userId, min(o_orderdate) AS "first",
       CAST(datediff('day', CAST(max(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '{OAS}') AS DATE),
                     DATE '{OAS}') AS INTEGER) AS days
FROM orders GROUP BY o_custkey"""
    q["pay_type"] = _pay_type("TRUE")
    cat = values_sql([(i, n, r, lvl, pid) for (i, n, r, lvl, pid) in ALL_TAGS if i == 356 or pid == 356],
                     ["id", "name", "rule", "level", "pid"])
    q["tag_lookup"] = f"""
WITH p AS ({_pay_type("TRUE")}),
c AS (SELECT payment AS k, count(*) AS users FROM p GROUP BY payment
      UNION ALL SELECT '#all', count(*) FROM p)
SELECT DISTINCT CAST(t.id AS BIGINT) AS id, t.name, t.rule, t.level, COALESCE(c.users, 0) AS users
FROM {cat} LEFT JOIN c ON c.k = CASE WHEN t.level = 4 THEN '#all' ELSE t.name END"""
    business = [(i, rule) for (i, _n, rule, lvl, _p) in ALL_TAGS if lvl == 4 and rule]
    kv = values_sql([(i, rule) for i, rule in business], ["id", "rule"])
    counts = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS id, count(*) AS \"rows\" FROM "
        + next(line.split("=", 1)[1] for line in rule.split("\n") if line.startswith("table="))
        for i, rule in business)
    q["rule_options"] = f"""
WITH lines AS (SELECT CAST(id AS BIGINT) AS id, unnest(string_split(rule, chr(10))) AS line FROM {kv})
SELECT l.id, split_part(l.line, '=', 1) AS "key", substr(l.line, strpos(l.line, '=') + 1) AS value, c."rows"
FROM lines l JOIN ({counts}) c ON c.id = l.id
WHERE l.line <> ''"""
    q["range_rules"] = f"""
SELECT r.name, r.s AS start, r.e AS "end", COALESCE(c.users, 0) AS users
FROM {_ranges(347)} r LEFT JOIN (SELECT consumercycle, count(*) AS users FROM ({_consume_cycle(OAS)})
                                 GROUP BY consumercycle) c ON c.consumercycle = r.name"""
    q["top_n_per_group"] = """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS "rank" FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ASC) AS rn
  FROM orders) WHERE rn <= 3"""
    q["value_counts"] = """
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS "count" FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority"""
    q["rfm_metrics"] = _rfm_metrics()
    q["rfm_scores"] = _rfm_scores()
    q["rfm_default_scores"] = _rfm_scores(RFM_BANDS)
    q["rfm_weighted"] = (f"SELECT userId, r_score * CAST(0.25 AS DOUBLE) + f_score * CAST(0.25 AS DOUBLE) "
                         f"+ m_score * CAST(0.5 AS DOUBLE) AS value "
                         f"FROM ({_rfm_scores()})")
    bad = "o_orderkey % 97 = 0 OR o_orderkey % 89 = 0"
    q["rfm_text"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS userId,
       CAST(datediff('day', CAST(max(o_orderdate) AS DATE), DATE '{OAS}') AS INTEGER) AS recency,
       count(*) AS frequency,
       CAST(CAST(sum(CASE WHEN {bad} THEN NULL ELSE CAST(o_totalprice AS DECIMAL(20,2)) END) AS DECIMAL(30,2)) AS DOUBLE) AS monetary
FROM orders WHERE o_orderdate < TIMESTAMP '{OAS}' AND o_orderkey % 83 <> 0 GROUP BY o_custkey"""
    q["malformed_amounts"] = f"SELECT count(*) FILTER (WHERE {bad}) AS malformed, CAST(0 AS BIGINT) AS missing FROM orders"
    total = "SELECT count(*) FROM v"
    q["rfm_value_ranks"] = f"""
WITH v AS ({q['rfm_weighted']})
SELECT userId, value, rank() OVER (ORDER BY value DESC) AS "rank",
       rank() OVER (ORDER BY value DESC) <= ceil(0.2 * ({total})) AS is_top FROM v"""
    q["rfe_activity_ranks"] = f"""
WITH v AS (SELECT userId, r_score + f_score + e_score AS activity FROM ({_rfe_scores()}))
SELECT userId, activity, rank() OVER (ORDER BY activity DESC) AS "rank",
       rank() OVER (ORDER BY activity DESC) <= ceil(0.1 * ({total})) AS is_top FROM v"""
    q["rfm_value_per_cluster"] = f"""
SELECT prediction, count(*) AS users, round(avg(value), 6) AS mean_value, round(sum(value), 6) AS total_value FROM (
  SELECT prediction, 0.25 * r_score + 0.25 * f_score + 0.5 * m_score AS value FROM ({_assigned()})) GROUP BY prediction"""
    for kind, metrics_sql, cols in (("rfm", _rfm_scores(), "r_score, f_score, m_score"), ("rfe", _rfe_scores(), "r_score, f_score, e_score")):
        q[f"{kind}_segments_report"] = f"""
SELECT count(*) AS users, count(*) AS tagged, count(DISTINCT ({cols})) AS vectors, CAST(0 AS BIGINT) AS two_tags,
       CAST(0 AS BIGINT) AS not_nearest, CAST(0 AS BIGINT) AS inversions FROM ({metrics_sql})"""
    split = _hash_pct("CAST(vec_id AS VARCHAR)", 1)
    q["logreg_report"] = f"""
WITH e AS (SELECT label, {split} < 80 AS is_train FROM embeddings)
SELECT label, CAST(row_number() OVER (ORDER BY count(*) FILTER (WHERE is_train) DESC, CAST(label AS VARCHAR)) - 1 AS DOUBLE) AS label_idx,
       count(*) AS "rows", count(*) FILTER (WHERE is_train) AS train_rows, CAST(0 AS BIGINT) AS outside
FROM e GROUP BY label"""
    q["rfe_metrics"] = _rfe_metrics()
    q["rfe_scores"] = _rfe_scores()
    q["rfe_default_scores"] = _rfe_scores(RFE_BANDS)
    q["rfe_lifecycle"] = f"""
WITH e AS (SELECT user_id, ts, event_type || props AS url FROM events
           WHERE ts < TIMESTAMP '{EAS}'),
g AS (SELECT user_id, max(CASE WHEN gap > INTERVAL 7 DAY THEN 1 ELSE 0 END) AS has_gap FROM (
        SELECT user_id, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM e) GROUP BY user_id),
u AS (SELECT user_id,
             datediff('day', CAST(max(ts) AS DATE), DATE '{EAS}') AS d,
             datediff('day', CAST(min(ts) AS DATE), DATE '{EAS}') AS first_d,
             count(*) FILTER (WHERE ts >= TIMESTAMP '{EAS}' - INTERVAL 1 DAY) AS lv,
             count(DISTINCT url) FILTER (WHERE ts >= TIMESTAMP '{EAS}' - INTERVAL 1 DAY) AS lp
      FROM e GROUP BY user_id)
SELECT u.user_id AS userId,
       CASE WHEN lv >= 2 AND lv = lp THEN 'loyal'
            WHEN first_d <= 3 THEN 'new'
            WHEN d <= 3 AND g.has_gap = 1 THEN 'returning'
            WHEN d <= 2 THEN 'active'
            WHEN d <= 7 THEN 'inactive'
            ELSE 'lost' END AS lifecycle
FROM u JOIN g USING (user_id)"""
    q["nearest_center"] = f"SELECT userId, prediction FROM ({_assigned()})"
    q["wssse"] = f"SELECT sum(dist) AS wssse, count(*) AS points FROM ({_assigned()})"
    q["center_rank_tags"] = f"""
WITH c AS (SELECT prediction, avg(r_score) AS r, avg(f_score) AS f, avg(m_score) AS m, count(*) AS points
           FROM ({_assigned()}) GROUP BY prediction),
r AS (SELECT prediction, r + f + m AS center_sum, points,
             row_number() OVER (ORDER BY r + f + m DESC, prediction) - 1 AS rk FROM c)
SELECT r.prediction, round(r.center_sum, 6) AS center_sum, CAST(r.rk AS INTEGER) AS "rank", r.points, t.name AS tag
FROM r LEFT JOIN {_rules(361)} t ON CAST(r.rk AS VARCHAR) = t.rule"""
    q["cluster_profile"] = f"""
SELECT prediction, count(*) AS users, max(r_score + f_score + m_score) AS max_score,
       min(r_score + f_score + m_score) AS min_score
FROM ({_assigned()}) GROUP BY prediction"""
    mm = []
    for c in ("recency", "frequency", "monetary"):
        x = f"CAST({c} AS DOUBLE)"
        rng = f"(max({x}) OVER () - min({x}) OVER ())"
        mm.append(f"round(CASE WHEN {rng} <> 0 THEN {x} * (1.0 / {rng}) + (-min({x}) OVER () * (1.0 / {rng})) "
                  f"ELSE 0.5 END, 6) AS {c}_scaled")
    q["kmeans_trials"] = (f"SELECT count(*) AS users, CAST(3 AS BIGINT) AS trials, TRUE AS lowest, TRUE AS cost_matches "
                          f"FROM ({_rfm_scores()})")
    q["catalog_scan"] = _segment()
    q["dimension_scan"] = f"SELECT l_orderkey, l_linenumber, color, product FROM ({_goods()})"
    q["csv_scan"] = "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer"
    q["profile_store"] = (f"SELECT coalesce(s.userId, p.userId) AS userId, s.segment, p.payment FROM ({_segment()}) s "
                          f"FULL OUTER JOIN ({_pay_type('TRUE')}) p ON s.userId = p.userId")
    q["model_store"] = (f"SELECT count(*) AS users, count(*) AS tagged, CAST(0 AS BIGINT) AS differing "
                        f"FROM ({_rfm_scores()})")
    q["price_bands"] = f"""
SELECT b.band, count(*) AS orders FROM (SELECT CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders) o
JOIN (SELECT range AS band FROM range({PRICE_BANDS})) b ON o.price BETWEEN b.band * 2500 AND b.band * 2500 + 2499
GROUP BY b.band"""
    q["top_customers"] = """
SELECT o_custkey AS userId, CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS total
FROM orders GROUP BY o_custkey ORDER BY total DESC, userId LIMIT 10"""
    q["minmax_scale"] = f"SELECT userId, {', '.join(mm)} FROM ({_rfm_metrics()})"
    q["l2_normalize"] = """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round(CAST(embedding[i] AS DOUBLE) / norm, 6) AS value FROM (
  SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS i,
         sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm
  FROM embeddings)"""
    q["label_index"] = """
WITH f AS (SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1),
r AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS DOUBLE) AS label_idx FROM f)
SELECT c.c_custkey AS userId, c.c_mktsegment, r.label_idx FROM customer c JOIN r USING (c_mktsegment)"""
    q["encode_dims"] = f"SELECT l_orderkey, l_linenumber, color, product FROM ({_goods()})"
    q["seed_labels"] = f"SELECT l_orderkey, l_linenumber, label FROM ({_goods()})"
    q["usg_join"] = (f"SELECT o.o_custkey AS userId, g.l_orderkey, g.l_linenumber, g.color, g.product, g.label "
                     f"FROM ({_goods()}) g JOIN orders o ON g.l_orderkey = o.o_orderkey")
    q["usg_vote"] = (f"SELECT v.userId, v.total, v.male, v.female, t.name AS usg FROM ({_votes()}) v "
                     f"LEFT JOIN {_rules(380)} t ON {_vote_class()} = t.rule")
    recent = (f"o.o_orderdate < TIMESTAMP '{OAS}' AND "
              f"CAST(o.o_orderdate AS DATE) >= DATE '{OAS}' - INTERVAL 180 DAY")
    q["usg_vote_recent"] = (f"SELECT v.userId, v.total, v.male, v.female, t.name AS usg FROM ({_votes(recent)}) v "
                            f"LEFT JOIN {_rules(380)} t ON {_vote_class()} = t.rule")
    voted = f"""
SELECT o.o_custkey AS userId, count(*) AS total,
       CAST(sum(CASE WHEN m.cls = 0 THEN 1 ELSE 0 END) AS BIGINT) AS male,
       CAST(sum(CASE WHEN m.cls = 1 THEN 1 ELSE 0 END) AS BIGINT) AS female
FROM ({_goods()}) g JOIN ({_majority()}) m USING (color, product) JOIN orders o ON g.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey"""
    q["usg_tree"] = (f"SELECT v.userId, v.total, v.male, v.female, t.name AS usg FROM ({voted}) v "
                     f"LEFT JOIN {_rules(380)} t ON {_vote_class()} = t.rule")
    q["usg_tree_metrics"] = f"""
WITH x AS (SELECT g.label AS l, m.cls AS p FROM ({_noisy_goods()}) g JOIN ({_majority()}) m USING (color, product)
           WHERE NOT g.is_train),
{_METRICS}"""
    q["hash_split"] = ("SELECT o_orderkey, (CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)"
                       " % 100) < 80 AS is_train FROM orders")
    q["classification_metrics"] = f"""
WITH v AS (SELECT userId, CASE WHEN male / total >= 0.6 THEN 0 WHEN female / total >= 0.6 THEN 1 ELSE -1 END AS p
           FROM ({_votes()})),
x AS (SELECT g.label AS l, v.p FROM ({_goods()}) g JOIN orders o ON g.l_orderkey = o.o_orderkey
      JOIN v ON v.userId = o.o_custkey),
{_METRICS}"""
    nations = (f"SELECT c.c_custkey AS userId, n.name AS nationality FROM customer c "
               f"JOIN {_rules(332)} n ON CAST(c.c_nationkey AS VARCHAR) = n.rule")
    parts = [("segment", _segment()), ("nationality", nations), ("consumercycle", _consume_cycle(OAS)),
             ("agerange", _age_band()), ("payment", _pay_type(f"o_orderdate < TIMESTAMP '{OAS}'")),
             ("lifecycle", q["rfe_lifecycle"])]
    names = [n for n, _ in parts]
    rows = " UNION ALL ".join(
        "SELECT userId, " + ", ".join(m if m == n else f"CAST(NULL AS VARCHAR) AS {m}" for m in names) + f" FROM ({sql}) AS s"
        for n, sql in parts)
    q["profile_full_untrained"] = (f"SELECT userId, {', '.join(f'max({n}) AS {n}' for n in names)} FROM ({rows}) u "
                                   f"GROUP BY userId")
    q["profile_wide"] = _profile(OAS)
    old, new = _profile(OLD_AS_OF), _profile(OAS, with_segment=False)
    q["profile_upsert"] = f"""
SELECT COALESCE(n.userId, o.userId) AS userId,
       COALESCE(n.payment, o.payment) AS payment,
       COALESCE(n.consumercycle, o.consumercycle) AS consumercycle,
       o.segment, o.agerange
FROM ({old}) o FULL OUTER JOIN ({new}) n ON o.userId = n.userId"""
    return q


ORACLES = oracles()
