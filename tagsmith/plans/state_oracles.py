"""DuckDB statements of ``state_queries``."""

from __future__ import annotations

from tagsmith.plans.oracles import _hash_pct, _noisy_goods, _pay_type, _rfe_metrics, _rfm_metrics, _segment
from tagsmith.plans.state_queries import EAS, FOLDS, LLOYD_STEPS, LOOKBACK, OAS, PAGE_WINDOW, QUINTILES, SEGMENTS, TOP_PARTS, TUNED


def _profile() -> str:
    """Segments, then the delta: users whose key ends in 7."""
    return f"""
SELECT s.userId, CASE WHEN s.userId % 10 = 7 THEN 'moved' ELSE s.segment END AS segment,
       CASE WHEN s.userId % 10 = 7 THEN p.payment END AS payment
FROM (SELECT c.c_custkey AS userId, g.segment FROM customer c LEFT JOIN ({_segment()}) g ON g.userId = c.c_custkey
      WHERE g.userId IS NOT NULL OR c.c_custkey % 10 = 7) s LEFT JOIN ({_pay_type('TRUE')}) p ON p.userId = s.userId
UNION ALL SELECT -c_custkey, 'added', NULL FROM customer WHERE c_custkey % 10 = 7"""


def _fitted(metrics: str, up: dict[str, bool]) -> str:
    """Scores of five bands cut at the quintiles; a value up to several equal
    cuts has the score of the first."""
    cuts, arms = [], []
    for m, better in up.items():
        for i, q in enumerate(QUINTILES):
            cuts.append(f"quantile_disc({m}, {q}) AS {m}_{i}")
        scores = (1, 2, 3, 4, 5) if better else (5, 4, 3, 2, 1)
        whens = " ".join(f"WHEN {m} <= {m}_{i} THEN {s}.0" for i, s in enumerate(scores[:-1]))
        arms.append(f"CAST(CASE {whens} WHEN {m} IS NOT NULL THEN {scores[-1]}.0 END AS DOUBLE) AS {m[0]}_score")
    return (f"WITH m AS ({metrics}), c AS (SELECT {', '.join(cuts)} FROM m) "
            f"SELECT userId, {', '.join(up)}, {', '.join(arms)} FROM m, c")


def _grown_tree(depth: int = 5) -> str:
    """The greedy gini tree over (color, product), level by level: every
    feature's categories in the order of their share of ones, the best prefix
    taken; inner nodes whose leaves all predict the same class are merged."""
    gini = lambda n, k: f"(2 * ({k}) / ({n}) * (1 - ({k}) / ({n})))"
    ctes = [f"""h0 AS (SELECT color, product, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS k, 1 AS a0
                       FROM ({_noisy_goods()}) WHERE is_train GROUP BY color, product)"""]
    for lv in range(depth):
        open_ = f"a{lv} >= {2 ** lv}"
        ctes.append(f"""c{lv} AS (
  SELECT a{lv} AS node, 'color' AS f, color AS v, sum(n) AS n, sum(k) AS k FROM h{lv} WHERE {open_} GROUP BY ALL
  UNION ALL SELECT a{lv}, 'product', product, sum(n), sum(k) FROM h{lv} WHERE {open_} GROUP BY ALL),
o{lv} AS (
  SELECT *, row_number() OVER w AS pos, sum(n) OVER w AS ln, sum(k) OVER w AS lk,
         sum(n) OVER (PARTITION BY node, f) AS an, sum(k) OVER (PARTITION BY node, f) AS ak
  FROM c{lv} WINDOW w AS (PARTITION BY node, f ORDER BY k / n, v ROWS UNBOUNDED PRECEDING)),
g{lv} AS (SELECT *, CASE WHEN ln < an THEN {gini('an', 'ak')} - ln / an * {gini('ln', 'lk')} - (an - ln) / an * {gini('an - ln', 'ak - lk')} ELSE 0 END AS gain FROM o{lv}),
b{lv} AS (SELECT node, f, pos, gain, an FROM g{lv} WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, f, pos) = 1),
h{lv + 1} AS (
  SELECT h.*, CASE WHEN b.node IS NULL THEN h.a{lv} WHEN g.pos <= b.pos THEN 2 * h.a{lv} ELSE 2 * h.a{lv} + 1 END AS a{lv + 1}
  FROM h{lv} h LEFT JOIN b{lv} b ON b.node = h.a{lv}
  LEFT JOIN g{lv} g ON g.node = b.node AND g.f = b.f AND g.v = CASE b.f WHEN 'color' THEN h.color ELSE h.product END)""")
    leaf = f"(SELECT *, CASE WHEN 2 * sum(k) OVER (PARTITION BY a{depth}) > sum(n) OVER (PARTITION BY a{depth}) THEN 1 ELSE 0 END AS cls FROM h{depth})"
    nodes = " UNION ALL ".join(
        f"SELECT CAST(b.node AS INTEGER) AS node, CAST(b.an AS BIGINT) AS \"rows\", round(b.gain, 6) AS gain, TRUE AS best "
        f"FROM b{lv} b JOIN {leaf} x ON x.a{lv} = b.node GROUP BY b.node, b.an, b.gain HAVING count(DISTINCT cls) > 1" for lv in range(depth))
    return f"WITH {', '.join(ctes)} {nodes}"


def _lloyd() -> str:
    """Seeds and Lloyd steps over the histogram of the fitted scores, written
    out one by one."""
    cols = ("r_score", "f_score", "m_score")
    x = ("r", "f", "m")
    ctes = [f"s AS ({_fitted(_rfm_metrics(), {'recency': False, 'frequency': True, 'monetary': True})})",
            f"h AS (SELECT {', '.join(f'{c} AS {v}' for c, v in zip(cols, x))}, count(*) AS n FROM s GROUP BY {', '.join(cols)})"]
    sq = lambda a, b: " + ".join(f"({a}.{v} - {b}.{v}) * ({a}.{v} - {b}.{v})" for v in x)
    ctes.append("c0 AS (SELECT 0 AS i, r, f, m FROM h ORDER BY n DESC, r, f, m LIMIT 1)")
    for i in range(1, SEGMENTS):
        ctes.append(f"""c{i} AS (SELECT * FROM c{i - 1} UNION ALL SELECT {i}, r, f, m FROM (
  SELECT h.r, h.f, h.m, h.n * min({sq('h', 'c')}) AS far FROM h, c{i - 1} c GROUP BY h.r, h.f, h.m, h.n ORDER BY far DESC, h.r, h.f, h.m LIMIT 1))""")
    last = f"c{SEGMENTS - 1}"
    place = lambda c: (f"SELECT h.r, h.f, h.m, h.n, c.i FROM h, {c} c "  # noqa: E731
                       f"QUALIFY row_number() OVER (PARTITION BY h.r, h.f, h.m ORDER BY {sq('h', 'c')}, c.i) = 1")
    for t in range(LLOYD_STEPS + 1):
        ctes.append(f"p{t} AS MATERIALIZED ({place(last)})")
        if t < LLOYD_STEPS:
            means = ", ".join(f"CAST(sum({v} * n) AS DOUBLE) / sum(n) AS {v}" for v in x)
            ctes.append(f"l{t} AS MATERIALIZED (SELECT i, {means} FROM p{t} GROUP BY i)")
            last = f"l{t}"
    return (f"WITH {', '.join(ctes)} SELECT CAST(c.i AS INTEGER) AS prediction, c.r, c.f, c.m, CAST(sum(p.n) AS BIGINT) AS users, TRUE AS fixed "
            f"FROM {last} c JOIN p{LLOYD_STEPS} p ON p.i = c.i GROUP BY c.i, c.r, c.f, c.m")


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["delta_upsert"] = _profile()
    q["keyed_look_up"] = f"SELECT * FROM ({_profile()}) WHERE userId IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)"
    q["rfm_daily_state"] = f"""
SELECT o_custkey AS userId, CAST(datediff('day', CAST(max(o_orderdate) AS DATE), DATE '{OAS}') AS INTEGER) AS recency,
       count(o_orderkey) AS frequency, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(30,2)) AS DOUBLE) AS monetary
FROM orders WHERE o_orderdate < TIMESTAMP '{OAS}' AND o_orderdate >= TIMESTAMP '{OAS}' - INTERVAL {LOOKBACK} DAY GROUP BY o_custkey"""
    q["rfe_page_sketch"] = f"""
SELECT user_id AS userId, CAST(datediff('day', CAST(max(ts) AS DATE), DATE '{EAS}') AS INTEGER) AS recency,
       count(event_type || props) AS frequency, count(DISTINCT event_type || props) AS pages, TRUE AS within
FROM events WHERE ts < TIMESTAMP '{EAS}' AND ts >= TIMESTAMP '{EAS}' - INTERVAL {PAGE_WINDOW} DAY GROUP BY user_id"""
    q["rfm_fitted_scores"] = _fitted(_rfm_metrics(), {"recency": False, "frequency": True, "monetary": True})
    q["rfe_fitted_scores"] = _fitted(_rfe_metrics(), {"recency": False, "frequency": True, "engagements": True})
    shares = " UNION ALL ".join(f"SELECT CAST({i / 20} AS DOUBLE) AS share, quantile_disc(o_totalprice, {i / 20}) AS cut FROM orders" for i in range(1, 20))
    q["order_quantiles"] = (f"SELECT share, cut, count(*) AS orders FROM ({shares}) JOIN orders ON o_totalprice <= cut GROUP BY share, cut")
    q["spend_ranks"] = f"""
WITH v AS ({_rfm_metrics()})
SELECT userId, monetary, rank() OVER (ORDER BY monetary DESC) AS "rank",
       rank() OVER (ORDER BY monetary DESC) <= ceil(0.1 * (SELECT count(*) FROM v)) AS is_top FROM v"""
    q["ordered_users"] = """
SELECT c_custkey, c_mktsegment, c_acctbal, row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS position FROM customer"""
    q["heavy_parts"] = f"SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT {TOP_PARTS}"
    train = f"SELECT label, len(embedding) AS dims FROM embeddings WHERE {_hash_pct('CAST(vec_id AS VARCHAR)', 1)} < 80 AND label IS NOT NULL"
    facts = f"""(SELECT CAST(sum(n) AS BIGINT) AS "rows", count(*) AS classes, CAST(max(dims) AS INTEGER) AS features,
       round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) AS constant_loss FROM (SELECT label, count(*) AS n, max(dims) AS dims FROM ({train}) GROUP BY label))"""
    q["logreg_certificate"] = (f"SELECT 'reference' AS setting, *, TRUE AS optimal, FALSE AS beats_constant FROM {facts} "
                               f"UNION ALL SELECT 'light', *, TRUE, TRUE FROM {facts}")
    q["tree_certificate"] = _grown_tree()
    q["kmeans_centers"] = _lloyd()
    fold = f"CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8)) AS BIGINT) % {FOLDS}"
    q["tuning_folds"] = f"""
WITH i AS (SELECT label, CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS l FROM embeddings WHERE label IS NOT NULL GROUP BY label)
SELECT CAST(c.candidate AS INTEGER) AS candidate, CAST({fold} AS INTEGER) AS fold, i.l, count(*) AS "rows", TRUE AS best_chosen
FROM embeddings e JOIN i USING (label), (SELECT unnest(range({len(TUNED)})) AS candidate) c GROUP BY ALL"""
    return q


STATE_ORACLES = oracles()
