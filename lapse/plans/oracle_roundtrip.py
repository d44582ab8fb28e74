"""DuckDB texts of the round-trip queries; isotonic regression by its max-min formula."""

from __future__ import annotations

from ..config import WINDOWS, Windows
from .oracle import LABEL_CHAIN, with_
from .oracle_eval import _sc_cte

_TWO = """,
two AS (SELECT 'fine' AS model, y, p FROM sc WHERE p IS NOT NULL
        UNION ALL SELECT 'coarse', y, floor(p * 10) / 10.0 FROM sc WHERE p IS NOT NULL),
r AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY p) + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0 AS avg_rank FROM two),
k AS (SELECT model, sum(avg_rank) FILTER (WHERE y = 1) AS s, count(*) FILTER (WHERE y = 1) AS np,
             count(*) FILTER (WHERE y = 0) AS nn FROM r GROUP BY model),
runs AS (SELECT model AS run_name, 'test_roc_auc' AS metric,
                CASE WHEN np > 0 AND nn > 0 THEN (s - np * (np + 1) / 2.0) / (CAST(np AS DOUBLE) * CAST(nn AS DOUBLE)) END AS value,
                '{"scores": "p"}' AS params FROM k)"""

# value at i: the largest over j <= i of the smallest over k >= i of the mean label of places j to k
_ISOTONIC = """,
d AS (SELECT p, sum(y) AS ones, count(*) AS n, row_number() OVER (ORDER BY p) AS i FROM sc WHERE p IS NOT NULL GROUP BY p),
s AS (SELECT i, p, sum(ones) OVER (ORDER BY i) AS so, sum(n) OVER (ORDER BY i) AS sn, ones, n FROM d),
jk AS (SELECT j.i AS j, k.i AS k, CAST(k.so - j.so + j.ones AS DOUBLE) / CAST(k.sn - j.sn + j.n AS DOUBLE) AS m
       FROM s j JOIN s k ON k.i >= j.i),
low AS (SELECT j, k AS i, min(m) OVER (PARTITION BY j ORDER BY k DESC) AS g FROM jk),
iso AS (SELECT i, max(g) AS v FROM low GROUP BY i),
cal AS (SELECT sc.account_id, sc.y, sc.p, iso.v FROM sc LEFT JOIN s ON s.p = sc.p LEFT JOIN iso ON iso.i = s.i)"""


def roundtrip_sql(w: Windows = WINDOWS) -> dict[str, str]:
    sc = with_(*LABEL_CHAIN, w=w) + _sc_cte()
    return {
        "scan_delimited": """
SELECT c_custkey AS account_id, c_name || '; "' || CAST(c_custkey AS VARCHAR) || '"' AS name,
       CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal, c_mktsegment AS segment FROM customer""",
        "scan_comma": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
        "rewrite_by_year": """
SELECT o_orderkey AS order_id, o_custkey AS account_id, CAST(o_orderdate AS DATE) AS date_parsed, o_orderstatus AS status,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders WHERE year(o_orderdate) = 1998""",
        "rewrite_by_account": """
SELECT c_custkey AS account_id, c_mktsegment AS segment, count(o_orderkey) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount_sum, max(CAST(o_orderdate AS DATE)) AS last_date
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
        "sink_roundtrip": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
        "runs_roundtrip": sc + _TWO + "\nSELECT run_name, metric, value, params FROM runs",
        "best_of_two": sc + _TWO + """
SELECT run_name AS best_run, value AS roc_auc FROM runs ORDER BY value DESC, run_name DESC LIMIT 1""",
        "isotonic_scores": sc + _ISOTONIC + """
SELECT account_id, round(v, 8) AS calibrated,
       CASE WHEN v IS NULL THEN NULL WHEN round(v, 8) >= 0.2 THEN 'High' WHEN round(v, 8) >= 0.1 THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM cal""",
        "isotonic_gain": sc + _ISOTONIC + """
SELECT 'raw' AS scores, round(avg(power(p - y, 2)), 8) AS brier FROM cal
UNION ALL SELECT 'calibrated', round(avg(power(v - y, 2)), 8) FROM cal""",
    }
