"""DuckDB texts for cleaning, dataset, scoring and metric queries."""

from __future__ import annotations

from ..config import SEED, STAND_IN, SWEEP_THRESHOLDS, TEST_PERCENT, VALIDATION_PERCENT, WINDOWS, Windows
from .oracle import LABEL_CHAIN, with_

SI = STAND_IN
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CONFUSION_THRESHOLDS = (0.10, 0.15, 0.20, 0.30, 0.50)
ATTRIBUTION = (("tx_count", "0.02"), ("tx_amount_mean", "0.00001"), ("balance_mean", "0.00001"),
               ("tenure_days", "0.001"), ("has_loan", "0.5"), ("has_card", "0.3"), ("n_orders", "0.05"))
DM_FEATURES = ("district_id", "tenure_days", "tx_count", "tx_amount_mean", "tx_amount_std", "balance_mean",
               "balance_min", "balance_last", "tx_count_per_year", "has_loan", "has_card", "n_orders",
               "order_amount_sum", "region_id", "n_suppliers", "supp_acctbal_mean", "supp_acctbal_min",
               "supp_acctbal_max")


def _split_cte(src: str, key: str, y: str, name: str, salt: int, pct: int, held: str, rest: str,
               where: str = "") -> str:
    return f"""{name} AS (
  SELECT {key}, {y}, CASE WHEN r < (n_c * {pct} + 50) // 100 THEN '{held}' ELSE '{rest}' END AS fold
  FROM (SELECT {key}, {y},
               row_number() OVER (PARTITION BY {y} ORDER BY md5(CAST({key} AS VARCHAR) || '#{salt}'), {key}) - 1 AS r,
               count(*) OVER (PARTITION BY {y}) AS n_c
        FROM {src} {where}) z)"""


def _sc_cte() -> str:
    m = "(CAST(e.obs_amt_sum AS DOUBLE) / CAST(e.obs_amt_n AS DOUBLE))"
    return f""",
sc AS (
  SELECT account_id, y, CASE account_id % 101
      WHEN 0 THEN NULL WHEN 1 THEN 0.2e0 WHEN 2 THEN 0.1e0 WHEN 3 THEN 0.199999999999e0
      WHEN 4 THEN 0.099999999999e0 WHEN 5 THEN 0.59375e0 WHEN 6 THEN 0.00015e0 ELSE x * x * x END AS p
  FROM (SELECT l.account_id, l.churned AS y, ({m} / ({m} + CAST(e.obs_bal_last AS DOUBLE)) - 0.2e0) / 0.8e0 AS x
        FROM label l JOIN elig e ON e.account_id = l.account_id) q),
su AS (SELECT count(*) AS unscored FROM sc WHERE p IS NULL)"""


def _curve_cte() -> str:
    return """,
d AS (SELECT p AS s, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg FROM sc WHERE p IS NOT NULL GROUP BY p),
c AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
             sum(pos) OVER () AS "P", sum(neg) OVER () AS "N" FROM d)"""


def _thresholds(ts) -> str:
    return "(VALUES " + ", ".join(f"(CAST({t} AS DOUBLE))" for t in ts) + ")"


def eval_sql(w: Windows = WINDOWS) -> dict[str, str]:
    from .oracle_more import feature_table_sql
    lab = with_(*LABEL_CHAIN, w=w)
    split = ",\n" + _split_cte("label", "account_id", "churned", "split", SEED, TEST_PERCENT, "test", "train")
    split3 = split + ",\n" + _split_cte("split", "account_id", "churned", "split_b", SEED + 1,
                                        VALIDATION_PERCENT, "validation", "train", "WHERE fold = 'train'") + """,
split3 AS (SELECT * FROM split WHERE fold = 'test' UNION ALL SELECT * FROM split_b)"""
    sc = lab + _sc_cte()
    ctext = f"""ctext AS (SELECT c_custkey AS account_id,
       CASE WHEN c_custkey % {SI.sentinel_every} = 0 THEN '?' ELSE CAST(c_acctbal AS VARCHAR) END AS t FROM customer)"""
    ft = "WITH ft AS (" + feature_table_sql(w) + ")\n"
    ft_asof = "WITH ft AS (" + feature_table_sql(w, w.obs_end_lit) + ")\n"
    ft_raw = "WITH ft AS (" + feature_table_sql(w).replace("coalesce(t.tx_amount_std, 0.0)", "t.tx_amount_std") \
        .replace("coalesce(o.n_orders, 0)", "o.n_orders").replace("coalesce(o.order_amount_sum, 0.0)", "o.order_amount_sum") + ")\n"
    from .features import FEATURE_ORDER
    null_cols = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in FEATURE_ORDER)
    dm_cols = ",\n       ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in DM_FEATURES)
    oh = lambda levels, dt="INTEGER": ", ".join(
        f"coalesce(CAST(c_mktsegment = '{v}' AS {dt}), 0) AS frequency_{v}" for v in levels)
    oh_ft = ", ".join(f"coalesce(CAST(frequency = '{v}' AS DOUBLE), 0.0) AS frequency_{v}" for v in SEGMENTS)
    shapes = "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows, "
        f"(SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS n_cols FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"))
    lo, hi = w.history_start.isoformat(), w.label_end_lit
    audit = "\nUNION ALL ".join(
        f"SELECT '{name}' AS source, min(d) AS min_d, max(d) AS max_d, "
        f"count(*) FILTER (WHERE d < DATE '{lo}') AS n_before, count(*) FILTER (WHERE d > DATE '{hi}') AS n_after "
        f"FROM (SELECT CAST({col} AS DATE) AS d FROM {tab}) x"
        for name, tab, col in (("orders.o_orderdate", "orders", "o_orderdate"),
                               ("lineitem.l_shipdate", "lineitem", "l_shipdate")))
    sent = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} = '?') AS n_sentinel FROM t" for c in
        ("name", "segment", "acctbal_text", "nation_text"))
    edges = ", ".join(f"quantile_cont(p, {i / 10}) AS e{i}" for i in range(1, 10))
    binexpr = " + ".join(f"CAST(e{i} < p AS INTEGER)" for i in range(1, 10))
    cnt = lambda a, b, t: f"count(*) FILTER (WHERE y = {a} AND CAST(p >= {t} AS INTEGER) = {b})"
    long_att = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({v} AS DOUBLE) AS wt, CAST({c} AS DOUBLE) AS x FROM ft" for c, v in ATTRIBUTION)
    return {
        "product_flag_rates": ft + """
SELECT count(*) AS n_accounts, CAST(sum(has_loan) AS BIGINT) AS n_loan, avg(has_loan) AS loan_rate,
       CAST(sum(has_card) AS BIGINT) AS n_card, avg(has_card) AS card_rate FROM ft""",
        "scan_reject_nonnumeric": """
SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, CAST(n_regionkey AS INTEGER) AS n_regionkey FROM nation""",
        "json_record_parse": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
        "json_sample_row": "SELECT * FROM customer ORDER BY c_custkey LIMIT 1",
        "reject_incomplete": f"""
SELECT account_id, n_missing, missing FROM (
  SELECT c_custkey AS account_id,
         concat_ws(',', CASE WHEN c_nationkey IS NULL THEN 'district_id' END,
                   CASE WHEN (CASE WHEN c_custkey % {SI.incomplete_every} <> 0 THEN c_acctbal END) IS NULL THEN 'acctbal' END,
                   CASE WHEN c_mktsegment IS NULL THEN 'frequency' END) AS missing,
         CAST(c_nationkey IS NULL AS INTEGER)
         + CAST((CASE WHEN c_custkey % {SI.incomplete_every} <> 0 THEN c_acctbal END) IS NULL AS INTEGER)
         + CAST(c_mktsegment IS NULL AS INTEGER) AS n_missing
  FROM customer) r
WHERE n_missing > 0""",
        "parse_yymmdd": """
SELECT o_orderkey AS trans_id, strftime(CAST(o_orderdate AS DATE), '%y%m%d') AS yymmdd,
       CAST(try_strptime('19' || strftime(CAST(o_orderdate AS DATE), '%y%m%d'), '%Y%m%d') AS DATE) AS d_parsed
FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2000-01-01'""",
        "decode_birth_number": """
WITH b AS (
  SELECT c_custkey AS client_id,
         CAST(((c_custkey * 7) % 100) * 10000
              + (1 + c_custkey % 12 + CASE WHEN c_custkey % 2 = 1 THEN 50 ELSE 0 END) * 100
              + (1 + c_custkey % 28) AS INTEGER) AS birth_number
  FROM customer),
p AS (SELECT client_id, birth_number, birth_number // 10000 AS yy, (birth_number // 100) % 100 AS mm,
             birth_number % 100 AS dd FROM b)
SELECT client_id, birth_number, CASE WHEN mm > 50 THEN 'F' ELSE 'M' END AS gender,
       make_date(CAST(1900 + yy AS BIGINT), CAST(CASE WHEN mm > 50 THEN mm - 50 ELSE mm END AS BIGINT), CAST(dd AS BIGINT)) AS birth_date
FROM p""",
        "numeric_profile": lab + """,
lv AS (SELECT 'avg_balance_obs' AS "column", avg_balance_obs AS v FROM label
       UNION ALL SELECT 'balance_ratio', balance_ratio FROM label)
SELECT "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
       round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
       round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS max
FROM lv GROUP BY "column\"""",
        "null_census": ft_raw + f"""
SELECT "column", n_null FROM (UNPIVOT (SELECT {null_cols} FROM ft) ON COLUMNS(*) INTO NAME "column" VALUE n_null) u""",
        "sentinel_census": f"""
WITH t AS (
  SELECT c_name AS name, c_mktsegment AS segment,
         CASE WHEN c_custkey % {SI.sentinel_every} = 0 THEN '?' ELSE CAST(c_acctbal AS VARCHAR) END AS acctbal_text,
         CASE WHEN (c_custkey + 3) % {SI.sentinel_every} = 0 THEN '?' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_text
  FROM customer)
""" + sent,
        "table_shapes": shapes,
        "date_range_audit": audit,
        "align_features": ft + """
SELECT account_id, CAST(tx_count AS DOUBLE) AS tx_count, CAST(balance_mean AS DOUBLE) AS balance_mean,
       CAST(has_loan AS DOUBLE) AS has_loan, 0.0 AS n_complaints, 0.0 AS has_insurance FROM ft""",
        "coerce_numeric": f"WITH {ctext}\n" + """
SELECT account_id, CAST(TRY_CAST(t AS DOUBLE) IS NULL AS INTEGER) AS was_invalid,
       coalesce(TRY_CAST(t AS DOUBLE), 0.0) AS acctbal FROM ctext""",
        "median_impute": lab + split + f""",
{ctext},
x AS (SELECT s.account_id, s.fold, TRY_CAST(nullif(c.t, '?') AS DOUBLE) AS acctbal
      FROM split s JOIN ctext c ON c.account_id = s.account_id)
SELECT account_id, fold,
       coalesce(acctbal, (SELECT quantile_cont(acctbal, 0.5) FROM x WHERE fold = 'train')) AS acctbal FROM x""",
        "one_hot": f"SELECT c_custkey AS account_id, {oh(SEGMENTS)} FROM customer",
        "one_hot_drop_first": f"SELECT c_custkey AS account_id, {oh(SEGMENTS[1:])} FROM customer",
        "standard_scale": lab + split + """,
x AS (SELECT s.account_id, s.fold, c.c_acctbal AS acctbal FROM split s JOIN customer c ON c.c_custkey = s.account_id),
st AS (SELECT CAST(sum(CAST(acctbal AS DECIMAL(28,6))) AS DOUBLE) / CAST(count(acctbal) AS DOUBLE) AS m,
              stddev_pop(acctbal) AS sd FROM x WHERE fold = 'train')
SELECT account_id, fold, round((acctbal - m) / sd, 6) AS acctbal_scaled FROM x CROSS JOIN st""",
        "design_matrix": ft_asof + f"""
SELECT account_id, churned,
       {dm_cols},
       {oh_ft}
FROM ft""",
        "design_matrix_all_dates": ft + f"""
SELECT account_id, churned,
       {dm_cols},
       {oh_ft}
FROM ft""",
        "stratified_split": lab + split + "\nSELECT account_id, churned, fold FROM split",
        "stratified_split3": lab + split3 + "\nSELECT account_id, churned, fold FROM split3",
        "split_audit": lab + split3 + """
SELECT fold, count(*) AS n, CAST(sum(churned) AS BIGINT) AS positives, sum(churned) / count(*) AS rate
FROM split3 GROUP BY fold""",
        "class_weight": lab + split + """
SELECT neg, pos, CAST(floor(neg / pos) AS BIGINT) AS scale_pos_weight FROM (
  SELECT CAST(count(*) FILTER (WHERE churned = 0) AS BIGINT) AS neg,
         CAST(count(*) FILTER (WHERE churned = 1) AS BIGINT) AS pos
  FROM split WHERE fold = 'train') k""",
        "baseline_majority": sc + ",\n" + _split_cte("sc", "account_id", "y", "ss", SEED, TEST_PERCENT, "test", "train") + """,
maj AS (SELECT CASE WHEN sum(y) * 2 > count(*) THEN 1 ELSE 0 END AS m FROM ss WHERE fold = 'train')
SELECT count(*) AS n, (SELECT m FROM maj) AS majority_class,
       avg(CAST(y = (SELECT m FROM maj) AS DOUBLE)) AS accuracy,
       CASE WHEN count(*) FILTER (WHERE y = 1) > 0 AND count(*) FILTER (WHERE y = 0) > 0 THEN 0.5 END AS roc_auc
FROM ss WHERE fold = 'test'""",
        "risk_tiers": sc + """
SELECT account_id, y, p, round_even(p, 4) AS p_rounded,
       CASE WHEN p IS NULL OR isnan(p) THEN NULL WHEN p >= 0.2 THEN 'High' WHEN p >= 0.1 THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM sc""",
        "tier_summary": sc + """,
t AS (SELECT y, CASE WHEN p IS NULL OR isnan(p) THEN NULL WHEN p >= 0.2 THEN 'High' WHEN p >= 0.1 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM sc)
SELECT risk_tier, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, sum(y) / count(*) AS rate FROM t GROUP BY risk_tier""",
        "threshold_sweep": sc + f""",
th AS (SELECT * FROM {_thresholds(SWEEP_THRESHOLDS)} v(threshold))
SELECT th.threshold, count(sc.account_id) AS flagged, CAST(coalesce(sum(sc.y), 0) AS BIGINT) AS positives,
       CASE WHEN count(sc.account_id) > 0 THEN CAST(coalesce(sum(sc.y), 0) AS DOUBLE) / count(sc.account_id) END AS rate,
       CAST(coalesce(sum(sc.y), 0) AS DOUBLE) / (SELECT sum(y) FROM sc WHERE p IS NOT NULL) AS captured,
       (SELECT unscored FROM su) AS unscored
FROM th LEFT JOIN sc ON sc.p >= th.threshold GROUP BY th.threshold""",
        "roc_auc": sc + """,
r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS avg_rank FROM sc WHERE p IS NOT NULL),
k AS (SELECT sum(avg_rank) FILTER (WHERE y = 1) AS s, count(*) FILTER (WHERE y = 1) AS np,
             count(*) FILTER (WHERE y = 0) AS nn FROM r)
SELECT CASE WHEN np > 0 AND nn > 0 THEN (s - np * (np + 1) / 2.0) / (CAST(np AS DOUBLE) * CAST(nn AS DOUBLE)) END AS roc_auc,
       (SELECT unscored FROM su) AS unscored
FROM k""",
        "average_precision": sc + _curve_cte() + """
SELECT round(sum(CAST(pos AS DOUBLE) / "P" * (CAST(tp AS DOUBLE) / (tp + fp))), 10) AS average_precision,
       (SELECT unscored FROM su) AS unscored FROM c""",
        "brier": sc + "\nSELECT round(avg(power(p - y, 2)), 10) AS brier, count(*) FILTER (WHERE p IS NULL) AS unscored FROM sc",
        "roc_points": sc + _curve_cte() + """
SELECT s AS threshold, round(fp / "N", 10) AS fpr, round(tp / "P", 10) AS tpr FROM c
UNION ALL SELECT NULL, 0.0, 0.0""",
        "roc_points_reduced": sc + _curve_cte() + """,
n AS (SELECT *, lead(pos) OVER (ORDER BY s DESC) AS p2, lead(neg) OVER (ORDER BY s DESC) AS n2 FROM c)
SELECT s AS threshold, round(fp / "N", 10) AS fpr, round(tp / "P", 10) AS tpr FROM n WHERE p2 IS NULL OR pos * n2 <> p2 * neg
UNION ALL SELECT NULL, 0.0, 0.0""",
        "pr_points": sc + _curve_cte() + """
SELECT s AS threshold, round(tp / (tp + fp), 10) AS precision, round(tp / "P", 10) AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""",
        "confusion_matrix": sc + f""",
th AS (SELECT * FROM {_thresholds(CONFUSION_THRESHOLDS)} v(threshold)),
g AS (SELECT threshold, a.actual, b.predicted FROM th, (VALUES (0), (1)) a(actual), (VALUES (0), (1), (NULL)) b(predicted))
SELECT g.threshold, g.actual, g.predicted, count(sc.account_id) AS n
FROM g LEFT JOIN sc ON sc.y = g.actual AND CAST(sc.p >= g.threshold AS INTEGER) IS NOT DISTINCT FROM g.predicted
GROUP BY g.threshold, g.actual, g.predicted""",
        "classification_report": sc + f""",
k AS (SELECT {cnt(1, 1, 0.5)} AS tp, {cnt(0, 1, 0.5)} AS fp, {cnt(1, 0, 0.5)} AS fn, {cnt(0, 0, 0.5)} AS tn FROM sc),
m AS (SELECT *,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
        CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
        CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
        tp + fn AS s1, tn + fp AS s0, tp + fp + fn + tn AS n FROM k),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2.0 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
               CASE WHEN p0 + r0 > 0 THEN 2.0 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0 FROM m)
SELECT '0' AS label, round(p0, 10) AS precision, round(r0, 10) AS recall, round(f0, 10) AS f1, s0 AS support FROM f
UNION ALL SELECT '1', round(p1, 10), round(r1, 10), round(f1, 10), s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END, 10), n FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 10), round((r0 + r1) / 2, 10), round((f0 + f1) / 2, 10), n FROM f
UNION ALL SELECT 'weighted avg',
  round(CASE WHEN n > 0 THEN (p0 * s0 + p1 * s1) / n ELSE 0.0 END, 10),
  round(CASE WHEN n > 0 THEN (r0 * s0 + r1 * s1) / n ELSE 0.0 END, 10),
  round(CASE WHEN n > 0 THEN (f0 * s0 + f1 * s1) / n ELSE 0.0 END, 10), n FROM f
UNION ALL SELECT 'unscored', NULL, NULL, NULL, (SELECT unscored FROM su)""",
        "calibration_bins": sc + f""",
e AS (SELECT {edges} FROM sc),
b AS (SELECT sc.p, sc.y, CASE WHEN p IS NOT NULL THEN {binexpr} END AS bin FROM sc CROSS JOIN e)
SELECT bin, count(*) AS n, round(avg(p), 10) AS mean_p, round(avg(CAST(y AS DOUBLE)), 10) AS frac_pos
FROM b GROUP BY bin""",
        "topk_accounts": sc + "\nSELECT account_id, y, p FROM sc WHERE p IS NOT NULL ORDER BY p DESC, account_id LIMIT 10",
        "linear_attribution": ft + f""",
lv AS (
  {long_att}),
mv AS (SELECT feature, avg(x) AS mx FROM lv GROUP BY feature),
a AS (SELECT lv.feature, round(avg(abs(lv.wt * (lv.x - mv.mx))), 8) AS importance
      FROM lv JOIN mv ON mv.feature = lv.feature GROUP BY lv.feature)
SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM a""",
    }
