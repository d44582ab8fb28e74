"""Independent DuckDB SQL texts for the SQL-expressible queries.

Written directly from the operator definitions (SURVEY §10), not generated
from the Spark plans.  Tables are the driver's pre-registered views.
"""

from __future__ import annotations

from ..config import STAND_IN, WINDOWS, Windows


def _ctes(w: Windows = WINDOWS) -> dict[str, str]:
    obs_end, label_end, base_start = w.obs_end_lit, w.label_end_lit, w.base_start_lit
    base = f"d BETWEEN DATE '{base_start}' AND DATE '{obs_end}'"
    obs = f"d <= DATE '{obs_end}'"
    lab = f"d > DATE '{obs_end}' AND d <= DATE '{label_end}'"
    return {
        "tx": """tx AS (
  SELECT o_orderkey AS trans_id, o_custkey AS account_id, CAST(o_orderdate AS DATE) AS d,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_totalprice AS DECIMAL(18,2)) AS balance
  FROM orders)""",
        "act": f"""act AS (
  SELECT account_id, min(d) AS open_date, max(d) AS last_date,
    sum(balance) FILTER (WHERE {base}) AS base_bal_sum,
    count(balance) FILTER (WHERE {base}) AS base_bal_n,
    sum(balance) FILTER (WHERE {lab}) AS label_bal_sum,
    count(balance) FILTER (WHERE {lab}) AS label_bal_n,
    count(trans_id) FILTER (WHERE {base}) AS base_tx_n,
    count(trans_id) FILTER (WHERE {lab}) AS label_tx_n,
    count(trans_id) FILTER (WHERE {obs}) AS tx_count,
    sum(amount) FILTER (WHERE {obs}) AS obs_amt_sum,
    count(amount) FILTER (WHERE {obs}) AS obs_amt_n,
    stddev_samp(CAST(amount AS DOUBLE)) FILTER (WHERE {obs}) AS obs_amt_std,
    sum(balance) FILTER (WHERE {obs} AND balance IS NOT NULL) AS obs_bal_sum,
    count(balance) FILTER (WHERE {obs} AND balance IS NOT NULL) AS obs_bal_n,
    min(balance) FILTER (WHERE {obs} AND balance IS NOT NULL) AS obs_bal_min,
    arg_max(balance, (d, trans_id)) FILTER (WHERE {obs} AND balance IS NOT NULL) AS obs_bal_last
  FROM tx GROUP BY account_id)""",
        "elig": f"""elig AS (
  SELECT * FROM act
  WHERE open_date <= DATE '{obs_end}' - {w.min_tenure_days}
    AND account_id IN (SELECT c_custkey FROM customer))""",
        "valid": """valid AS (
  SELECT account_id, avg_balance_obs, avg_balance_label,
         avg_balance_label / avg_balance_obs AS balance_ratio
  FROM (SELECT account_id,
               CAST(base_bal_sum AS DOUBLE) / CAST(base_bal_n AS DOUBLE) AS avg_balance_obs,
               CAST(label_bal_sum AS DOUBLE) / CAST(label_bal_n AS DOUBLE) AS avg_balance_label
        FROM elig) m
  WHERE avg_balance_obs > 0)""",
        "thr": f"""thr AS (SELECT quantile_cont(balance_ratio, {w.churn_quantile}) AS threshold FROM valid)""",
        "label": """label AS (
  SELECT v.account_id, v.avg_balance_obs, v.avg_balance_label, v.balance_ratio,
         coalesce(CAST(v.balance_ratio <= t.threshold AS INTEGER), 0) AS churned
  FROM valid v CROSS JOIN thr t)""",
    }


def with_(*names: str, w: Windows = WINDOWS) -> str:
    c = _ctes(w)
    return "WITH " + ",\n".join(c[n] for n in names) + "\n"


LABEL_CHAIN = ("tx", "act", "elig", "valid", "thr", "label")


def label_sql(w: Windows = WINDOWS) -> dict[str, str]:
    hy = float(w.history_years)
    return {
        "window_split_counts": with_("tx", w=w) + f"""
SELECT count(*) FILTER (WHERE d <= DATE '{w.obs_end_lit}') AS n_obs,
       count(*) FILTER (WHERE d > DATE '{w.obs_end_lit}' AND d <= DATE '{w.label_end_lit}') AS n_label,
       count(*) FILTER (WHERE d > DATE '{w.label_end_lit}') AS n_after
FROM tx""",
        "eligible_accounts": with_("tx", "act", "elig", w=w) + "SELECT account_id, open_date FROM elig",
        "ratio_threshold": with_("tx", "act", "elig", "valid", "thr", w=w) + "SELECT threshold FROM thr",
        "churn_label": with_(*LABEL_CHAIN, w=w) + "SELECT * FROM label",
        "label_inactive": with_("tx", "act", "elig", w=w)
        + "SELECT account_id, CAST(label_tx_n = 0 AS INTEGER) AS churned FROM elig",
        "label_count_drop": with_("tx", "act", "elig", w=w) + f"""
SELECT account_id, CAST(tx_count AS DOUBLE) / {hy} AS tx_count_obs_avg_per_year,
       label_tx_n AS tx_count_label,
       coalesce(CAST(CAST(label_tx_n AS DOUBLE) < 0.2 * (CAST(tx_count AS DOUBLE) / {hy}) AS INTEGER), 0) AS churned
FROM elig""",
        "label_count_drop_lastyear": with_("tx", "act", "elig", w=w) + """
SELECT account_id, base_tx_n AS tx_count_base, label_tx_n AS tx_count_label,
       coalesce(CAST(CAST(label_tx_n AS DOUBLE) < 0.5 * CAST(base_tx_n AS DOUBLE) AS INTEGER), 0) AS churned
FROM elig""",
        "label_balance_drop": with_("tx", "act", "elig", w=w) + """
SELECT account_id, avg_balance_obs, avg_balance_label,
       coalesce(CAST(avg_balance_label < 0.3 * avg_balance_obs AS INTEGER), 0) AS churned
FROM (SELECT account_id,
             CAST(base_bal_sum AS DOUBLE) / CAST(base_bal_n AS DOUBLE) AS avg_balance_obs,
             CAST(label_bal_sum AS DOUBLE) / CAST(label_bal_n AS DOUBLE) AS avg_balance_label
      FROM elig) m""",
        "label_rule_rates": with_(*LABEL_CHAIN, w=w) + f""",
flags AS (
  SELECT CAST(label_tx_n = 0 AS INTEGER) AS inactive,
         coalesce(CAST(CAST(label_tx_n AS DOUBLE) < 0.2 * (CAST(tx_count AS DOUBLE) / {hy}) AS INTEGER), 0) AS count_drop,
         coalesce(CAST(CAST(label_tx_n AS DOUBLE) < 0.5 * CAST(base_tx_n AS DOUBLE) AS INTEGER), 0) AS count_drop_lastyear,
         coalesce(CAST(CAST(label_bal_sum AS DOUBLE) / CAST(label_bal_n AS DOUBLE)
                       < 0.3 * (CAST(base_bal_sum AS DOUBLE) / CAST(base_bal_n AS DOUBLE)) AS INTEGER), 0) AS balance_drop
  FROM elig),
long AS (
  SELECT 'inactive' AS rule, inactive AS churned FROM flags
  UNION ALL SELECT 'count_drop', count_drop FROM flags
  UNION ALL SELECT 'count_drop_lastyear', count_drop_lastyear FROM flags
  UNION ALL SELECT 'balance_drop', balance_drop FROM flags
  UNION ALL SELECT 'balance_ratio_decile', churned FROM label)
SELECT rule, count(*) AS n, CAST(sum(churned) AS BIGINT) AS positives, sum(churned) / count(*) AS rate
FROM long GROUP BY rule""",
        "label_distribution": with_(*LABEL_CHAIN, w=w) + """
SELECT churned, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
FROM label GROUP BY churned""",
        "last_activity_year": with_("tx", "act", w=w) + """
SELECT CAST(year(last_date) AS INTEGER) AS year, count(*) AS n_accounts FROM act GROUP BY year(last_date)""",
    }


def all_sql(w: Windows = WINDOWS) -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(label_sql(w))
    from . import oracle_more  # noqa: WPS433 (kept separate to keep this file readable)
    out.update(oracle_more.more_sql(w))
    from . import oracle_roundtrip
    out.update(oracle_roundtrip.roundtrip_sql(w))
    return out


__all__ = ["all_sql", "with_", "LABEL_CHAIN", "STAND_IN"]
