"""DuckDB texts for the feature, dataset, metric and audit queries."""

from __future__ import annotations

from ..config import STAND_IN, WINDOWS, Windows
from .oracle import LABEL_CHAIN, with_

SI = STAND_IN


def _feature_ctes(w: Windows, as_of: str | None = None) -> str:
    loan_cut = f" AND CAST(o_orderdate AS DATE) <= DATE '{as_of}'" if as_of else ""
    disp_cut = f" WHERE CAST(o_orderdate AS DATE) <= DATE '{as_of}'" if as_of else ""
    return f""",
loan_h AS (SELECT DISTINCT o_custkey AS account_id FROM orders
           WHERE o_orderpriority = '{SI.urgent_priority}'{loan_cut}),
card AS (SELECT l_orderkey AS disp_id FROM lineitem
         WHERE l_returnflag = '{SI.bridge_returnflag}' AND l_quantity >= {SI.bridge_min_quantity}),
disp AS (SELECT o_orderkey AS disp_id, o_custkey AS account_id FROM orders{disp_cut}),
card_h AS (SELECT DISTINCT account_id FROM disp WHERE disp_id IN (SELECT disp_id FROM card)),
ord AS (SELECT o_custkey AS account_id, count(o_orderkey) AS n_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount_sum
        FROM orders WHERE o_orderstatus = '{SI.standing_status}'{loan_cut} GROUP BY o_custkey),
supp AS (SELECT s_nationkey AS district_id, count(*) AS n_suppliers,
                CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(s_acctbal) AS DOUBLE) AS supp_acctbal_mean,
                min(s_acctbal) AS supp_acctbal_min, max(s_acctbal) AS supp_acctbal_max
         FROM supplier GROUP BY s_nationkey),
dist AS (SELECT n.n_nationkey AS district_id, n.n_name AS district_name, r.r_name AS region,
                n.n_regionkey AS region_id, s.n_suppliers, s.supp_acctbal_mean, s.supp_acctbal_min, s.supp_acctbal_max
         FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
         LEFT JOIN supp s ON s.district_id = n.n_nationkey),
acct AS (SELECT c_custkey AS account_id, c_nationkey AS district_id, c_mktsegment AS frequency FROM customer)"""


TX_COLS = """tx_count,
       CAST(obs_amt_sum AS DOUBLE) / CAST(obs_amt_n AS DOUBLE) AS tx_amount_mean,
       round(obs_amt_std, 6) AS tx_amount_std,
       CAST(obs_bal_sum AS DOUBLE) / CAST(obs_bal_n AS DOUBLE) AS balance_mean,
       CAST(obs_bal_min AS DOUBLE) AS balance_min,
       CAST(obs_bal_last AS DOUBLE) AS balance_last"""


def feature_table_sql(w: Windows = WINDOWS, as_of: str | None = None) -> str:
    return with_(*LABEL_CHAIN, w=w) + _feature_ctes(w, as_of) + f""",
txf AS (SELECT account_id, CAST(DATE '{w.obs_end_lit}' - open_date AS INTEGER) AS tenure_days, {TX_COLS}
        FROM elig)
SELECT l.account_id, a.district_id, a.frequency, t.tenure_days, t.tx_count, t.tx_amount_mean,
       coalesce(t.tx_amount_std, 0.0) AS tx_amount_std, t.balance_mean, t.balance_min, t.balance_last,
       CAST(t.tx_count AS DOUBLE) / (CAST(t.tenure_days AS DOUBLE) / 365.25) AS tx_count_per_year,
       CAST(l.account_id IN (SELECT account_id FROM loan_h) AS INTEGER) AS has_loan,
       CAST(l.account_id IN (SELECT account_id FROM card_h) AS INTEGER) AS has_card,
       coalesce(o.n_orders, 0) AS n_orders, coalesce(o.order_amount_sum, 0.0) AS order_amount_sum,
       d.district_name, d.region, d.region_id, d.n_suppliers, d.supp_acctbal_mean, d.supp_acctbal_min,
       d.supp_acctbal_max, l.churned
FROM label l
LEFT JOIN acct a ON a.account_id = l.account_id
LEFT JOIN txf t ON t.account_id = l.account_id
LEFT JOIN ord o ON o.account_id = l.account_id
LEFT JOIN dist d ON d.district_id = a.district_id"""


def feature_sql(w: Windows = WINDOWS) -> dict[str, str]:
    fe = _feature_ctes(w)
    fe_asof = _feature_ctes(w, w.obs_end_lit)
    return {
        "tx_features": with_("tx", "act", w=w) + f"SELECT account_id, {TX_COLS} FROM act WHERE tx_count > 0",
        "balance_last": with_("tx", "act", w=w)
        + "SELECT account_id, CAST(obs_bal_last AS DOUBLE) AS balance_last FROM act WHERE obs_bal_n > 0",
        "tenure_days": with_("tx", "act", "elig", w=w)
        + f"SELECT account_id, CAST(DATE '{w.obs_end_lit}' - open_date AS INTEGER) AS tenure_days FROM elig",
        "tx_rate": with_("tx", "act", "elig", w=w) + f"""
SELECT account_id, tx_count, tenure_days,
       CAST(tx_count AS DOUBLE) / (CAST(tenure_days AS DOUBLE) / 365.25) AS tx_count_per_year
FROM (SELECT account_id, tx_count, CAST(DATE '{w.obs_end_lit}' - open_date AS INTEGER) AS tenure_days FROM elig) e""",
        "semi_members": with_("tx", "act", "elig", w=w) + """
SELECT account_id, count(trans_id) AS n_tx, CAST(sum(amount) AS DOUBLE) AS amount_sum
FROM tx WHERE account_id IN (SELECT account_id FROM elig) GROUP BY account_id""",
        "standing_orders": "WITH x AS (SELECT 1)" + fe + "\nSELECT * FROM ord",
        "bridge_holders": "WITH x AS (SELECT 1)" + fe + "\nSELECT account_id FROM card_h",
        "product_flags": "WITH x AS (SELECT 1)" + fe + """
SELECT account_id,
       CAST(account_id IN (SELECT account_id FROM loan_h) AS INTEGER) AS has_loan,
       CAST(account_id IN (SELECT account_id FROM card_h) AS INTEGER) AS has_card
FROM acct""",
        "product_flags_asof_row": """
WITH tx AS (SELECT o_orderkey AS id, o_custkey AS account_id, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS priority FROM orders),
cut AS (SELECT c_custkey AS account_id, (SELECT min(d) FROM tx WHERE tx.account_id = c_custkey) + 365 AS cut_off FROM customer),
carded AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48),
loan AS (SELECT c.account_id, arg_max(id, (d, id)) AS id, max(d) AS d FROM cut c JOIN tx ON tx.account_id = c.account_id AND d <= cut_off
         WHERE priority = '1-URGENT' GROUP BY c.account_id),
card AS (SELECT c.account_id, arg_max(id, (d, id)) AS id, max(d) AS d FROM cut c JOIN tx ON tx.account_id = c.account_id AND d <= cut_off
         WHERE id IN (SELECT id FROM carded) GROUP BY c.account_id)
SELECT cut.account_id, cut_off, CAST(loan.id IS NOT NULL AS INTEGER) AS has_loan, loan.id AS last_loan_id, loan.d AS last_loan_date,
       CAST(card.id IS NOT NULL AS INTEGER) AS has_card, card.id AS last_card_disp, card.d AS last_card_date
FROM cut LEFT JOIN loan ON loan.account_id = cut.account_id LEFT JOIN card ON card.account_id = cut.account_id""",
        "product_flags_asof": "WITH x AS (SELECT 1)" + fe_asof + """
SELECT account_id,
       CAST(account_id IN (SELECT account_id FROM loan_h) AS INTEGER) AS has_loan,
       CAST(account_id IN (SELECT account_id FROM card_h) AS INTEGER) AS has_card
FROM acct""",
        "join_key_audit": "WITH x AS (SELECT 1)" + fe + """,
good AS (SELECT DISTINCT account_id FROM disp WHERE disp_id IN (SELECT disp_id FROM card)),
bad AS (SELECT DISTINCT account_id FROM disp WHERE account_id IN (SELECT disp_id FROM card))
SELECT (SELECT count(*) FROM good) AS n_right_path, (SELECT count(*) FROM bad) AS n_wrong_path,
       (SELECT count(*) FROM good WHERE account_id IN (SELECT account_id FROM bad)) AS n_overlap""",
        "dimension_enrich": "WITH x AS (SELECT 1)" + fe + """
SELECT a.district_id, a.account_id, a.frequency, d.district_name, d.region, d.region_id, d.n_suppliers,
       d.supp_acctbal_mean, d.supp_acctbal_min, d.supp_acctbal_max
FROM acct a LEFT JOIN dist d ON d.district_id = a.district_id""",
        "feature_table": feature_table_sql(w),
    }


def more_sql(w: Windows = WINDOWS) -> dict[str, str]:
    out = feature_sql(w)
    from . import oracle_eval
    out.update(oracle_eval.eval_sql(w))
    return out
