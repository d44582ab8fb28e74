"""Feature table (F1) and its parts: tx aggregates, flags, orders, dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import WINDOWS, Windows
from ..functions.columns import annual_rate, tenure_days as tenure_expr
from ..operators.asof import asof_join
from ..operators.membership import bridge_keys, existence_flag, key_audit, semi_members
from ..sources.tables import (accounts, cards, dispositions, districts, loans, standing_orders_src,
                              transactions)
from ..session import materialize
from .activity import account_activity, mean_of, money, until
from .labels import eligible_activity, labelled_activity

STD_DECIMALS = 6


def _tx_feature_cols():
    return [
        F.col("tx_count"),
        mean_of("obs_amt_sum", "obs_amt_n").alias("tx_amount_mean"),
        F.round(F.col("obs_amt_std"), STD_DECIMALS).alias("tx_amount_std"),
        mean_of("obs_bal_sum", "obs_bal_n").alias("balance_mean"),
        money("obs_bal_min").alias("balance_min"),
        money("obs_bal_last").alias("balance_last"),
    ]


def tx_features(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """A2: per account with observation-window activity."""
    act = account_activity(until(transactions(spark, sf_dir), w.obs_end_lit), w)
    return act.where(F.col("tx_count") > 0).select("account_id", *_tx_feature_cols())


def balance_last(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """A3: balance of the latest (d, trans_id) row up to obs_end, nulls skipped."""
    act = account_activity(until(transactions(spark, sf_dir), w.obs_end_lit), w)
    return (act.where(F.col("obs_bal_n") > 0)
               .select("account_id", money("obs_bal_last").alias("balance_last")))


def tenure_days(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """F-D4: days from the open date to obs_end, eligible accounts."""
    act = eligible_activity(spark, sf_dir, w)
    return act.select("account_id", tenure_expr("open_date", w.obs_end_lit).alias("tenure_days"))


def tx_rate(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """F-M3: observation-window count per year of tenure."""
    act = eligible_activity(spark, sf_dir, w)
    t = tenure_expr("open_date", w.obs_end_lit)
    return act.select("account_id", F.col("tx_count"), t.alias("tenure_days"),
                      annual_rate("tx_count", t).alias("tx_count_per_year"))


def semi_members_query(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Transactions of eligible accounts only, count and sum per account."""
    tx = transactions(spark, sf_dir)
    members = eligible_activity(spark, sf_dir, w).select("account_id")
    # aggregate before the semi join: a hot account is one row when it is joined
    per_account = tx.groupBy("account_id").agg(F.count("trans_id").alias("n_tx"),
                                                (F.sum("amount_cents").cast("double") / 100.0).alias("amount_sum"))
    return semi_members(per_account, members, "account_id")


def product_flag_rates(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Cohort share of each product flag over the labelled accounts."""
    ft = feature_table(spark, sf_dir, w)
    return ft.agg(F.count(F.lit(1)).alias("n_accounts"),
                  F.sum("has_loan").cast("long").alias("n_loan"), F.avg("has_loan").alias("loan_rate"),
                  F.sum("has_card").cast("long").alias("n_card"), F.avg("has_card").alias("card_rate"))


def product_aggregates(as_of: str | None) -> tuple:
    """Loan flag and standing orders as aggregates of the transaction rows (they are the
    same table), up to ``as_of`` if given; NULL where there are no standing orders."""
    seen = F.lit(True) if as_of is None else F.col("d") <= F.lit(as_of).cast("date")
    standing = seen & F.col("is_standing")
    return (F.max(F.when(seen & F.col("is_loan"), 1).otherwise(0)).alias("has_loan"),
            F.nullif(F.count(F.when(standing, F.col("trans_id"))), F.lit(0)).alias("n_orders"),
            F.sum(F.when(standing, F.col("amount"))).cast("double").alias("order_amount_sum"))


def standing_orders(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """A5: count and sum of standing (open-status) orders per account."""
    o = standing_orders_src(spark, sf_dir)
    return o.groupBy("account_id").agg(F.count("order_id").alias("n_orders"),
                                       F.sum("amount").cast("double").alias("order_amount_sum"))


def card_holders(spark: SparkSession, sf_dir: str, as_of: str | None = None) -> DataFrame:
    c, dsp = cards(spark, sf_dir), dispositions(spark, sf_dir)
    if as_of is not None:
        dsp = dsp.where(F.col("d") <= F.lit(as_of).cast("date"))
    return bridge_keys(c, dsp, "disp_id", "disp_id", "account_id")


def loan_holders(spark: SparkSession, sf_dir: str, as_of: str | None = None) -> DataFrame:
    ln = loans(spark, sf_dir)
    if as_of is not None:
        ln = ln.where(F.col("d") <= F.lit(as_of).cast("date"))
    return ln.select("account_id")


def bridge_holders(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Distinct accounts reached from qualifying cards through dispositions."""
    return card_holders(spark, sf_dir)


def _flags(spine: DataFrame, spark: SparkSession, sf_dir: str, as_of: str | None) -> DataFrame:
    out = existence_flag(spine, loan_holders(spark, sf_dir, as_of), "account_id", "has_loan")
    return existence_flag(out, card_holders(spark, sf_dir, as_of), "account_id", "has_card")


def product_flags(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """has_loan / has_card over the account spine; dates ignored (parity)."""
    return _flags(accounts(spark, sf_dir).select("account_id"), spark, sf_dir, None)


def product_flags_asof(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """J8 with the point-in-time cut: only products dated up to obs_end count."""
    return _flags(accounts(spark, sf_dir).select("account_id"), spark, sf_dir, w.obs_end_lit)


ASOF_DAYS = 365         # an account's cut-off: so long after its first transaction


def product_flags_asof_row(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """J8 with a cut-off for each account: the last loan and card order up to it."""
    opened = account_activity(transactions(spark, sf_dir), w).select("account_id", F.date_add("open_date", ASOF_DAYS).alias("cut_off"))
    spine = accounts(spark, sf_dir).select("account_id").join(opened, "account_id", "left")
    carded = semi_members(dispositions(spark, sf_dir), cards(spark, sf_dir).select("disp_id"), "disp_id")
    out = asof_join(spine, loans(spark, sf_dir), "account_id", "cut_off", "d", {"loan_id": "last_loan_id", "d": "last_loan_date"}, ["loan_id"])
    out = asof_join(out, carded, "account_id", "cut_off", "d", {"disp_id": "last_card_disp", "d": "last_card_date"}, ["disp_id"])
    return out.select("account_id", "cut_off", F.col("last_loan_id").isNotNull().cast("int").alias("has_loan"), "last_loan_id", "last_loan_date",
                      F.col("last_card_disp").isNotNull().cast("int").alias("has_card"), "last_card_disp", "last_card_date")


def join_key_audit(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Right bridge path vs the mismatched-key path (account_id compared to disp_id)."""
    dsp = dispositions(spark, sf_dir)
    return key_audit(dsp, cards(spark, sf_dir), "disp_id", "disp_id", "account_id", "account_id")


def dimension_enrich(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Accounts left join the district dimension (one row per nation)."""
    return accounts(spark, sf_dir).join(districts(spark, sf_dir), "district_id", "left")


FEATURE_ORDER = [
    "account_id", "district_id", "frequency", "tenure_days", "tx_count", "tx_amount_mean",
    "tx_amount_std", "balance_mean", "balance_min", "balance_last", "tx_count_per_year",
    "has_loan", "has_card", "n_orders", "order_amount_sum", "district_name", "region", "region_id",
    "n_suppliers", "supp_acctbal_mean", "supp_acctbal_min", "supp_acctbal_max", "churned",
]


def feature_table(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, as_of: str | None = None,
                  label: DataFrame | None = None, fill: bool = True) -> DataFrame:
    """one row per valid (labelled) account.

    All per-account inputs are aggregated before joining, so every join is
    key-unique; the activity aggregate is shared by label and tx features.
    """
    # one activity aggregate feeds the label, the tx features, the loan flag and the standing orders
    act = materialize(eligible_activity(spark, sf_dir, w, product_aggregates(as_of), all_dates=as_of is None))
    t = tenure_expr("open_date", w.obs_end_lit)
    if label is None:
        # label columns computed on the activity rows themselves: no spine/tx join
        base = labelled_activity(act, w)
    else:
        base = label.select("account_id", "churned").join(act, "account_id", "left")
    txf = base.select("account_id", "churned", t.alias("tenure_days"), *_tx_feature_cols(),
                      F.coalesce("has_loan", F.lit(0)).alias("has_loan"), "n_orders", "order_amount_sum")
    txf = txf.withColumn("tx_count_per_year", annual_rate("tx_count", "tenure_days"))
    feat = txf.join(accounts(spark, sf_dir), "account_id", "left")
    feat = existence_flag(feat, card_holders(spark, sf_dir, as_of), "account_id", "has_card")
    feat = feat.join(districts(spark, sf_dir), "district_id", "left")
    if fill:
        # early fill; every other NULL is filled in the design matrix
        feat = feat.fillna({"n_orders": 0, "order_amount_sum": 0.0, "tx_amount_std": 0.0})
    return feat.select(*FEATURE_ORDER)
