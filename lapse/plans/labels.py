"""Proxy churn labels (L1-L6), eligibility (P7), window audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import WINDOWS, Windows
from ..functions.columns import flag_le, flag_lt, in_range
from ..operators.quantile import quantile_cont
from ..session import materialize
from ..sources.tables import accounts, transactions
from .activity import account_activity, mean_of, until


def eligible_from(act: DataFrame, spine: DataFrame, w: Windows = WINDOWS) -> DataFrame:
    """Activity rows of spine accounts opened at least ``min_tenure_days`` before obs_end."""
    cut = F.date_sub(F.lit(w.obs_end_lit).cast("date"), w.min_tenure_days)
    return act.where(F.col("open_date") <= cut).join(spine.select("account_id"), "account_id", "left_semi")


def eligible_activity(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, extra: tuple = (),
                      all_dates: bool = False) -> DataFrame:
    # rows after the label window matter to no rule: the bound reaches the scan
    tx = transactions(spark, sf_dir)
    act = account_activity(tx if all_dates else until(tx, w.label_end_lit), w, extra)
    return eligible_from(act, accounts(spark, sf_dir), w)


def eligible_accounts(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    return eligible_activity(spark, sf_dir, w).select("account_id", "open_date")


def _ratio_frame(act: DataFrame) -> DataFrame:
    return (act.select(
                "account_id",
                mean_of("base_bal_sum", "base_bal_n").alias("avg_balance_obs"),
                mean_of("label_bal_sum", "label_bal_n").alias("avg_balance_label"))
               .where(F.col("avg_balance_obs") > 0)
               .withColumn("balance_ratio", F.try_divide(F.col("avg_balance_label"), F.col("avg_balance_obs"))))


def ratio_threshold_of(valid: DataFrame, w: Windows = WINDOWS, exact: bool = True) -> DataFrame:
    return quantile_cont(valid, "balance_ratio", w.churn_quantile, alias="threshold", exact=exact)


def churn_label(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, exact: bool = True,
                act: DataFrame | None = None) -> DataFrame:
    """Bottom-decile balance ratio (ties included), missing ratio -> not churned.

    The per-account ratios are checkpointed once: the quantile passes and
    the final flag read them instead of re-aggregating the transactions.
    """
    act = act if act is not None else eligible_activity(spark, sf_dir, w)
    return label_from(act, w, exact)


def labelled_activity(act: DataFrame, w: Windows = WINDOWS, exact: bool = True) -> DataFrame:
    """Activity rows of valid accounts with the label columns added in place
    (no join back to the activity: the threshold is a scalar subquery).
    ``act`` should be materialized: the quantile passes read it too."""
    obs = mean_of("base_bal_sum", "base_bal_n")
    lab = mean_of("label_bal_sum", "label_bal_n")
    valid = (act.withColumn("avg_balance_obs", obs).withColumn("avg_balance_label", lab)
                .where(F.col("avg_balance_obs") > 0)
                .withColumn("balance_ratio", F.try_divide(F.col("avg_balance_label"), F.col("avg_balance_obs"))))
    thr = ratio_threshold_of(valid, w, exact).scalar()
    return valid.withColumn("churned", flag_le("balance_ratio", thr))


def label_from(act: DataFrame, w: Windows = WINDOWS, exact: bool = True) -> DataFrame:
    """L5 on an eligible activity frame."""
    valid = materialize(_ratio_frame(act))
    # the threshold is a scalar subquery: computed once, no collect, no join
    thr = ratio_threshold_of(valid, w, exact).scalar()
    return valid.select("account_id", "avg_balance_obs", "avg_balance_label", "balance_ratio",
                        flag_le("balance_ratio", thr).alias("churned"))


def ratio_threshold(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    valid = materialize(_ratio_frame(eligible_activity(spark, sf_dir, w)))
    return ratio_threshold_of(valid, w)


def label_inactive(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """L1: no transaction in the label window."""
    act = eligible_activity(spark, sf_dir, w)
    return act.select("account_id", (F.col("label_tx_n") == 0).cast("int").alias("churned"))


def label_count_drop(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """L2: label-window count below 20% of the yearly mean over the history."""
    act = eligible_activity(spark, sf_dir, w)
    avg = F.col("tx_count").cast("double") / F.lit(float(w.history_years))
    return act.select(
        "account_id",
        avg.alias("tx_count_obs_avg_per_year"),
        F.col("label_tx_n").alias("tx_count_label"),
        flag_lt(F.col("label_tx_n").cast("double"), F.lit(0.2) * avg).alias("churned"))


def label_count_drop_lastyear(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """L3: label-window count below 50% of the base-year count."""
    act = eligible_activity(spark, sf_dir, w)
    return act.select(
        "account_id",
        F.col("base_tx_n").alias("tx_count_base"),
        F.col("label_tx_n").alias("tx_count_label"),
        flag_lt(F.col("label_tx_n").cast("double"),
                F.lit(0.5) * F.col("base_tx_n").cast("double")).alias("churned"))


def label_balance_drop(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """L4: label mean balance below 30% of the base-year mean; missing -> 0."""
    act = eligible_activity(spark, sf_dir, w)
    obs = mean_of("base_bal_sum", "base_bal_n")
    lab = mean_of("label_bal_sum", "label_bal_n")
    return act.select("account_id", obs.alias("avg_balance_obs"), lab.alias("avg_balance_label"),
                      flag_lt(lab, F.lit(0.3) * obs).alias("churned"))


def label_rule_rates(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Positive rate per rule, one row per rule.  One activity aggregate,
    materialized, feeds all five rules (the quantile rule in place)."""
    act = materialize(eligible_activity(spark, sf_dir, w), "activity")
    avg = F.col("tx_count").cast("double") / F.lit(float(w.history_years))
    obs = mean_of("base_bal_sum", "base_bal_n")
    lab = mean_of("label_bal_sum", "label_bal_n")
    flags = act.select(
        (F.col("label_tx_n") == 0).cast("int").alias("inactive"),
        flag_lt(F.col("label_tx_n").cast("double"), F.lit(0.2) * avg).alias("count_drop"),
        flag_lt(F.col("label_tx_n").cast("double"), F.lit(0.5) * F.col("base_tx_n").cast("double")).alias("count_drop_lastyear"),
        flag_lt(lab, F.lit(0.3) * obs).alias("balance_drop"))
    rules = ["inactive", "count_drop", "count_drop_lastyear", "balance_drop"]
    long = flags.unpivot([], rules, "rule", "churned")
    final = labelled_activity(act, w).select(F.lit("balance_ratio_decile").alias("rule"), "churned")
    return (long.unionByName(final).groupBy("rule")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("churned").alias("positives"))
                .withColumn("rate", F.col("positives") / F.col("n")))


def label_distribution(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Churned value, count and share (total from a one-row aggregate)."""
    lab = churn_label(spark, sf_dir, w)
    counts = lab.groupBy("churned").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("churned", "n", (F.col("n") / total).alias("share"))


def window_split_counts(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Rows up to obs_end, in the label window, after it."""
    tx = transactions(spark, sf_dir)
    d = F.col("d")
    return tx.agg(
        F.count(F.when(in_range(d, None, w.obs_end_lit), 1)).alias("n_obs"),
        F.count(F.when(in_range(d, w.obs_end_lit, w.label_end_lit), 1)).alias("n_label"),
        F.count(F.when(d > F.lit(w.label_end_lit).cast("date"), 1)).alias("n_after"))


def last_activity_year(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Year of each account's last transaction, histogram."""
    act = account_activity(transactions(spark, sf_dir), w)
    return (act.groupBy(F.year("last_date").alias("year"))
               .agg(F.count(F.lit(1)).alias("n_accounts")))
