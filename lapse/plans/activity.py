"""Per-account activity: every window statistic the labels and features need,
computed by ONE ``groupBy(account_id)`` over the transactions (one shuffle,
partial aggregation map-side), instead of one pass per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import WINDOWS, Windows
from ..functions.columns import between_dates, in_range


def account_activity(tx: DataFrame, w: Windows = WINDOWS, extra: tuple = ()) -> DataFrame:
    """tx(trans_id, account_id, d, amount_cents, balance_cents) -> one row per account.

    Money is summed as exact LONG cents; ``mean_of`` divides once as DOUBLE,
    which yields the same double as a DECIMAL sum cast to DOUBLE.  Columns are
    pruned by Catalyst when a consumer does not reference them.  ``extra`` adds
    aggregates of the same rows to the same pass.
    """
    d = F.col("d")
    obs = in_range(d, None, w.obs_end_lit)
    base = between_dates(d, w.base_start_lit, w.obs_end_lit)
    label = in_range(d, w.obs_end_lit, w.label_end_lit)
    bal, amt = F.col("balance_cents"), F.col("amount_cents")
    obs_bal = F.when(obs & bal.isNotNull(), bal)
    return tx.groupBy("account_id").agg(
        F.min(d).alias("open_date"),
        F.max(d).alias("last_date"),
        # label windows
        F.sum(F.when(base, bal)).alias("base_bal_sum"),
        F.count(F.when(base, bal)).alias("base_bal_n"),
        F.sum(F.when(label, bal)).alias("label_bal_sum"),
        F.count(F.when(label, bal)).alias("label_bal_n"),
        F.count(F.when(base, F.col("trans_id"))).alias("base_tx_n"),
        F.count(F.when(label, F.col("trans_id"))).alias("label_tx_n"),
        # observation-window transaction features
        F.count(F.when(obs, F.col("trans_id"))).alias("tx_count"),
        F.sum(F.when(obs, amt)).alias("obs_amt_sum"),
        F.count(F.when(obs, amt)).alias("obs_amt_n"),
        F.stddev_samp(F.when(obs, amt.cast("double") / F.lit(100.0))).alias("obs_amt_std"),
        F.sum(obs_bal).alias("obs_bal_sum"),
        F.count(obs_bal).alias("obs_bal_n"),
        F.min(obs_bal).alias("obs_bal_min"),
        F.max_by(obs_bal, F.when(obs & bal.isNotNull(), day_and_id(d, F.col("trans_id")))).alias("obs_bal_last"),
        *extra,
    )


def day_and_id(d, trans_id):
    """(day, id) as one exact number that orders like the pair: a fixed-width key keeps the
    aggregate on hash tables (a struct key would sort every row)."""
    days = F.unix_date(d).cast("decimal(10,0)") * F.lit(str(2 ** 64)).cast("decimal(20,0)")
    return (days + trans_id.cast("decimal(20,0)")).cast("decimal(38,0)")


def until(tx: DataFrame, last_day: str) -> DataFrame:
    """Rows up to a day (the predicate reaches the Parquet scan)."""
    return tx.where(F.col("d") <= F.lit(last_day).cast("date"))


def mean_of(sum_col: str, n_col: str):
    """Mean of a cents sum: (cents / 100) is the exact-decimal value rounded once."""
    return F.try_divide(F.col(sum_col).cast("double") / F.lit(100.0), F.col(n_col).cast("double"))


def money(col: str):
    """Cents back to the DOUBLE nearest the decimal amount."""
    return F.col(col).cast("double") / F.lit(100.0)
