"""Ranking metrics from (score, label) without a global sort of raw rows.

``score_curve`` reduces the rows to distinct scores per group (map-side
combined) and adds cumulative positive / negative counts in descending score
order by running totals over range partitions (``operators.prefix``).  Ties are
pooled before ranking, so a score held by a third of all rows is a single row
here.  AUC, average precision, ROC and PR points are all exact.

Rows without a score or label (NULL or NaN) take no part in any metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .prefix import running_totals


def score_curve(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows (groups, s, pos, neg, tp, fp, P, N): tp/fp count rows with
    score >= this score; P/N are group totals."""
    g = list(group_cols)
    y = F.col(label).cast("long")
    d = (df.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull())
           .groupBy(*g, F.col(score).cast("double").alias("s"))
           .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))
    run = running_totals(d, g, "s", ["pos", "neg"], descending=True)
    return run.select(*g, "s", "pos", "neg", F.col("pos_run").alias("tp"), F.col("neg_run").alias("fp"),
                      F.col("pos_all").alias("P"), F.col("neg_all").alias("N"))


def auc_from_curve(curve: DataFrame, group_cols: Sequence[str] = (), alias: str = "roc_auc") -> DataFrame:
    """Mann-Whitney AUC with ties counted 1/2, from integer sums (exact: a product of
    two counts can pass the range of LONG, so it is DECIMAL)."""
    g = list(group_cols)
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    twice = (wide("tp") + wide("tp") - wide("pos")).cast("decimal(19,0)")
    num = F.sum((wide("neg") * twice).cast("decimal(38,0)"))
    agg = curve.groupBy(*g).agg(num.alias("_num"), F.first("P").alias("_P"), F.first("N").alias("_N"))
    den = F.lit(2.0) * F.col("_P").cast("double") * F.col("_N").cast("double")
    return agg.select(*g, F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                                 F.col("_num").cast("double") / den).alias(alias))


def ap_from_curve(curve: DataFrame, group_cols: Sequence[str] = (), alias: str = "average_precision",
                  digits: int = 10) -> DataFrame:
    """Step-wise average precision: sum over thresholds of dRecall * precision."""
    g = list(group_cols)
    term = F.col("pos").cast("double") / F.col("P").cast("double") * (
        F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double"))
    return (curve.where(F.col("P") > 0).groupBy(*g)
                 .agg(F.round(F.sum(term), digits).alias(alias)))


def roc_auc(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return auc_from_curve(score_curve(df, score, label, group_cols), group_cols)


def corners(curve: DataFrame) -> DataFrame:
    """The points of an ungrouped ``score_curve`` at which its direction changes, and the last one.

    A point between two steps of one direction lies on the line of its
    neighbours, so leaving it out changes neither the curve nor its area.
    Directions are compared as whole-number products.  A point's next step is
    the one that starts at its count of rows: a join on a number that is unique
    on either side, whatever the partitions.
    """
    c = materialize(curve, "curve")
    step = c.select((F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")).alias("_start"),
                    F.col("pos").alias("_pos"), F.col("neg").alias("_neg"))
    wide = lambda x: F.col(x).cast("decimal(19,0)")
    straight = F.coalesce(wide("pos") * wide("_neg") == wide("_pos") * wide("neg"), F.lit(False))
    return (c.join(step, F.col("tp") + F.col("fp") == F.col("_start"), "left").where(~straight).select(*c.columns))
