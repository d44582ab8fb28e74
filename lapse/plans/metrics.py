"""Evaluation operators (V1-V11, A18, F-C1, T2, M2, M10 linear) over a scored
frame (key, y, p).  All are aggregates; the curve metrics go through the
distinct-score prefix sum of ``operators.curves``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SWEEP_THRESHOLDS, WINDOWS, Windows
from ..functions.columns import is_score, risk_tier, round_prob
from ..operators.curves import ap_from_curve, auc_from_curve, corners, score_curve
from ..operators.quantile import quantile_array
from ..session import materialize
from .dataset import scored_table, split_frame
from .features import feature_table

CONFUSION_THRESHOLDS = (0.10, 0.15, 0.20, 0.30, 0.50)
CALIBRATION_BINS = 10
METRIC_DIGITS = 10


def _sc(spark, sf_dir, w, reused: bool = True):
    return scored_table(spark, sf_dir, w, reused)


# --- tiers -----------------------------------------------------------------

def tiers(sc: DataFrame, p: str = "p") -> DataFrame:
    return sc.withColumn("risk_tier", risk_tier(p)).withColumn("p_rounded", round_prob(p))


def risk_tiers(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """F-C1 + F-M6: tier on the unrounded p, output p rounded half-even."""
    return tiers(_sc(spark, sf_dir, w, reused=False)).select("account_id", "y", "p", "p_rounded", "risk_tier")


def tier_summary(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Per tier n, positives, actual rate."""
    t = tiers(_sc(spark, sf_dir, w, reused=False))
    return (t.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"))
             .withColumn("rate", F.col("positives") / F.col("n")))


# --- threshold tables (conditional aggregation, no cross join) ----------------

def sweep(sc: DataFrame, thresholds: Sequence[float] = SWEEP_THRESHOLDS, p: str = "p", y: str = "y") -> DataFrame:
    """Per threshold flagged, positives among flagged, rate, captured share (of the
    scored positives); rows without a score are counted apart."""
    aggs = [F.sum(F.when(is_score(p), F.col(y).cast("long"))).alias("_P"), F.count_if(~is_score(p)).alias("_U")]
    for i, t in enumerate(thresholds):
        hit = is_score(p) & (F.col(p) >= F.lit(t))
        aggs += [F.count(F.when(hit, 1)).alias(f"f{i}"), F.sum(F.when(hit, F.col(y).cast("long"))).alias(f"t{i}")]
    wide = sc.agg(*aggs)
    long = wide.select("_P", "_U", F.explode(F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"f{i}").alias("flagged"),
                 F.coalesce(F.col(f"t{i}"), F.lit(0)).alias("positives"))
        for i, t in enumerate(thresholds)])).alias("r")).select("_P", "_U", "r.*")
    return long.select("threshold", "flagged", "positives",
                       F.try_divide(F.col("positives").cast("double"), F.col("flagged").cast("double")).alias("rate"),
                       F.try_divide(F.col("positives").cast("double"), F.col("_P").cast("double")).alias("captured"),
                       F.col("_U").alias("unscored"))


def threshold_sweep(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    return sweep(_sc(spark, sf_dir, w, reused=False))


def confusion(sc: DataFrame, thresholds: Sequence[float] = CONFUSION_THRESHOLDS, p: str = "p",
              y: str = "y") -> DataFrame:
    """V4: the full grid (zero cells included) per threshold, long form; rows without a
    score have a NULL prediction."""
    aggs = []
    cells = []
    for i, t in enumerate(thresholds):
        pred = F.when(is_score(p), (F.col(p) >= F.lit(t)).cast("int"))
        for a in (0, 1):
            for b in (0, 1, None):
                name = f"c{i}_{a}{b}"
                aggs.append(F.count(F.when((F.col(y) == a) & pred.eqNullSafe(F.lit(b)), 1)).alias(name))
                cells.append(F.struct(F.lit(t).alias("threshold"), F.lit(a).alias("actual"),
                                      F.lit(b).cast("int").alias("predicted"), F.col(name).alias("n")))
    return sc.agg(*aggs).select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def confusion_matrix(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    return confusion(_sc(spark, sf_dir, w, reused=False))


def report(sc: DataFrame, threshold: float = 0.5, p: str = "p", y: str = "y",
           digits: int = METRIC_DIGITS) -> DataFrame:
    """V3 + V5: precision / recall / f1 / support per class, accuracy, macro and
    weighted averages, and how many rows have no score; zero division gives 0."""
    pred = F.when(is_score(p), (F.col(p) >= F.lit(threshold)).cast("int"))
    c = sc.agg(*[F.count(F.when((F.col(y) == a) & (pred == b), 1)).alias(f"c{a}{b}")
                 for a in (0, 1) for b in (0, 1)], F.count_if(~is_score(p)).alias("unscored"))

    def dv(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp1, fp1, fn1, tn1 = F.col("c11"), F.col("c01"), F.col("c10"), F.col("c00")
    p1, r1 = dv(tp1, tp1 + fp1), dv(tp1, tp1 + fn1)
    p0, r0 = dv(tn1, tn1 + fn1), dv(tn1, tn1 + fp1)
    s1, s0 = tp1 + fn1, tn1 + fp1
    c2 = c.select("*", p1.alias("p1"), r1.alias("r1"), p0.alias("p0"), r0.alias("r0"),
                  s1.alias("s1"), s0.alias("s0"))
    f = lambda pp, rr: dv(F.lit(2.0) * F.col(pp) * F.col(rr), F.col(pp) + F.col(rr))
    c3 = c2.select("*", f("p1", "r1").alias("f1"), f("p0", "r0").alias("f0"),
                   (F.col("s0") + F.col("s1")).alias("n"))
    wavg = lambda a, b: dv(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("n"))
    rows = [
        ("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        ("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"),
         dv(F.col("c00") + F.col("c11"), F.col("n")), F.col("n")),
        ("macro avg", (F.col("p0") + F.col("p1")) / 2, (F.col("r0") + F.col("r1")) / 2,
         (F.col("f0") + F.col("f1")) / 2, F.col("n")),
        ("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), F.col("n")),
        ("unscored", F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("double"), F.col("unscored")),
    ]
    arr = F.array(*[F.struct(F.lit(k).alias("label"), F.round(a, digits).alias("precision"),
                             F.round(b, digits).alias("recall"), F.round(cc, digits).alias("f1"),
                             d.cast("long").alias("support")) for k, a, b, cc, d in rows])
    return c3.select(F.explode(arr).alias("r")).select("r.*")


def classification_report(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    return report(_sc(spark, sf_dir, w, reused=False))


# --- ranking metrics -------------------------------------------------------------

def unscored(sc: DataFrame, p: str = "p"):
    """Scalar: rows that no ranking metric can place (NULL or NaN score)."""
    return sc.agg(F.count_if(~is_score(p))).scalar()


def roc_auc(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """V1: exact AUC (ties 1/2) from the distinct-score curve."""
    sc = _sc(spark, sf_dir, w)
    return auc_from_curve(score_curve(sc, "p", "y")).withColumn("unscored", unscored(sc))


def average_precision(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """V2: step-wise average precision (not MLlib's trapezoidal areaUnderPR)."""
    sc = _sc(spark, sf_dir, w)
    return ap_from_curve(score_curve(sc, "p", "y")).withColumn("unscored", unscored(sc))


def roc_points_of(curve: DataFrame, digits: int = METRIC_DIGITS) -> DataFrame:
    pts = curve.select(F.col("s").alias("threshold"),
                       F.round(F.try_divide(F.col("fp"), F.col("N")), digits).alias("fpr"),
                       F.round(F.try_divide(F.col("tp"), F.col("P")), digits).alias("tpr"))
    start = curve.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                               F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_points_of(curve: DataFrame, digits: int = METRIC_DIGITS) -> DataFrame:
    pts = curve.select(F.col("s").alias("threshold"),
                       F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), digits).alias("precision"),
                       F.round(F.try_divide(F.col("tp"), F.col("P")), digits).alias("recall"))
    end = curve.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                             F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def roc_points(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """V6: (fpr, tpr) per distinct score, plus the (0, 0) start point."""
    return roc_points_of(score_curve(_sc(spark, sf_dir, w), "p", "y"))


def roc_points_reduced(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """V6 without the points that lie on a line with both neighbours."""
    return roc_points_of(corners(score_curve(_sc(spark, sf_dir, w), "p", "y")))


def pr_points(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """V7: (precision, recall) per distinct score, plus (recall 0, precision 1)."""
    return pr_points_of(score_curve(_sc(spark, sf_dir, w), "p", "y"))


# --- calibration -----------------------------------------------------------------

def brier_of(sc: DataFrame, p: str = "p", y: str = "y", digits: int = METRIC_DIGITS) -> DataFrame:
    sq = F.when(is_score(p), F.pow(F.col(p).cast("double") - F.col(y).cast("double"), 2))
    return sc.agg(F.round(F.avg(sq), digits).alias("brier"), F.count_if(~is_score(p)).alias("unscored"))


def brier(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """V9: mean squared error of the probability."""
    return brier_of(_sc(spark, sf_dir, w, reused=False))


def calibration_bins_of(sc: DataFrame, n_bins: int = CALIBRATION_BINS, p: str = "p", y: str = "y",
                        digits: int = METRIC_DIGITS) -> DataFrame:
    """V8: quantile bins; bin = number of inner edges strictly below p, NULL without a score."""
    edges = quantile_array(sc, p, [i / n_bins for i in range(1, n_bins)])
    # the edges are ONE scalar subquery projected as a column; the higher-order
    # function then reads the column (a subquery may not sit inside the lambda)
    b = (sc.withColumn("_edges", edges)
           .withColumn("bin", F.when(is_score(p), F.size(F.filter("_edges", lambda e: e < F.col(p)))))
           .drop("_edges"))
    return (b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.avg(F.when(is_score(p), F.col(p).cast("double"))), digits).alias("mean_p"),
                                 F.round(F.avg(F.col(y).cast("double")), digits).alias("frac_pos")))


def calibration_bins(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    return calibration_bins_of(_sc(spark, sf_dir, w))


# --- top-k, baseline, attribution ------------------------------------------------------

def topk_accounts(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, k: int = 10) -> DataFrame:
    """The k highest probabilities, key as tie-break (per-partition top-k, merged)."""
    sc = _sc(spark, sf_dir, w, reused=False).where(is_score("p"))
    return sc.orderBy(F.desc("p"), F.asc("account_id")).limit(k)


def baseline_majority(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """M2: majority class of the train fold predicted on the test fold."""
    s = split_frame(_sc(spark, sf_dir, w), label="y")
    train = s.where(F.col("fold") == "train")
    maj = train.agg(F.when(F.sum(F.col("y")) * 2 > F.count(F.lit(1)), F.lit(1)).otherwise(F.lit(0))).scalar()
    test = s.where(F.col("fold") == "test").withColumn("score", maj.cast("double"))
    auc = auc_from_curve(score_curve(test, "score", "y")).scalar()
    return test.agg(F.count(F.lit(1)).alias("n"), F.first(maj).alias("majority_class"),
                    F.avg((F.col("y") == maj).cast("double")).alias("accuracy")).withColumn("roc_auc", auc)


ATTRIBUTION_WEIGHTS = {
    "tx_count": 0.02, "tx_amount_mean": 0.00001, "balance_mean": 0.00001, "tenure_days": 0.001,
    "has_loan": 0.5, "has_card": 0.3, "n_orders": 0.05,
}


def linear_attribution(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS,
                       weights: dict | None = None, digits: int = 8) -> DataFrame:
    """M10 (re-aimed): mean |w * (x - mean(x))| per feature for a linear scorer."""
    weights = weights or ATTRIBUTION_WEIGHTS
    cols = list(weights)
    # read twice (means, then deviations): one written frame of the weighted columns
    ft = materialize(feature_table(spark, sf_dir, w).select(*[F.col(c).cast("double").alias(c) for c in cols]), "weighted")
    means = ft.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    wide = ft.withColumn("_m", means).agg(*[
        F.round(F.avg(F.abs(F.lit(float(weights[c])) * (F.col(c) - F.col("_m")[c]))), digits).alias(c) for c in cols])
    att = wide.unpivot([], cols, "feature", "importance")
    rk = Window.orderBy(F.desc("importance"), F.asc("feature"))      # one row per feature
    return att.withColumn("rank", F.row_number().over(rk).cast("long"))
