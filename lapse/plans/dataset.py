"""Dataset operators: splits (D1-D3), class weight (A17), design matrix (M1),
encoders (E1-E3), imputation (A16), alignment (P11), scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEED, TEST_PERCENT, VALIDATION_PERCENT, WINDOWS, Windows
from ..functions.columns import coerce_numeric, spread_score
from ..functions.encode import levels_of, one_hot_cols, standard_scale
from ..operators.quantile import quantile_cont
from ..operators.split import stratified_split
from ..sources.tables import customers_text, read_table
from ..session import materialize
from .activity import mean_of, money
from .features import feature_table
from .labels import churn_label, eligible_activity, labelled_activity

NON_FEATURES = ("account_id", "churned", "district_name", "region", "frequency", "fold")


def split_frame(df: DataFrame, key: str = "account_id", label: str = "churned",
                three_way: bool = False, seed: int = SEED) -> DataFrame:
    """D1 (+ D2): test = 20% per class; validation = 20% of the rest per class."""
    out = stratified_split(df, key, label, TEST_PERCENT, seed, "test", "train")
    if not three_way:
        return out
    # both branches read the first split: compute it (and its inputs) once
    out = materialize(out)
    test = out.where(F.col("fold") == "test")
    rest = stratified_split(out.where(F.col("fold") == "train").drop("fold"), key, label,
                            VALIDATION_PERCENT, seed + 1, "validation", "train")
    return test.unionByName(rest)


def stratified_split_q(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    lab = churn_label(spark, sf_dir, w).select("account_id", "churned")
    return split_frame(lab)


def stratified_split3_q(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    lab = churn_label(spark, sf_dir, w).select("account_id", "churned")
    return split_frame(lab, three_way=True)


def split_audit(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """D3: fold sizes and base rate per fold."""
    s = stratified_split3_q(spark, sf_dir, w)
    return (s.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("churned").alias("positives"))
             .withColumn("rate", F.col("positives") / F.col("n")))


def class_weight(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """floor(neg / pos) over the training part (everything but test)."""
    s = stratified_split_q(spark, sf_dir, w).where(F.col("fold") == "train")
    agg = s.agg(F.sum((F.col("churned") == 0).cast("long")).alias("neg"),
                F.sum((F.col("churned") == 1).cast("long")).alias("pos"))
    return agg.select("neg", "pos", F.floor(F.try_divide(F.col("neg"), F.col("pos"))).alias("scale_pos_weight"))


def design_matrix(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, ft: DataFrame | None = None,
                  levels: list[str] | None = None, point_in_time: bool = True) -> DataFrame:
    """M1: features as DOUBLE, NULL -> 0, frequency one-hot (all levels).

    Products and standing orders count up to the end of the observation window,
    so no later row leaks into a model.
    """
    # the levels and the matrix both read the feature table: compute it once
    ft = ft if ft is not None else materialize(
        feature_table(spark, sf_dir, w, as_of=w.obs_end_lit if point_in_time else None))
    levels = levels if levels is not None else levels_of(ft, "frequency")
    feats = [c for c in ft.columns if c not in NON_FEATURES]
    num = [F.coalesce(coerce_numeric(F.col(c).cast("string")) if dict(ft.dtypes)[c] == "string"
                      else F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats]
    dummies = one_hot_cols("frequency", levels, dtype="double")
    return ft.select("account_id", "churned", *num, *dummies)


def design_matrix_all_dates(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """M1 with products and standing orders of all dates (parity form, not used to fit)."""
    return design_matrix(spark, sf_dir, w, point_in_time=False)


def feature_columns(dm: DataFrame, exclude: tuple = ()) -> list[str]:
    """P10: feature columns by exclusion."""
    return [c for c in dm.columns if c not in NON_FEATURES and c not in exclude]


def one_hot(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, drop_first: bool = False) -> DataFrame:
    """E1 / E2 on the account segment."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"),
                                                     F.col("c_mktsegment").alias("frequency"))
    return c.select("account_id", *one_hot_cols("frequency", levels_of(c, "frequency"), drop_first=drop_first))


def one_hot_drop_first(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    return one_hot(spark, sf_dir, w, drop_first=True)


def _split_customers(spark: SparkSession, sf_dir: str, w: Windows) -> DataFrame:
    return stratified_split_q(spark, sf_dir, w)


def standard_scale_q(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Account balance scaled with train-fold mean / population std."""
    s = _split_customers(spark, sf_dir, w)
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"),
                                                     F.col("c_acctbal").alias("acctbal"))
    x = s.join(c, "account_id")
    out = standard_scale(x, ["acctbal"], x.where(F.col("fold") == "train"))
    return out.select("account_id", "fold", "acctbal_scaled")


def coerce_numeric_q(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """F-M1 + F-M2: sentinel text -> try_cast -> zero fill."""
    t = customers_text(spark, sf_dir)
    v = coerce_numeric(F.col("acctbal_text"))
    return t.select("account_id", v.isNull().cast("int").alias("was_invalid"),
                    F.coalesce(v, F.lit(0.0)).alias("acctbal"))


def median_impute(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """A16 + F-S4: '?' -> NULL, filled with the train-fold median (exact)."""
    s = _split_customers(spark, sf_dir, w)
    t = customers_text(spark, sf_dir).select(
        "account_id", coerce_numeric(F.nullif(F.col("acctbal_text"), F.lit("?"))).alias("acctbal"))
    x = materialize(s.join(t, "account_id"))
    med = quantile_cont(x.where(F.col("fold") == "train"), "acctbal", 0.5, alias="median").scalar()
    return x.select("account_id", "fold", F.coalesce(F.col("acctbal"), med).alias("acctbal"))


ALIGN_REQUIRED = ("tx_count", "balance_mean", "has_loan", "n_complaints", "has_insurance")


def align_features(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS,
                   required: tuple = ALIGN_REQUIRED) -> DataFrame:
    """Columns a model expects but the frame lacks are added as 0.0."""
    ft = feature_table(spark, sf_dir, w)
    have = set(ft.columns)
    cols = [F.col(c).cast("double").alias(c) if c in have else F.lit(0.0).alias(c) for c in required]
    return ft.select("account_id", *cols)


def scored_table(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, reused: bool = True) -> DataFrame:
    """(account_id, y, p): y = churn label; p = spread of mean/(mean+last), NULL for some accounts.

    ``reused``: the consumer reads the scores several times (curves, quantile
    bins, splits), so they are materialized once; single-pass consumers skip it.
    """
    act = materialize(eligible_activity(spark, sf_dir, w), "activity")
    # label and score columns come from the same activity rows: no join
    lab = labelled_activity(act, w)
    m, last = mean_of("obs_amt_sum", "obs_amt_n"), money("obs_bal_last")
    p = spread_score(F.try_divide(m, m + last), "account_id")
    sc = lab.select("account_id", F.col("churned").alias("y"), p.alias("p"))
    return materialize(sc, "scores") if reused else sc
