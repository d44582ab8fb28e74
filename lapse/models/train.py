"""Spark ML model operators.

The training frame (design matrix + fold) is checkpointed once; every fit
reads it.  Scores are evaluated with the exact distributed curve operators,
so model metrics are computed the same way as the SQL-checked metrics.
"""

from __future__ import annotations

import json
import os
import threading
import uuid
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..config import LEAKAGE_TOLERANCE, SEED, WINDOWS, Windows
from ..functions.columns import is_score, risk_tier, round_prob
from ..functions.encode import encoder_stage
from ..operators.curves import ap_from_curve, auc_from_curve, score_curve
from ..operators.isotonic import isotonic_blocks
from ..operators.prefix import running_totals
from ..plans.dataset import design_matrix, feature_columns, split_frame
from ..session import checkpoint_dir, materialize

LABEL = "churned"
LEAK_COLUMNS = ("has_card",)
ROWS_PER_TASK = 20_000              # training rows that are worth a task
MOST_ROWS_PER_TASK = 1_000_000


@dataclass
class ModelParams:
    forest_trees: int = 300
    forest_depth: int = 8
    gbt_iter: int = 500
    gbt_first: int = 64             # rounds of the first fit; a second one takes gbt_iter if the patience isn't used up
    gbt_patience: int = 20
    gbt_depth: int = 4
    gbt_step: float = 0.05
    gbt_subsample: float = 0.8
    gbt_feature_subset: str = "0.8"
    logreg_iter: int = 1000
    seed: int = SEED


PARAMS = ModelParams()


def training_frame(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Design matrix + fold (train / validation / test), checkpointed."""
    dm = materialize(design_matrix(spark, sf_dir, w))
    folds = split_frame(dm.select("account_id", LABEL), three_way=True).select("account_id", "fold")
    return materialize(dm.join(folds, "account_id"))


def spread_evenly(df: DataFrame, n: int) -> DataFrame:
    """``df`` of ``n`` rows in even partitions, one for each core while they hold few rows.

    Every level of every tree waits for the fullest partition.  A frame of up to
    ``ROWS_PER_TASK`` rows stays as it is.
    """
    if n <= ROWS_PER_TASK:
        return df
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    tasks = min(cores, -(-n // ROWS_PER_TASK))
    return df.repartition(tasks * -(-n // (tasks * MOST_ROWS_PER_TASK)))


def with_weights(df: DataFrame, fit_rows: DataFrame) -> DataFrame:
    """balanced = n / (2 n_class) (sklearn 'balanced'); boost = floor(neg/pos) for
    positives, 1 for negatives (scale_pos_weight).  Counts are one scalar subquery."""
    cnt = fit_rows.agg(F.struct(F.count(F.lit(1)).alias("n"),
                                F.sum(F.col(LABEL)).alias("pos"))).scalar()
    n, pos = cnt["n"].cast("double"), cnt["pos"].cast("double")
    neg = n - pos
    balanced = F.when(F.col(LABEL) == 1, n / (F.lit(2.0) * pos)).otherwise(n / (F.lit(2.0) * neg))
    boost = F.when(F.col(LABEL) == 1, F.floor(neg / pos).cast("double")).otherwise(F.lit(1.0))
    return df.withColumn("w_balanced", balanced).withColumn("w_boost", boost)


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def logreg(features: list[str], n_fit: int, p: ModelParams = PARAMS) -> Pipeline:
    """M3: sklearn's C=1 L2 objective is sum(w_i l_i) + |b|^2/2; MLlib divides the
    data term by sum(w) (= n for balanced weights), so regParam = 1 / n."""
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="w_balanced",
                            maxIter=p.logreg_iter, regParam=1.0 / max(n_fit, 1), elasticNetParam=0.0,
                            standardization=False)
    return Pipeline(stages=[assembler(features), lr])


def logreg_scaled(features: list[str], n_fit: int, p: ModelParams = PARAMS) -> Pipeline:
    """M3, the unweighted variant on standardized features."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    lr = LogisticRegression(featuresCol="scaled", labelCol=LABEL, maxIter=p.logreg_iter, regParam=1.0 / max(n_fit, 1),
                            elasticNetParam=0.0, standardization=False)
    return Pipeline(stages=[assembler(features), scaler, lr])


def forest(features: list[str], p: ModelParams = PARAMS) -> Pipeline:
    """M4: balanced random forest.  Each level reads the node of every row and tree from a cache
    instead of walking all trees from their roots again; the trees are the same."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=LABEL, weightCol="w_balanced",
                                numTrees=p.forest_trees, maxDepth=p.forest_depth, seed=p.seed, cacheNodeIds=True)
    return Pipeline(stages=[assembler(features), rf])


def gbt(features: list[str], p: ModelParams = PARAMS, rounds: int | None = None) -> Pipeline:
    """M5: weighted, subsampled boosting of a given number of rounds."""
    g = GBTClassifier(featuresCol="features", labelCol=LABEL, weightCol="w_boost", maxIter=rounds or p.gbt_iter,
                      maxDepth=p.gbt_depth, stepSize=p.gbt_step, subsamplingRate=p.gbt_subsample,
                      featureSubsetStrategy=p.gbt_feature_subset, seed=p.seed)
    return Pipeline(stages=[assembler(features), g])


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """(rounds up to the best loss before ``patience`` rounds without a better one, whether they ran out)."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_early_stopped(features: list[str], train: DataFrame, valid: DataFrame, p: ModelParams = PARAMS) -> PipelineModel:
    """Boosting stopped by the validation loss with patience.

    The first rounds of a longer fit are those of a shorter one (same seed), so
    a short fit, and one of ``gbt_iter`` rounds if the patience lasts, find the
    round that the long fit alone would, and the last fit is cut there.  At most
    ``gbt_first`` rounds are fitted twice.
    """
    rounds = min(p.gbt_first, p.gbt_iter)
    while True:
        model = gbt(features, p, rounds).fit(train)
        losses = model.stages[-1].evaluateEachIteration(model.stages[0].transform(valid))
        best, stopped = best_round(losses, p.gbt_patience)
        if stopped or rounds == p.gbt_iter:
            return truncated(train.sparkSession, model, best)
        rounds = p.gbt_iter


def truncated(spark: SparkSession, model: PipelineModel, k: int) -> PipelineModel:
    """``model`` with the first ``k`` trees of its booster: a shorter fit without fitting.

    The booster is saved, its node and tree tables are filtered, and the tables
    are loaded as a model of ``k`` trees.
    """
    booster = model.stages[-1]
    n = booster.getNumTrees
    if not 0 < k <= n:
        raise ValueError(f"{k} of {n} trees")
    if k == n:
        return model
    whole, cut = model_path(spark, "whole"), model_path(spark, "cut")
    booster.write().overwrite().save(whole)
    about = json.loads(spark.read.text(f"{whole}/metadata").first()[0])
    about["numTrees"] = k
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{cut}/metadata")
    spark.read.parquet(f"{whole}/treesMetadata").where(F.col("_1") < k).write.parquet(f"{cut}/treesMetadata")
    spark.read.parquet(f"{whole}/data").where(F.col("treeID") < k).write.parquet(f"{cut}/data")
    return PipelineModel(stages=[*model.stages[:-1], type(booster).load(cut)])


def positive_probability(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    return model.transform(df).withColumn(out, vector_to_array(F.col("probability"))[1])


def evaluate(scored: DataFrame, score: str = "score", group_cols=()) -> DataFrame:
    """roc_auc + average_precision + brier of a scored frame (optionally per group).

    The scores are read three times, so they are written once: no model scores a row again."""
    scored = materialize(scored.select(*group_cols, score, LABEL), "scored")
    curve = score_curve(scored, score, LABEL, group_cols)
    auc = auc_from_curve(curve, group_cols)
    ap = ap_from_curve(curve, group_cols)
    g = list(group_cols)
    sq = F.when(is_score(score), F.pow(F.col(score) - F.col(LABEL).cast("double"), 2))
    br = scored.groupBy(*g).agg(F.round(F.avg(sq), 10).alias("brier"))
    if g:
        return auc.join(ap, g, "left").join(br, g, "left")
    # one-row frames: attach the other metrics as scalar subqueries
    return auc.select("roc_auc", ap.scalar().alias("average_precision"), br.scalar().alias("brier"))


@dataclass
class FitResult:
    name: str
    model: PipelineModel
    features: list[str]
    test_scores: DataFrame


class Trainer:
    """Fits the model line-up on one written training frame."""

    def __init__(self, spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, params: ModelParams = PARAMS):
        self.spark, self.params, self.sf_dir, self.w = spark, params, sf_dir, w
        tf = training_frame(spark, sf_dir, w)
        self.features = feature_columns(tf)
        non_test = tf.where(F.col("fold") != "test")
        self.frame = materialize(spread_evenly(with_weights(tf, non_test), tf.count()))
        self.non_test = self.frame.where(F.col("fold") != "test")
        self.fit_part = self.frame.where(F.col("fold") == "train")
        self.valid = self.frame.where(F.col("fold") == "validation")
        self.test = self.frame.where(F.col("fold") == "test")
        columns = self.frame.columns
        # one pass: rows to fit on, and a digest of all rows
        self.n_fit, n, digest = self.frame.agg(F.count(F.when(F.col("fold") != "test", 1)), F.count(F.lit(1)),
                                               F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))).first()
        self.content = (tuple(columns), n, str(digest))

    def _result(self, name, model, feats) -> FitResult:
        return FitResult(name, model, feats, positive_probability(model, self.test))

    def majority(self) -> DataFrame:
        maj = self.non_test.agg(F.when(F.sum(LABEL) * 2 > F.count(F.lit(1)), 1.0).otherwise(0.0)).scalar()
        return self.test.withColumn("score", maj)

    def fit_logreg(self) -> FitResult:
        return self._result("logistic_regression", logreg(self.features, self.n_fit, self.params).fit(self.non_test),
                            self.features)

    def fit_logreg_scaled(self) -> FitResult:
        return self._result("logistic_regression_scaled", logreg_scaled(self.features, self.n_fit, self.params).fit(self.non_test),
                            self.features)

    def fit_forest(self) -> FitResult:
        return self._result("random_forest", forest(self.features, self.params).fit(self.non_test), self.features)

    def fit_gbt(self, exclude: tuple = ()) -> FitResult:
        feats = [c for c in self.features if c not in exclude]
        name = "gbt" if not exclude else "gbt_without_" + "_".join(exclude)
        key = (self.spark.sparkContext.applicationId, self.content, tuple(sorted(vars(self.params).items())), name)
        if key not in _FITS:        # one fit per session, training rows and parameters: many queries use the same
            model = fit_early_stopped(feats, self.fit_part, self.valid, self.params)
            with _FITS_LOCK:
                while len(_FITS) >= FITS_KEPT:
                    _FITS.pop(next(iter(_FITS)))
                _FITS[key] = model
        else:
            model = _FITS[key]
        return self._result(name, model, feats)

    def fit_gbts(self, *excludes: tuple) -> list[FitResult]:
        """The boosters without the columns of each of ``excludes``, fitted at the same time: a round is
        four short jobs, and cores that wait for the end of one booster's job do tasks of the other's."""
        with ThreadPool(len(excludes)) as pool:
            begun = [pool.apply_async(inheritable_thread_target(self.spark)(self.fit_gbt), (e,)) for e in excludes]
            return [f.get() for f in begun]

    def scorer(self) -> tuple[str, PipelineModel, list[str]]:
        """T4 + M7: the better of the two boosters by validation AUC (the smaller one on a tie),
        with the isotonic calibration of the validation fold as the last stage."""
        fits = self.fit_gbts(LEAK_COLUMNS, ())
        aucs = [evaluate(positive_probability(f.model, self.valid)).first().roc_auc or 0.0 for f in fits]
        best = fits[0] if aucs[0] >= aucs[1] else fits[1]
        return best.name, calibrated_pipeline(best.model, self.valid), best.features


_FITS: dict = {}
_FITS_LOCK = threading.Lock()
FITS_KEPT = 8


# --- queries (rows-only checks: model fits are not SQL) ----------------------------

def _metrics_row(name: str, scored: DataFrame, score: str = "score") -> DataFrame:
    return evaluate(scored, score).select(F.lit(name).alias("model"), "roc_auc", "average_precision", "brier")


def model_logreg(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    r = Trainer(spark, sf_dir, w).fit_logreg()
    return _metrics_row(r.name, r.test_scores)


def model_logreg_scaled(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    r = Trainer(spark, sf_dir, w).fit_logreg_scaled()
    return _metrics_row(r.name, r.test_scores)


def model_forest(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    r = Trainer(spark, sf_dir, w).fit_forest()
    return _metrics_row(r.name, r.test_scores)


def model_gbt(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    t = Trainer(spark, sf_dir, w)
    r = t.fit_gbt()
    n_trees = len(r.model.stages[-1].trees)
    return _metrics_row(r.name, r.test_scores).withColumn("n_trees", F.lit(n_trees))


def ablation(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, leak: tuple = LEAK_COLUMNS) -> DataFrame:
    """M6: AUC with and without the named columns, delta and verdict."""
    t = Trainer(spark, sf_dir, w)
    full, reduced = t.fit_gbts((), leak)
    both = (full.test_scores.select("account_id", LABEL, F.lit("full").alias("variant"), "score")
            .unionByName(reduced.test_scores.select("account_id", LABEL, F.lit("reduced").alias("variant"), "score")))
    auc = auc_from_curve(score_curve(both, "score", LABEL, ["variant"]), ["variant"])
    wide = auc.agg(F.max(F.when(F.col("variant") == "full", F.col("roc_auc"))).alias("auc_full"),
                   F.max(F.when(F.col("variant") == "reduced", F.col("roc_auc"))).alias("auc_reduced"))
    delta = F.col("auc_reduced") - F.col("auc_full")
    return wide.select(F.lit(",".join(leak)).alias("dropped"), "auc_full", "auc_reduced", delta.alias("delta"),
                       F.when(F.abs(delta) < F.lit(LEAKAGE_TOLERANCE), F.lit("no material leakage"))
                        .otherwise(F.lit("columns contribute")).alias("verdict"))


def isotonic_points(scored: DataFrame, score: str = "score") -> DataFrame:
    """(s, y, wt): both ends of every block of the distributed fit."""
    ends = F.when(F.col("low") < F.col("high"), F.array("low", "high")).otherwise(F.array("low"))
    return isotonic_blocks(scored, score, LABEL).withColumn("ends", ends).select(
        F.explode("ends").alias("s"), (F.col("ones") / F.col("n")).alias("y"), (F.col("n") / F.size("ends")).alias("wt"))


def calibrator(scored_fit_rows: DataFrame, score: str = "score"):
    """M7 as a Spark ML stage.  The regression itself is done by ``operators.isotonic``; the
    stage is fitted on the ends of its blocks, which rise already, so nothing but they reaches the driver."""
    iso = IsotonicRegression(featuresCol="s", labelCol="y", weightCol="wt", isotonic=True,
                             predictionCol="calibrated")
    return iso.fit(isotonic_points(scored_fit_rows, score))


def calibrate(iso_model, scored: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
    return (iso_model.transform(scored.withColumn("s", F.col(score)))
                     .withColumnRenamed("calibrated", out).drop("s"))


def calibrated_pipeline(model: PipelineModel, valid: DataFrame) -> PipelineModel:
    """``model`` with an isotonic stage fitted on ``valid``: ``calibrated`` from ``probability``."""
    iso = calibrator(positive_probability(model, valid))
    iso = iso.setFeaturesCol("probability").setFeatureIndex(1)
    return PipelineModel(stages=[*model.stages, iso])


def calibrated_scores(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """M7: isotonic calibration fitted on the validation fold (not the fit rows, C9)."""
    t = Trainer(spark, sf_dir, w)
    r = t.fit_gbt()
    iso = calibrator(positive_probability(r.model, t.valid))
    cal = calibrate(iso, r.test_scores)
    return cal.select("account_id", LABEL, F.col("score").alias("raw"), "calibrated",
                      risk_tier("calibrated").alias("risk_tier"))


def model_threshold_sweep(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """A18 on the booster's raw and calibrated test scores."""
    from ..plans.metrics import sweep
    cal = materialize(calibrated_scores(spark, sf_dir, w), "calibrated")
    parts = [sweep(cal, p=c, y=LABEL).withColumn("scores", F.lit(c)) for c in ("raw", "calibrated")]
    return parts[0].unionByName(parts[1])


def model_calibration_bins(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """V8 on the booster's raw and calibrated test scores."""
    from ..plans.metrics import calibration_bins_of
    cal = materialize(calibrated_scores(spark, sf_dir, w), "calibrated")
    parts = [calibration_bins_of(cal, p=c, y=LABEL).withColumn("scores", F.lit(c)) for c in ("raw", "calibrated")]
    return parts[0].unionByName(parts[1])


def calibration_gain(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """AUC and Brier of raw vs calibrated scores, one grouped pass."""
    cal = calibrated_scores(spark, sf_dir, w)
    long = (cal.select("account_id", LABEL, F.lit("raw").alias("scores"), F.col("raw").alias("score"))
               .unionByName(cal.select("account_id", LABEL, F.lit("calibrated").alias("scores"),
                                       F.col("calibrated").alias("score"))))
    return evaluate(long, "score", ["scores"]).select("scores", "roc_auc", "brier")


def feature_importance(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """M9: the fitted booster's importances by assembler column name (top-k by rank)."""
    r = Trainer(spark, sf_dir, w).fit_gbt()
    imp = r.model.stages[-1].featureImportances.toArray().tolist()
    # one value per feature column: bounded by the schema, not by the data
    df = spark.createDataFrame(list(zip(r.features, [float(v) for v in imp])), "feature string, importance double")
    from pyspark.sql import Window
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")).cast("long"))


def partners(df: DataFrame, salt: str, key: str = "account_id") -> DataFrame:
    """(key, _partner): each row's successor in salted-hash order, the last one
    wrapping to the first -- a permutation without fixed points (in 2+ rows) that
    depends on the keys and the salt alone.  Rows are numbered by running totals
    over range partitions: no single-task sort, nothing through the driver."""
    x = df.select(key, F.struct(F.xxhash64(F.col(key), F.lit(salt)).alias("h"), F.col(key).alias("k")).alias("_at"),
                  F.lit(1).cast("long").alias("c"))
    numbered = materialize(running_totals(x, [], "_at", ["c"]).select(key, "c_run", "c_all"), "permutation")
    succ = numbered.select(F.col(key).alias("_partner"), F.col("c_run").alias("_to"))
    return (numbered.withColumn("_to", F.pmod(F.col("c_run"), F.col("c_all")) + 1)
                    .join(succ, "_to").select(key, "_partner"))


def permuted(df: DataFrame, col: str, salt: str) -> DataFrame:
    """``df`` with ``col`` taken from each row's partner (one column permuted)."""
    donor = df.select(F.col("account_id").alias("_partner"), F.col(col).alias("_donor"))
    return (df.join(partners(df, salt), "account_id").join(donor, "_partner")
              .withColumn(col, F.col("_donor")).drop("_partner", "_donor"))


def permutation_importance(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """M10 (re-aimed from tree attribution): AUC drop when one column is permuted.

    All permuted copies of the test fold are scored in ONE transform and their
    AUCs computed in one grouped curve pass."""
    t = Trainer(spark, sf_dir, w)
    r = t.fit_gbt()
    feats = r.features
    base = t.test.select("account_id", LABEL, *feats)
    # one derangement window + one key-unique join fetch every partner value;
    # the per-feature copies are then a narrow explode (no shuffle per feature)
    donor = base.select(F.col("account_id").alias("_partner"), *[F.col(c).alias(f"_d{i}") for i, c in enumerate(feats)])
    paired = base.join(partners(base, "perm"), "account_id").join(donor, "_partner")
    copies = paired.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in feats]))).select(
        "account_id", LABEL, "feature",
        *[F.when(F.col("feature") == c, F.col(f"_d{i}")).otherwise(F.col(c)).alias(c) for i, c in enumerate(feats)])
    scored = positive_probability(r.model, copies)
    auc = auc_from_curve(score_curve(scored, "score", LABEL, ["feature"]), ["feature"])
    base_auc = auc_from_curve(score_curve(r.test_scores, "score", LABEL)).scalar()
    from pyspark.sql import Window
    out = auc.select("feature", (base_auc - F.col("roc_auc")).alias("auc_drop"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("auc_drop"), "feature")).cast("long"))


def raw_scorer(model: PipelineModel, features: list[str], col: str = "frequency") -> PipelineModel:
    """The scorer behind an encoder stage: it takes ``col`` as text instead of its dummy columns."""
    levels = [c.removeprefix(f"{col}_") for c in features if c.startswith(f"{col}_")]
    return PipelineModel(stages=[encoder_stage(col, levels), *model.stages])


def model_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "models", f"{name}-{uuid.uuid4().hex[:8]}")


def save_model(model: PipelineModel, path: str) -> str:
    """The fitted pipeline in Spark ML's own format."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_frame(model: PipelineModel, df: DataFrame, key: str = "account_id") -> DataFrame:
    """Calibrated probability of the positive class, tier on the unrounded value,
    the probability rounded half-even to 4 places."""
    s = model.transform(df)
    s = s.withColumn("p", F.col("calibrated") if "calibrated" in s.columns else vector_to_array(F.col("probability"))[1])
    return s.select(key, round_prob("p").alias("churn_probability"), risk_tier("p").alias("risk_tier"))


def score_batch(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """M11 + S8: choose, calibrate, save and load the scorer, score the records of the test fold."""
    from ..streaming.scoring import parse_records, split_records
    t = Trainer(spark, sf_dir, w)
    _, model, features = t.scorer()
    loaded = load_model(save_model(model, model_path(spark, "scorer")))
    accepted, _ = split_records(parse_records(t.test.select("account_id", *features), features), features)
    return score_frame(loaded, accepted)


def score_raw(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """M11 on raw records: the segment as text, encoded by the saved scorer itself."""
    from ..sources.tables import accounts
    from ..streaming.scoring import parse_records, split_records
    t = Trainer(spark, sf_dir, w)
    _, model, features = t.scorer()
    plain = [c for c in features if not c.startswith("frequency_")]
    loaded = load_model(save_model(raw_scorer(model, features), model_path(spark, "raw-scorer")))
    records = t.test.select("account_id", *plain).join(accounts(spark, sf_dir).select("account_id", "frequency"), "account_id", "left")
    accepted, _ = split_records(parse_records(records, plain, text=["frequency"]), plain)
    return score_frame(loaded, accepted)


def run_metrics(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """S9 + M8: the model line-up appended to a runs table, read back."""
    from ..sources.sinks import log_runs, read_runs
    t = Trainer(spark, sf_dir, w)
    fits = [("dummy_baseline", t.majority())]
    for fr in (t.fit_logreg(), t.fit_forest(), *t.fit_gbts((), LEAK_COLUMNS)):
        fits.append((fr.name, fr.test_scores))
    long = None
    for name, sc in fits:
        part = sc.select(F.lit(name).alias("model"), LABEL, "score")
        long = part if long is None else long.unionByName(part)
    m = evaluate(long, "score", ["model"])
    path = os.path.join(checkpoint_dir(spark), "runs")       # one table for all calls
    params = {"seed": t.params.seed, "call": uuid.uuid4().hex[:8]}
    log_runs(m, path, ("roc_auc", "average_precision", "brier"), params, commit=params["call"])
    return read_runs(spark, path, params["call"]).select("run_name", "metric", "value", "params")


def best_run(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """T4: the run with the highest test AUC (max_by over the runs table)."""
    runs = run_metrics(spark, sf_dir, w).where(F.col("metric") == "test_roc_auc")
    order = F.struct(F.col("value"), F.col("run_name"))       # equal values: the later name
    return runs.agg(F.max_by("run_name", order).alias("best_run"), F.max("value").alias("test_roc_auc"))
