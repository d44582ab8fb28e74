"""Model fits: rows-only checks + sanity bounds; stream == batch; permutation is a permutation."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lapse.models.train import (ModelParams, Trainer, calibrate, calibrator, load_model, model_path,
                                permuted, positive_probability, save_model, score_frame)


@pytest.fixture(scope="module")
def trainer(spark):
    return Trainer(spark, "/root/testdata/sf0.01", params=ModelParams(forest_trees=20, gbt_iter=20))


def test_planted_signal_on_held_out_rows(spark):
    from lapse.models.train import evaluate, fit_early_stopped, with_weights
    rows = [(i, float((i * 37) % 100), float((i * 7) % 13), int((i * 37) % 100 > 80)) for i in range(3000)]
    df = spark.createDataFrame(rows, "account_id long, x double, z double, churned int")
    df = with_weights(df, df).cache()
    part = F.col("account_id") % 3
    m = fit_early_stopped(["x", "z"], df.where(part == 0), df.where(part == 1), ModelParams(gbt_iter=40, gbt_first=20))
    assert evaluate(positive_probability(m, df.where(part == 2))).first().roc_auc > 0.95


def test_best_round_with_patience():
    from lapse.models.train import best_round
    assert best_round([5, 4, 3, 3, 3, 3], 3) == (3, True)
    assert best_round([5, 4, 3, 3.5, 2.9], 3) == (5, False)
    assert best_round([5, 4, 3, 3.5, 3.4, 3.3, 1], 3) == (3, True)
    assert best_round([1], 20) == (1, False)


def test_doubling_finds_the_round_of_one_long_fit(spark, trainer):
    from lapse.models.train import best_round, fit_early_stopped, gbt
    feats = trainer.features
    p = ModelParams(gbt_iter=24, gbt_first=6, gbt_patience=4)
    long = gbt(feats, p).fit(trainer.fit_part)
    losses = long.stages[-1].evaluateEachIteration(long.stages[0].transform(trainer.valid))
    short = fit_early_stopped(feats, trainer.fit_part, trainer.valid, p)
    assert len(short.stages[-1].trees) == best_round(losses, 4)[0]


def test_trainer_folds_disjoint(trainer):
    folds = {r.fold: r.n for r in trainer.frame.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert set(folds) == {"train", "validation", "test"}
    assert sum(folds.values()) == trainer.frame.select("account_id").distinct().count()


def test_save_load_score_and_stream_equal_batch(spark, trainer):
    name, model, features = trainer.scorer()
    loaded = load_model(save_model(model, model_path(spark, "t")))
    batch = {(x.account_id, x.churn_probability, x.risk_tier) for x in score_frame(loaded, trainer.test).collect()}
    assert len(batch) == trainer.test.count()
    import os
    import uuid

    from lapse.session import checkpoint_dir
    from lapse.streaming.scoring import start_scoring
    base = os.path.join(checkpoint_dir(spark), "stream-test", uuid.uuid4().hex[:8])
    trainer.test.select("account_id", *features).write.json(base + "/landing")
    q = start_scoring(spark, model, features, base + "/landing", base + "/sink", base + "/ckpt")
    q.awaitTermination()
    stream = {(x.account_id, x.churn_probability, x.risk_tier) for x in spark.read.parquet(base + "/sink").collect()}
    assert stream == batch


def test_isotonic_is_monotone(trainer):
    r = trainer.fit_gbt()
    iso = calibrator(positive_probability(r.model, trainer.valid))
    cal = calibrate(iso, r.test_scores).select("score", "calibrated").orderBy("score").collect()
    vals = [c.calibrated for c in cal]
    assert all(a <= b + 1e-12 for a, b in zip(vals, vals[1:]))


def test_permutation_keeps_values(spark):
    from lapse.models.train import partners
    df = spark.createDataFrame([(i, float(i)) for i in range(200)], "account_id long, x double")
    pr = partners(df, "s").collect()
    assert sorted(r._partner for r in pr) == list(range(200))       # a permutation
    assert all(r._partner != r.account_id for r in pr)              # without fixed points
    again = {r.account_id: r._partner for r in partners(df.repartition(7), "s").collect()}
    assert again == {r.account_id: r._partner for r in pr}          # of the keys and the salt alone
    p = permuted(df, "x", "s")
    assert sorted(r.x for r in p.collect()) == sorted(r.x for r in df.collect())
    moved = p.join(df.withColumnRenamed("x", "x0"), "account_id").where("x != x0").count()
    assert moved > 150


@pytest.mark.parametrize("name", ["model_logreg", "model_logreg_scaled", "ablation", "calibration_gain", "feature_importance", "model_threshold_sweep",
                                  "model_calibration_bins"])
def test_model_queries_rows(spark, name):
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.count() >= 1


def test_scorer_is_calibrated(trainer):
    """The mean score of the test fold is near its base rate, tiers follow the calibrated column."""
    from lapse.functions.columns import risk_tier
    _, model, features = trainer.scorer()
    scored = model.transform(trainer.test)
    mean, rate = scored.agg(F.avg("calibrated"), F.avg(F.col("churned").cast("double"))).first()
    assert abs(mean - rate) < 0.05
    want = {(r.risk_tier, r["count"]) for r in scored.select(risk_tier("calibrated").alias("risk_tier")).groupBy("risk_tier").count().collect()}
    assert {(r.risk_tier, r["count"]) for r in score_frame(model, trainer.test).groupBy("risk_tier").count().collect()} == want


def test_record_edges(spark):
    """Booleans, numbers and numeric text are accepted; missing and unusable fields are named."""
    from lapse.streaming.scoring import parse_records, request_schema, split_records
    features = ["has_loan", "amount", "frequency_A"]
    records = ['{"account_id": 1, "has_loan": true, "amount": 2.5, "frequency_A": 1}',
               '{"account_id": 2, "has_loan": 0, "amount": "7"}',
               '{"account_id": 3, "has_loan": false}',
               '{"account_id": 4, "amount": "junk", "has_loan": "NaN", "extra": [1]}',
               '{"account_id": 5, "has_loan": null, "amount": 1}']
    df = spark.read.schema(request_schema(features)).json(spark.sparkContext.parallelize(records))
    good, bad = split_records(parse_records(df, features), features)
    assert {tuple(r) for r in good.collect()} == {(1, 1.0, 2.5, 1.0), (2, 0.0, 7.0, 0.0)}
    assert {r.account_id: r.missing for r in bad.collect()} == {3: ["amount"], 4: ["has_loan", "amount"], 5: ["has_loan"]}
    # a batch frame without a column at all
    good, bad = split_records(parse_records(spark.createDataFrame([(9, True)], "account_id long, has_loan boolean"), features), features)
    assert good.count() == 0 and bad.first().missing == ["amount"]


def test_stream_sends_incomplete_records_to_the_reject_sink(spark, trainer):
    import os
    import uuid

    from lapse.session import checkpoint_dir
    from lapse.streaming.scoring import start_scoring
    r = trainer.fit_gbt()
    base = os.path.join(checkpoint_dir(spark), "stream-rej", uuid.uuid4().hex[:8])
    first = next(c for c in r.features if not c.startswith("frequency_"))
    recs = trainer.test.select("account_id", *r.features).limit(9)
    broken = recs.withColumn(first, F.when(F.col("account_id") % 2 != 0, F.col(first)))
    broken.write.json(base + "/landing")
    start_scoring(spark, r.model, r.features, base + "/landing", base + "/sink", base + "/ckpt").awaitTermination()
    got = {x.account_id for x in spark.read.parquet(base + "/sink").collect()}
    rejects = {x.account_id: x.missing for x in spark.read.parquet(base + "/sink-rejects").collect()}
    everything = {x.account_id for x in broken.collect()}
    assert got == {x.account_id for x in broken.where(F.col(first).isNotNull()).collect()}
    assert set(rejects) == everything - got and all(m == [first] for m in rejects.values())


def test_stream_restart_processes_only_new_files(spark, trainer):
    """Restarted on the same checkpoint, the query scores only newly landed files."""
    import os
    import uuid

    from lapse.session import checkpoint_dir
    from lapse.streaming.scoring import start_scoring
    r = trainer.fit_gbt()
    base = os.path.join(checkpoint_dir(spark), "stream-restart", uuid.uuid4().hex[:8])
    recs = trainer.test.select("account_id", *r.features)
    first, second = recs.where(F.col("account_id") % 2 == 0), recs.where(F.col("account_id") % 2 == 1)
    landing = base + "/landing"
    first.write.json(landing)
    start_scoring(spark, r.model, r.features, landing, base + "/sink", base + "/ckpt").awaitTermination()
    n1 = spark.read.parquet(base + "/sink").count()
    start_scoring(spark, r.model, r.features, landing, base + "/sink", base + "/ckpt").awaitTermination()
    assert spark.read.parquet(base + "/sink").count() == n1          # nothing re-scored
    second.write.mode("append").json(landing)                          # new files land
    q = start_scoring(spark, r.model, r.features, landing, base + "/sink", base + "/ckpt")
    q.awaitTermination()
    out = spark.read.parquet(base + "/sink")
    assert out.count() == recs.count() and out.select("account_id").distinct().count() == recs.count()


def test_training_rows_are_spread_evenly(spark):
    from lapse.models.train import ROWS_PER_TASK, spread_evenly
    sizes = lambda df: df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    n = 3 * ROWS_PER_TASK
    uneven = spark.range(n).select(F.col("id").alias("account_id")).repartition(4, (F.col("account_id") < n - 9))
    assert max(sizes(uneven)) >= n - 9
    even = spread_evenly(uneven, n)
    assert sum(sizes(even)) == n and max(sizes(even)) <= 1.1 * ROWS_PER_TASK and even.distinct().count() == n
    assert spread_evenly(uneven, ROWS_PER_TASK) is uneven


def test_forest_with_cached_nodes_is_the_same_forest(spark):
    from lapse.models.train import forest, with_weights
    rows = [(i, float((i * 37) % 100), float((i * 7) % 13), int((i * 37) % 100 > 80)) for i in range(2000)]
    df = spark.createDataFrame(rows, "account_id long, x double, z double, churned int")
    df = with_weights(df, df).coalesce(2).cache()
    ours = forest(["x", "z"], ModelParams(forest_trees=5, forest_depth=5))
    plain = forest(["x", "z"], ModelParams(forest_trees=5, forest_depth=5))
    plain.getStages()[-1].setCacheNodeIds(False)
    assert ours.getStages()[-1].getCacheNodeIds()
    trees = [m.fit(df).stages[-1].toDebugString.split("\n", 1)[1] for m in (ours, plain)]
    assert trees[0] == trees[1]


def test_rows_are_scored_once_for_all_metrics(spark):
    from pyspark.sql.types import DoubleType

    from lapse.models.train import evaluate
    calls = spark.sparkContext.accumulator(0)

    def score(x):
        calls.add(1)
        return x / 500
    df = spark.range(400).select(F.col("id").alias("account_id"), (F.col("id") % 2).cast("int").alias("churned"),
                                 F.udf(score, DoubleType())(F.col("id").cast("double")).alias("score"))
    row = evaluate(df).first()
    assert calls.value == 400 and 0.5 <= row.roc_auc <= 0.51 and row.brier is not None


def test_at_most_the_first_rounds_are_fitted_twice(spark, monkeypatch):
    from lapse.models import train
    rows = [(i, float((i * 37) % 100), int((i * 37) % 100 > 80)) for i in range(300)]
    df = spark.createDataFrame(rows, "account_id long, x double, churned int")
    df = train.with_weights(df, df).coalesce(1).cache()
    fitted, gbt = [], train.gbt
    monkeypatch.setattr(train, "gbt", lambda feats, p, rounds: fitted.append(rounds) or gbt(feats, p, rounds))
    train.fit_early_stopped(["x"], df, df, ModelParams(gbt_iter=12, gbt_first=2, gbt_patience=12))
    assert sum(fitted) <= 12 + 2


def test_boosters_are_fitted_at_the_same_time(spark, monkeypatch):
    import threading

    from lapse.models import train
    both = threading.Barrier(2, timeout=60)

    def fit(feats, *_):
        both.wait()
        return feats
    monkeypatch.setattr(train, "fit_early_stopped", fit)
    monkeypatch.setattr(train, "positive_probability", lambda model, df, out="score": model)
    monkeypatch.setattr(train, "evaluate", lambda feats: spark.createDataFrame([(float(len(feats)),)], "roc_auc double"))
    monkeypatch.setattr(train, "calibrated_pipeline", lambda model, valid: model)
    t = Trainer.__new__(Trainer)
    t.spark, t.params, t.features, t.content = spark, ModelParams(), ["has_card", "x"], "both at once"
    t.fit_part = t.valid = t.test = None
    assert t.scorer() == ("gbt", ["has_card", "x"], ["has_card", "x"])
