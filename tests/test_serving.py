"""Runs table, encoder stage, raw records, stream with two sinks."""

import json
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from lapse.models.train import ModelParams, Trainer, load_model, model_path, raw_scorer, save_model, score_frame
from lapse.session import checkpoint_dir
from lapse.sources.sinks import compact_runs, log_runs, read_runs


def runs_at(spark):
    path = os.path.join(checkpoint_dir(spark), "runs-test", uuid.uuid4().hex)
    log = lambda name, value, commit=None: log_runs(
        spark.createDataFrame([(name, value, 0.5)], "model string, roc_auc double, brier double"), path, ("roc_auc", "brier"), {"n": name}, commit=commit)
    read = lambda: sorted((r.run_name, r.metric, r.value) for r in read_runs(spark, path).collect())
    return path, log, read


def test_writers_at_once_and_retries(spark):
    path, log, read = runs_at(spark)
    todo = [threading.Thread(target=log, args=(f"m{i}", i / 10, f"c{i}")) for i in range(4)]
    for t in todo:
        t.start()
    for t in todo:
        t.join()
    log("m0", 0.0, "c0")                # a retry
    assert read() == sorted([(f"m{i}", f"test_{m}", v) for i in range(4) for m, v in (("roc_auc", i / 10), ("brier", 0.5))])
    assert read_runs(spark, path, "c2").count() == 2


def test_lost_writer_and_compactions(spark):
    path, log, read = runs_at(spark)
    log("a", 0.7, "a")
    log("b", 0.8, "b")
    spark.createDataFrame([("lost", "x", 1.0, "{}")], "run_name string, metric string, value double, params string").write.parquet(f"{path}/data/commit=lost")
    before = read()
    assert len(before) == 4
    first = compact_runs(spark, path)
    assert read() == before and first.startswith("compacted-")
    # two compactions of the same commits, the second published late
    from lapse.sources import sinks
    rows = spark.read.parquet(f"{path}/data/commit={first}")
    sinks._commit(rows, path, "compacted-zz", ["a", "b"])
    assert read() == before
    log("c", 0.9, "c")
    assert len(read()) == 6 and read_runs(spark, path, "a").count() == 2


def test_encoder_stage(spark):
    from lapse.functions.encode import encoder_stage, levels_of
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["A", "it's", "A", "b\\n", None, "rare", "it's", "b\\n"])], "i int, f string")
    assert levels_of(df, "f") == ["A", "b\\n", "it's", "rare"] and levels_of(df, "f", 3) == ["A", "b\\n", "it's"]
    out = encoder_stage("f", levels_of(df, "f", 3)).transform(df).orderBy("i")
    assert out.columns == ["i", "f", "f_A", "f_b\\n", "f_it's", "f_other"]
    assert [tuple(r)[2:] for r in out.collect()] == [(1, 0, 0, 0), (0, 0, 1, 0), (1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 0, 0), (0, 0, 0, 1), (0, 0, 1, 0), (0, 1, 0, 0)]


@pytest.fixture(scope="module")
def scorer(spark):
    t = Trainer(spark, "/root/testdata/sf0.01", params=ModelParams(gbt_iter=8))
    return t, *t.scorer()[1:]


def test_saved_pipeline_scores_raw_records(spark, scorer):
    t, model, features = scorer
    from lapse.sources.tables import accounts
    loaded = load_model(save_model(raw_scorer(model, features), model_path(spark, "raw")))
    plain = [c for c in features if not c.startswith("frequency_")]
    raw = t.test.select("account_id", *plain).join(accounts(spark, "/root/testdata/sf0.01").select("account_id", "frequency"), "account_id")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(score_frame(loaded, raw)) == rows(score_frame(model, t.test))
    unseen = raw.withColumn("frequency", F.lit("NEVER SEEN"))
    zero = t.test.select("account_id", *[F.lit(0.0).alias(c) if c.startswith("frequency_") else F.col(c) for c in features])
    assert rows(score_frame(loaded, unseen)) == rows(score_frame(model, zero))


def test_stream_reads_once_and_replays(spark, scorer, tmp_path):
    from lapse.streaming.scoring import batch_writer, parse_records, read_sink, split_records, start_scoring
    t, model, features = scorer
    base = str(tmp_path)
    os.makedirs(f"{base}/landing")
    records = [json.loads(x) for x in t.test.select("account_id", *features).limit(30).toJSON().collect()]
    for i, r in enumerate(records):
        r |= {"request_id": f"r{i}", "requested_at": f"2024-01-01T10:{i:02d}:00"}
    del records[3][features[0]]
    late = [records[5] | {"requested_at": "2024-01-01T10:40:00"}, records[3]]       # repeats in a later file
    unnamed = [{k: v for k, v in records[7].items() if k != "request_id"}] * 2
    for i, part in enumerate([records[:10], records[10:], late, unnamed]):
        with open(f"{base}/landing/{i}.json", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in part)
        os.utime(f"{base}/landing/{i}.json", (1e9 + i, 1e9 + i))
    q = start_scoring(spark, model, features, f"{base}/landing", f"{base}/sink", f"{base}/ckpt", files_per_batch=1)
    q.awaitTermination()
    assert q.exception() is None
    read = [p["numInputRows"] for p in q.recentProgress]
    assert sum(read) == sum(len(p) for p in [records, late, unnamed])               # each file once
    got = sorted(r.account_id for r in read_sink(spark, f"{base}/sink").collect())
    want = [r["account_id"] for i, r in enumerate(records) if i != 3] + [records[7]["account_id"]] * 2
    assert got == sorted(want)
    assert [tuple(r) for r in read_sink(spark, f"{base}/sink-rejects").collect()] == [(records[3]["account_id"], [features[0]])]
    # the same batch again: written again, not added
    write = batch_writer(model, features, f"{base}/sink2", "x")
    batch = t.test.select("account_id", *features)
    write(batch, 0)
    write(batch, 0)
    write(batch.limit(5), 1)
    assert read_sink(spark, f"{base}/sink2").count() == batch.count() + 5
    assert split_records(parse_records(batch, features), features)[1].count() == 0
