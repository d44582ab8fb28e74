"""Factorisation machine: all pairs by brute force, gradients, held-out accuracy, edges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.llm import factorisation as fm

SYLLABLES = "ka lo mi ren ta vu so pel".split()


def rows(seed, n):
    """Low rows: symbols on words or capitals."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(30, 150))]
        good, kind = int(rng.random() < 0.7), rng.randrange(2)
        if not good and kind == 0:
            words = [w + rng.choice(["$$$", "%%%"]) if rng.random() < 0.5 else w for w in words]
        elif not good:
            words = [w.upper() for w in words]
        out.append((i, " ".join(words), good))
    return out


def test_all_pairs_in_linear_time():
    rng = np.random.default_rng(0)
    model = {"weights": rng.normal(size=fm.PLACES), "factors": rng.normal(size=(fm.PLACES, fm.FACTORS)), "intercept": 0.3}
    for text, stated in [("a b a c\nd", 9), ("", None), (None, 4), ("É 中 #$% " * 5, -1)]:
        p, x = fm.features(text, stated)
        assert len(set(p.tolist())) == len(p)
        pairs = sum(model["factors"][p[i]] @ model["factors"][p[j]] * float(x[i]) * float(x[j])
                    for i in range(len(p)) for j in range(i))
        assert abs(fm.margin(model, p, x) - (0.3 + model["weights"][p] @ x + pairs)) < 1e-6 * (1 + abs(pairs))


def test_interaction_is_learnt():
    """Each word alone says nothing, both together do: no linear model separates these."""
    rng = random.Random(1)
    texts = []
    for i in range(400):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append((" ".join(rng.choices(SYLLABLES, k=20) + ["zorgan"] * (5 * a) + ["plimt"] * (5 * b)), int(a == b)))
    found = [fm.features(t, len(t)) for t, _ in texts]
    y = np.array([k for _, k in texts], np.float32)
    model = fm.fit(found[:300], y[:300])
    right = sum((fm.margin(model, *f) > 0) == bool(k) for f, k in zip(found[300:], y[300:]))
    assert right >= 95
    flat = model | {"factors": np.zeros_like(model["factors"])}
    assert sum((fm.margin(flat, *f) > 0) == bool(k) for f, k in zip(found[300:], y[300:])) < 80


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(rows(2, 900), "doc_id long, text string, quality int").withColumn("n_chars", F.length("text")).repartition(3)
    return df, fm.train(df.drop("quality"), df.select("doc_id", "quality"), ~fm.held_out(F.col("doc_id")))


def test_held_out_accuracy(model):
    df, m = model
    scored = fm.score(df.withColumn("score", F.lit("clash")), m).join(df, "doc_id").where(fm.held_out(F.col("doc_id"))).collect()
    assert len(scored) > 120 and all(0 <= r["score"] <= 1 for r in scored)
    assert sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in scored) >= 0.95 * len(scored)


def test_held_out_labels_are_not_read(model):
    df, m = model
    labels = df.select("doc_id", F.when(fm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"))
    other = fm.train(df, labels, ~fm.held_out(F.col("doc_id")))
    assert all(np.array_equal(m[k], other[k]) for k in m)


def test_edges(spark, model):
    m = model[1]
    docs = spark.createDataFrame([(1, None, None), (2, "", 0), (3, " \n", 2), (None, "ka lo mi", 8), (5, "x" * 300_000, 1), (6, "KA$$$ LO%%% " * 40, 480),
                                  (6, "KA$$$ LO%%% " * 40, 480)], "doc_id long, text string, n_chars int")
    got = fm.score(docs, m).collect()
    by = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == 7 and by[6] < 0.3 and all(0 <= r["score"] <= 1 for r in got)
    for odd in (docs.drop("n_chars"), docs.withColumn("n_chars", F.lit("many"))):
        assert fm.score(odd, m).count() == 7
    assert fm.score(docs.where("doc_id > 99"), m).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, None)], "doc_id long, quality int")
    for some, share in ((labels, 0.75), (labels.where("doc_id > 5"), 0.5)):
        assert {r["score"] for r in fm.score(docs, fm.train(docs, some, F.lit(True))).collect()} == {share}


def test_sample_is_bounded(spark, model, monkeypatch):
    df, _ = model
    monkeypatch.setattr(fm, "ROWS_PER_CLASS", 50)
    monkeypatch.setattr(fm, "ENTRIES", 2000)
    got, counts = fm._sample(df, df.select("doc_id", "quality"), F.lit(True))
    by = [[len(p) for y, p, _ in got if y == k] for k in (0, 1)]
    assert counts[0] + counts[1] == 900
    assert all(0 < len(s) < 50 and sum(s[:-1]) <= 2000 for s in by)


@pytest.mark.parametrize("at_once", [1, 7, 1 << 22])
def test_long_texts_in_pieces(monkeypatch, at_once):
    monkeypatch.setattr(fm, "AT_ONCE", at_once)
    text = "ka lo\tmi  KA\nx" + "y" * 50 + " lo lo"
    at, n, seen = fm._words(text.encode())
    assert sorted(n.tolist()) == [1, 1, 2, 3] and len(at) == 4 and seen.sum() == len(text)


def test_every_language(spark):
    """Held-out rows of sf0.1, by language."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = fm.held_out(F.col("doc_id"))
    scored = (fm.score(docs, fm.train(docs, labels, ~held)).where(held)
              .join(labels.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id").join(docs.select("doc_id", "lang"), "doc_id"))
    rate = {(r["lang"], r["quality"]): (r["n"], r["rate"]) for r in scored.groupBy("lang", "quality").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("score") >= fm.THRESHOLD).cast("double")).alias("rate")).collect()}
    print(rate)
    for lang in ("en", "de", "fr", "es"):
        assert rate[lang, 1][1] >= 0.97 and rate[lang, 0][1] <= 0.1, rate
