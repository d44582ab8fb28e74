"""Toxicity: held-out accuracy on planted words, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.llm import toxicity

SYLLABLES = "ka lo mi ren ta vu so pel dra qui zem bor".split()
MARKS = ["grumbak", "snefrit", "voltusk"]


def rows(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 200))]
        toxic = int(rng.random() < 0.3)
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(MARKS) + rng.choice(["", "en", "ei"]))
        out.append((i, " ".join(words), toxic))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    df = spark.createDataFrame(rows(1, 900), "doc_id long, text string, toxic int").repartition(3)
    return df.select("doc_id", "text"), df.select("doc_id", "toxic", F.lit(1).alias("quality"))


@pytest.fixture(scope="module")
def model(tables):
    docs, labels = tables
    return toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id")))


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    scored = toxicity.score(docs.withColumn("score", F.lit("clash")), model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    toxic = [r["score"] for r in scored if r["toxic"]]
    plain = [r["score"] for r in scored if not r["toxic"]]
    assert sum(s >= 0.3 for s in toxic) >= 0.95 * len(toxic)
    assert sum(s >= 0.3 for s in plain) <= 0.03 * len(plain)
    assert all(0 <= s <= 1 for s in toxic + plain)


def test_held_out_labels_are_not_read(tables, model):
    docs, labels = tables
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, flipped, ~toxicity.held_out(F.col("doc_id"))) == model


def test_edges(spark, model):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (None, "grumbak snefrit voltusk ka lo mi"), (5, "x" * 200_000),
                                  (6, "GRUMBAK Snefrit kalo " * 3), (6, "GRUMBAK Snefrit kalo " * 3)], "doc_id long, text string")
    got = toxicity.score(docs, model).collect()
    by = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == 7 and by[1] == by[2] == by[3] and by[1] < 0.3 and by[6] >= 0.3 and by[None] >= 0.3
    kept = toxicity.reject_toxic(docs.withColumn("score", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "score"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "5"]
    assert toxicity.score(docs.where("doc_id > 99"), model).count() == 0


def test_without_labels(spark, tables):
    docs, labels = tables
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.train(docs, labels.where("doc_id < 0")) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.reject_toxic(docs, None).count() == docs.count()


def test_windows_cover_every_word():
    for n in (0, 1, 8, 9, 16, 17, 40):
        words = [f"w{i}" for i in range(n)]
        seen = {w for x in toxicity.windows(" ".join(words)) for w in x.decode().split()}
        assert seen == set(words)


def test_verdicts_come_from_the_two_trained_dictionaries(tables):
    """Without stems the dictionaries find the toxic rows; with one dictionary in both places nothing does."""
    docs, labels = tables
    pairs = [(r["text"], r["toxic"]) for r in docs.join(labels, "doc_id").orderBy("doc_id").collect()]
    samples = [[w for t, y in pairs[:500] if y == k for w in toxicity.windows(t)] for k in (0, 1)]
    plain, toxic = ([toxicity.trained(s, size, toxicity.SEGMENT_BYTES[1]) for size in toxicity.HEADS] for s in samples)
    base = toxicity.trained(samples[0], toxicity.BASE_BYTES, toxicity.SEGMENT_BYTES[0])
    y = np.array([y for _, y in pairs], float)

    def separation(**model):
        """Share of (toxic, ordinary) pairs of unseen rows that are in the right order."""
        distance = toxicity.Distance({"base": base, "stems": {}, **model})
        x = np.array([distance.features(t) for t, _ in pairs])
        w = toxicity.training.fit_logistic(x[500:700], y[500:700])
        z = x[700:] @ w[:-1] + w[-1]
        return float(np.mean(z[y[700:] == 1][:, None] > z[y[700:] == 0][None, :]))

    assert separation(plain=plain, toxic=toxic) >= 0.95
    assert separation(plain=plain, toxic=plain) <= 0.65


def test_too_little_text_to_train_on():
    assert toxicity.trained([], 600, 16) == b"" and toxicity.trained([b" a b "], 600, 16) == b" a b "


def test_repeated_words_mark_toxic_texts():
    """Ordinary texts have each such word too, but once: only its rate tells."""
    rng = random.Random(4)
    texts = []
    for i in range(1200):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(100, 300))]
        toxic = int(i % 6 == 0)
        for _ in range(rng.randint(4, 9) if toxic else rng.random() < 0.3):
            words.insert(rng.randint(0, len(words)), "braspo" + rng.choice(SYLLABLES))
        texts.append((" ".join(words), toxic))
    stems = toxicity.toxic_stems(texts[:800])
    assert b"braspo" in stems and all(s.startswith(b"bras") for s in stems)
    model = {"base": b" ".join(toxicity.words_of(texts[1][0])), "plain": [b""], "toxic": [b""], "stems": stems}
    distance = toxicity.Distance(model)
    x = np.array([distance.features(t) for t, _ in texts])
    y = np.array([y for _, y in texts], float)
    weights = toxicity.training.fit_logistic(x[600:800], y[600:800])
    found = [toxicity.training.sigmoid(f @ weights[:-1] + weights[-1]) >= 0.3 for f in x[800:]]
    assert sum(f for f, k in zip(found, y[800:]) if k) >= 0.95 * y[800:].sum()
    assert sum(f for f, k in zip(found, y[800:]) if not k) <= 0.03 * (1 - y[800:]).sum()


def test_every_language_is_found(spark):
    """Held-out recall of each language of sf0.1, whose non-English toxic texts repeat words of ordinary ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, labels, ~held)
    truth = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    scored = toxicity.score(docs.where(held), model).join(truth, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rate = {(r["lang"], r["toxic"]): r["rate"] for r in scored.groupBy("lang", "toxic").agg(
        F.avg((F.col("score") >= toxicity.THRESHOLD).cast("double")).alias("rate")).collect()}
    for lang in ("en", "de", "fr", "es"):
        assert rate[lang, 1] >= 0.9 and rate[lang, 0] <= 0.1, rate
