"""Quality rules: counts against a plain version, held-out accuracy, edges."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lapse.llm import quality
from lapse.llm.hashing import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                covered.update((i, i + 1, i + 2))
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "x x x x x", "é 中文 \U0001f600 # * $%&|<>", "l\nl\n\n \n \nl x\r\nl", "a b c d\na b c\n" * 30,
         "one two three four " * 20, "\u00a0non breaking\u2003space words", "\x00 nul \x0b vt \x0c ff"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    data = (text or "").encode()
    assert quality.counts(data, word_hashes(data.split())) == plain_counts(text)


def rows(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        good = int(rng.random() < 0.7)
        words = ["".join(rng.choice("ka lo mi ren ta vu so".split()) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(60, 200))]
        if not good:
            words = [w + rng.choice(["$$$", "%%%", "***"]) if rng.random() < 0.6 else w for w in words]
        out.append((i, " ".join(words), good))
    return out


def test_held_out_accuracy_and_edges(spark):
    df = spark.createDataFrame(rows(2, 500), "doc_id long, text string, quality int")
    model = quality.train(df.select("doc_id", "text"), df.where("doc_id < 350").select("doc_id", "quality", F.lit(0).alias("toxic")))
    got = {r["doc_id"]: r for r in quality.judge(df.withColumn("score", F.lit("clash")), model).collect()}
    right = sum((got[i]["score"] >= 0.5) == bool(g) for i, _, g in rows(2, 500) if i >= 350)
    assert right >= 146
    odd = spark.createDataFrame(list(enumerate(TEXTS + [TEXTS[5]])), "doc_id long, text string")
    out = quality.judge(odd, model).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        want = plain_counts((TEXTS + [TEXTS[5]])[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert quality.judge(odd.where("doc_id < 0"), model).count() == 0
    assert quality.train(df, df.where("doc_id < 0").select("doc_id", "quality")) is None
    assert {r["score"] for r in quality.judge(odd, None).collect()} == {1.0}


def test_long_texts_in_pieces(monkeypatch):
    import numpy as np
    data = ("some words here and there " * 50).encode()
    weights = np.random.default_rng(0).normal(size=2 << quality.BITS).astype(np.float32)
    whole = quality.log_odds(weights, 0.0, data, word_hashes(data.split()))
    monkeypatch.setattr(quality, "AT_ONCE", 64)
    assert quality.log_odds(weights, 0.0, data, word_hashes(data.split())) == pytest.approx(whole)
