"""Decontamination against brute force on a small fixture."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    windows = [(i, [tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))]) for i, w in
               ((i, split(t)) for i, t in items) if w]
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for item, wins in windows:
            for win in wins:
                for k in range(len(words) - len(win) + 1):
                    if tuple(words[k:k + len(win)]) == win:
                        hit.update(range(k, k + len(win)))
                        found.add(str(item))
        out.append((str(doc), len(words), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def fixture(seed):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{int(rng.zipf(1.4)) % 60}"
    items = [(i, " ".join(word() for _ in range(int(rng.integers(1, 120 if i == 3 else 30))))) for i in range(25)]
    items += [(30, items[3][1]), (31, None), (32, " .,;"), (33, "w1"), (34, "É é Ünï W2"), (35, items[4][1].upper())]
    docs = []
    for d in range(80):
        parts = [" ".join(word() for _ in range(int(rng.integers(0, 60))))]
        if d % 3:
            w = split(items[int(rng.integers(0, 25))][1])
            a = int(rng.integers(0, len(w)))
            parts.append(", ".join(w[a:a + int(rng.integers(1, 40))]))
        parts.append(" ".join(word() for _ in range(int(rng.integers(0, 20)))))
        docs.append((d, " ".join(parts)))
    docs += [docs[1], (5, docs[2][1]), (None, docs[4][1]), (90, None), (91, ""), (92, "w1 " * 200), (93, "é É ünï w2"),
             (94, "É é Ünï! W2."), (95, items[3][1] + " " + items[3][1])]
    return docs, items


@pytest.mark.parametrize("seed,size", [(1, 10), (2, 10), (3, 4)])
def test_matches_brute_force(spark, seed, size):
    docs, items = fixture(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("dkey", F.lit(1)).withColumn("words", F.lit("x"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("tid", F.lit(3))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                 for r in dc.decontaminate(d, b, size).collect())
    assert got == brute(docs, items, size)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_BYTES", -1)
    docs, items = fixture(4)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                 for r in dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                           spark.createDataFrame(items, "item_id long, text string")).collect())
    assert got == brute(docs, items, 10)


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"]) for r in dc.decontaminate(docs, items.where("item_id > 1")).collect()] == [(3, 0)]
    assert dc.decontaminate(docs.where("doc_id > 1"), items).count() == 0


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = dc.with_key(spark.createDataFrame(
        [(1, "alpha beta gamma delta"), (2, "alpha x beta y"), (3, "alpha " + "x " * 9 + "beta"), (4, "beta alpha gamma delta"),
         (5, "nothing")], "doc_id long, text string"))
    texts, _ = dc.test_texts(items)

    def found(slack):
        hits = dc.proximity_matches(docs, texts, slack).select(*dc.KEY).distinct()
        return sorted(r["doc_id"] for r in docs.join(hits, dc.KEY).collect())

    # the rarest two are gamma and delta
    assert found(0) == [1, 4]
    docs = dc.with_key(spark.createDataFrame(
        [(1, "gamma x delta alpha beta"), (2, "delta gamma alpha beta"), (3, "gamma " + "x " * 9 + "delta"), (4, "alpha beta " * 4)],
        "doc_id long, text string"))
    assert found(1) == [1] and found(2) == [1, 2] and found(9) == [1, 2, 3]


def test_one_repeated_word(spark):
    """Every place of a long text is a candidate: work stays linear in them."""
    docs = spark.createDataFrame([(1, "a " * 300_000), (2, "a " * 29), (3, "b " * 50), (4, ("a " * 9 + "b ") * 20_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a " * 30), (2, "a " * 9 + "b " + "a " * 9 + "c")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in dc.decontaminate(docs, items).collect()}
    assert got == {1: (300_000, 300_000, 1), 2: (29, 29, 1), 3: (50, 0, 0), 4: (200_000, 199_999 + 1, 1)}


def test_texts_are_split_once(spark):
    """No split stands inside a function over an array: it would run for each element."""
    import re as re_

    from lapse import session
    plans = []
    session.MATERIALIZE_HOOKS.append(lambda name, df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()))
    try:
        docs, items = fixture(1)
        out = dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    finally:
        session.MATERIALIZE_HOOKS.pop()
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert any("split(" in p for p in plans)
    for plan in plans:
        assert not re_.search(r"lambdafunction\([^\n]*split\(", plan), plan


def test_drop_keeps_rows_and_columns(spark):
    docs, items = fixture(2)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("dkey", F.lit("x")).withColumn("row", F.lit(2))
    got = dc.drop_contaminated(d, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == d.columns
    want = [r for r in docs if not brute([r], items, 10)[0][5]]
    assert sorted(str((r["doc_id"], r["text"])) for r in got.collect()) == sorted(map(str, want)) and 0 < len(want) < len(docs)
