"""Substring dedup against a brute-force version."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    docs = [(d if d is not None else substring.NO_ID, WORD.findall(t or "")) for d, t in rows]
    least = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            least[key] = min(least.get(key, d), d)
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((None if d == substring.NO_ID else d, len(w), len(gone),
                    " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def sample(seed, n=120, vocabulary=30):
    rng = np.random.default_rng(seed)
    passages = [" ".join(f"p{x}" for x in rng.integers(0, vocabulary, 25)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [" ".join(f"w{x}" for x in rng.integers(0, vocabulary, rng.integers(0, 40)))]
        for _ in range(rng.integers(0, 3)):
            parts.append(passages[rng.integers(0, 8)])
            parts.append("é  x" + "\t".join(f"v{x}" for x in rng.integers(0, 5, 9)))
        rows.append((int(rng.integers(0, 90)), "\n".join(parts)))
    rows += [rows[0], rows[1], (500, rows[2][1]), (None, rows[3][1]), (None, rows[3][1]), (501, None), (502, ""), (503, " \n"),
             (504, "one two"), (505, "a " * 300), (1, "a " * 40), (506, " ".join(f"u{i}" for i in range(13))),
             (2, " ".join(f"u{i}" for i in range(13)))]
    return rows


@pytest.mark.parametrize("window,block_bytes", [(13, 1 << 20), (13, 3000), (5, 2000)])
def test_matches_brute_force(spark, window, block_bytes):
    rows = sample(window)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x")).withColumn("block", F.lit(1)).repartition(5)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"])
                  for r in substring.remove_repeats(docs, window, block_bytes).collect()), key=str)
    assert got == brute(rows, window)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring.remove_repeats(docs).count() == 0


def test_small_chunks(monkeypatch, spark):
    monkeypatch.setattr(substring, "CHUNK_WORDS", 20)
    rows = sample(9, 40)
    texts = [(t or "").encode() for _, t in rows]
    split = [c for _, c in substring.chunks(texts, 13)]
    assert len(split) > 5 and [w for c in split for w in c.words] == [t.split() for t in texts]


def test_automaton_matches_words_not_parts():
    a = substring.Automaton(iter([([b"a", b"b"], np.array([1])), ([b"b", b"a"], np.array([3]))]), 2)
    assert a.covered([b"a", b"b", b"a", b"ab", b"b"], 2).tolist() == [True, True, False, False, False]
    assert a.covered([b"a", b"b", b"a", b"ab", b"b"], 4).tolist() == [True, True, True, False, False]


def test_passage_covers_only_windows_of_smaller_documents():
    a = substring.Automaton(iter([([b"a", b"b", b"c", b"d"], np.array([1, 7, 2]))]), 2)
    assert a.covered([b"x", b"a", b"b", b"c", b"d"], 5).tolist() == [False, True, True, True, True]
    assert a.covered([b"x", b"a", b"b", b"c", b"d"], 2).tolist() == [False, True, True, False, False]
    assert a.covered([b"a", b"b", b"c"], 9).tolist() == [False, False, False]


def test_documents_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"])
                  for r in substring.remove_repeats(docs, block_bytes=1 << 16).collect()), key=str)
    assert got == brute(rows, 13)


def test_rows_of_one_id_in_several_blocks(spark):
    """Rows without an id in one batch, in several blocks; the smaller document is in another partition."""
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(None, f"{passage} " + " ".join(f"t{k}x{i}" for i in range(30))) for k in range(12)]
    rows += [(7, f"{passage} and " + " ".join(f"s{k}x{i}" for i in range(30))) for k in range(12)]
    blocks = 1 + sum(len(t) for _, t in [*rows, (5, passage)]) // 1000
    assert len({substring._block(substring.NO_ID, t.encode(), blocks) for _, t in rows[:12]}) > 1
    rows += [(5, passage), *((50 + k, "") for k in range(11))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"])
                  for r in substring.remove_repeats(docs, block_bytes=1000).collect()), key=str)
    want = brute(rows, 13)
    assert got == want and sum(r[2] == 20 for r in want) == 24
