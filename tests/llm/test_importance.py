"""Importance resampling: features against a plain version, SQL, edges, ties."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lapse.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % importance.BUCKETS


def plain(docs, target, share=25):
    """Rows of the contract, one by one."""
    count = lambda texts: Counter(bucket(f) for t in texts for f in plain_features(t)[1])
    s, t = count(x for _, x in docs), count(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for doc, text in docs:
        words, found = plain_features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in map(bucket, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    for i, r in enumerate(able[:share * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def drawn(spark, docs, target):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "'y' AS bucket").repartition(3)
    t = spark.createDataFrame([(x,) for x in target], "text string").selectExpr("*", "1 AS line")
    got = importance.draw(importance.weigh(d, importance.gains_of(d, t)))
    return sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank", "n_words").collect()), key=str)


SYLLABLES = "ka lo mi ren ta vu é 中 \U0001f600 9".split()


def text(rng, words):
    return "".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) + rng.choice([" ", " ", ", ", "\n", "\n\n", "-\n ", " "])
                   for _ in range(words))


def test_against_plain(spark):
    rng = random.Random(3)
    lines = [text(rng, 6).replace("\n", " ") for _ in range(5)]
    docs = [(i, text(rng, rng.randint(0, 60)) + "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(120)]
    docs += [(None, docs[3][1]), (None, docs[3][1]), (7, docs[7][1]), (500, None), (501, ""), (502, " \n\n\x00\n"), (503, "one"), (504, "A\nb\n\nC")]
    docs += [(600, "ABC def " * 12)] * 9
    target = [text(rng, 40), lines[0], None, "", "abc DEF"]
    assert drawn(spark, docs, target) == plain(docs, target)


def test_empty_tables(spark):
    docs = [(1, "a b c " * 10), (2, None)]
    assert drawn(spark, docs, []) == plain(docs, [])
    assert drawn(spark, [], ["a b"]) == []


def test_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    assert (sorted(map(tuple, importance.op11_importance_resampling(spark, sf_dir).collect()), key=str)
            == sorted(con.execute(importance.OP11_SQL).fetchall(), key=str))


def test_joined_crc():
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 7, 300, 70_000]))) for _ in range(60)]
    crc = np.array([zlib.crc32(w) for w in words], np.uint32)
    size = np.array([len(w) for w in words])
    got = importance.joined_crc(crc[:-1], crc[1:], size[1:])
    assert got.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]


@pytest.mark.parametrize("at_once", [1, 5, 40, 1 << 20])
def test_pieces_of_long_lines(monkeypatch, at_once):
    monkeypatch.setattr(importance, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    lines = ["", "   ", text(rng, 80).replace("\n", " "), "x" * 200, "-" * 100 + "a" + "-" * 100 + "b", text(rng, 3).replace("\n", ""), "-" * 99]
    found = Counter()
    for line, bucket_ in importance.features_of([x.encode() for x in lines], importance.BUCKETS):
        found.update(zip(line.tolist(), bucket_.tolist()))
    assert found == Counter((i, bucket(f)) for i, x in enumerate(lines) for f in plain_features(x)[1])


def test_resample_keeps_columns(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, text(rng, 30), "en") for i in range(40)], "doc_id long, text string, weight string")
    got = importance.resample(docs, docs.where("doc_id < 5"), 50)
    assert got.columns == docs.columns and got.count() == 20
