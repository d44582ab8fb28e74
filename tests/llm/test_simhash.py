"""SimHash: fingerprints, index search and components against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lapse.llm import simhash


def brute_fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ")
             .replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def brute_sets(values, distance):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if bin(int(a) ^ int(b)).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def family(rng, n, center, flips):
    out = []
    for _ in range(n):
        x = center
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


def sample(seed=3):
    rng = np.random.default_rng(seed)
    values = [int(x) for x in rng.integers(0, 2**63, 200)] + [0, (1 << 64) - 1]
    for _ in range(6):
        values += family(rng, 60, int(rng.integers(0, 2**63)) * 2 + 1, 5)
    return sorted(set(values))


@pytest.mark.parametrize("text", [None, "", "  \t\n", "One", "a b c", "A bÉ c D e f \x0b g", "x " * 500, "  not a space"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_node_sets_match_brute_force():
    values = sample()

    def rank(x):
        for by in (1, 2, 4, 8, 16, 32):
            x ^= x >> by
        return x

    values.sort(key=rank)
    label = simhash.node_sets(np.array(values, np.uint64), 4)
    want = brute_sets(values, 4)
    got = {}
    for v, lab in zip(values, label):
        got.setdefault(int(lab), set()).add(v)
    expected = {}
    for v, r in want.items():
        expected.setdefault(r, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("node_rows", [100_000, 12])
def test_links_and_components(spark, node_rows):
    values = sample(5)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    links = simhash.near_links(fps, 4, node_rows)
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    signed = [simhash._signed(v) for v in values]
    want = brute_sets(values, 4)
    groups = {}
    for v, s in zip(values, signed):
        groups.setdefault(want[v], []).append(s)
    for g in groups.values():
        if len(g) == 1:
            assert g[0] not in roots
        else:
            assert {roots[s] for s in g} == {min(g)}


def test_chain_components(spark):
    n = 300
    order = np.random.default_rng(1).permutation(n)
    links = spark.createDataFrame([(int(order[i]), int(order[i + 1])) for i in range(n - 1)], "a long, b long")
    rows = simhash.components(links).collect()
    assert len(rows) == n and {r["root"] for r in rows} == {0}
    assert simhash.components(links.where("a < 0")).count() == 0


def test_documents_edges(spark):
    base = " ".join(f"word{i}" for i in range(400))
    docs = spark.createDataFrame(
        [(5, base), (3, base), (3, base), (9, base.upper()), (7, None), (2, ""), (None, "lonely text with no id at all"),
         (None, base), (8, "completely different words stand in this one here")],
        "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    rows = simhash.near_duplicates(docs).collect()
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in rows)
    assert got == sorted((str(a), str(b)) for a, b in [
        (5, 3), (3, 3), (3, 3), (9, 3), (7, 2), (2, 2), (None, None), (None, 3), (8, 8)])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "8", "None"]
    assert simhash.near_duplicates(docs.where("doc_id < 0")).count() == 0


def test_keep_one_when_scans_are_split_anew(spark, tmp_path, monkeypatch):
    """Files are packed into other partitions after the fingerprints are written, as when executors come or go."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 60)) for _ in range(64)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[:32])]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(16).write.parquet(path)
    found = simhash.near_duplicates

    def near_duplicates(*args):
        out = found(*args)
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        return out

    monkeypatch.setattr(simhash, "near_duplicates", near_duplicates)
    spark.conf.set("spark.sql.files.minPartitionNum", "16")
    try:
        kept = sorted(r["doc_id"] for r in simhash.keep_one(spark.read.parquet(path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert kept == list(range(64))
