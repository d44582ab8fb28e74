"""The corpus pipeline against the operators and brute force, stage by stage."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_decontamination import split
from test_secrets import base
from test_simhash import brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from lapse.llm import secrets, simhash, toxicity


def components(docs):
    fps = [brute_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if bin(a ^ fps[j]).count("1") <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    best = {}
    for i, (d, _) in enumerate(docs):
        best[find(i)] = min(best.get(find(i), d), d)
    return {best[r] for r in best}


def test_stages(spark, sf_dir, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append((before, docs))
        if name != "best_fit_packing":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    before, after = kept[0]
    op6 = toxicity.op6_toxicity(spark, sf_dir).where("predicted = 0")
    assert ids(after) == ids(op6)

    before, after = kept[1]
    assert ids(after) == sorted(components([(r["doc_id"], r["text"]) for r in before.collect()]))

    before, after = kept[2]
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = split(r["text"])
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} - {()}
    clean = [r["doc_id"] for r in before.collect()
             if not any(tuple(w[i:i + n]) in windows for w in [split(r["text"])]
                        for n in {len(x) for x in windows} for i in range(len(w) - n + 1))]
    assert ids(after) == sorted(clean)

    before, after = kept[3]
    texts = {r["doc_id"]: r for r in after.collect()}
    model = secrets.train(secrets.labelled_samples(before))
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan(before, model).collect()}
    for r in before.collect():
        new = texts.pop(r["doc_id"])
        assert len(spans[r["doc_id"]]) >= len(base(r["text"]))
        if not spans[r["doc_id"]]:
            assert new == r
        else:
            assert not base(new["text"]) and secrets.PLACEHOLDER in new["text"] and new["n_chars"] == len(new["text"])
    assert not texts

    before, after = kept[4]
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in after.collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for r in before.collect():
        ids_ = np.array(reference.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by_doc.pop(r["doc_id"]), key=lambda p: p["piece"])
        assert sum(p["length"] for p in pieces) == len(ids_)
        for p in pieces:
            assert p["ids_crc32"] == zlib.crc32(ids_[p["start"]:p["start"] + p["length"]].tobytes())
    assert not by_doc
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048


def test_edge_rows_pass_every_stage(spark, tmp_path):
    """Nulls in any column, empty and repeated rows, an extra column, then an empty table."""
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some words without id", None, "s", 3),
            (5, "x " * 60_000, "en", None, 120_000), (6, "token = abcdefghijklmnop", "en", "s", 24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("dkey", F.lit(1))
    docs = docs.withColumn("rid", F.lit("kept"))
    for start in (docs, docs.where("source = 'none'")):
        now, n = start, []
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            n.append(now.count())
            if name != "best_fit_packing":
                assert {(r["dkey"], r["rid"]) for r in now.collect()} <= {(1, "kept")} and now.columns == start.columns
        assert n[0] == start.count() and n[-1] >= n[-2] == n[1]
    one = simhash.keep_one(docs)
    assert sorted(str(r["doc_id"]) for r in one.collect()) == ["1", "5", "6", "None"]
