"""Packing: ids against the tokenizers library, best fit against a plain version, whole sequences."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lapse.llm import packing


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            r, i = min(fits)
            rooms[i] = r - n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_moves_are_best_fit_decreasing():
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 64, 100):
        for _ in range(30):
            lengths = rng.integers(1, capacity + 1, rng.integers(0, 200)).tolist()
            histogram = {n: lengths.count(n) for n in set(lengths)}
            rooms, placed = {}, {n: 0 for n in histogram}
            for n, a, b, first, per, used in packing.best_fit_moves(histogram, capacity):
                assert a == placed[n]
                placed[n] = b
                for k in range(b - a):
                    seq = first + k // per
                    assert rooms.get(seq, capacity) == capacity - used - (k % per) * n
                    rooms[seq] = capacity - used - (k % per + 1) * n
                    assert rooms[seq] >= 0
            assert placed == histogram
            assert sorted(rooms.values()) == plain_best_fit(lengths, capacity)


def test_pack_documents(spark):
    path = packing.vocabulary_path()
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {1: "Hello world", 2: None, 3: "", 4: "x y " * 5000, 5: "café \U0001f600  \n\n tabs\t", 6: "<|endoftext|> a",
             7: "Hello world", 8: "long " * 2047, 9: "'s 'll 12345 中文"}
    docs = spark.createDataFrame([*texts.items(), (1, "Hello world")], "doc_id long, text string")
    docs = docs.selectExpr("*", "'a' AS length", "'b' AS rank", "'c' AS ids")
    out = packing.pack_documents(docs, path, with_ids=True)
    rows = out.collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        want = reference.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[doc], key=lambda r: (r["piece"]))
        if doc == 1:
            assert len(pieces) == 2
            pieces = pieces[:1]
        assert [i for p in pieces for i in p["ids"]] == want
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert all(p["length"] == 2048 for p in pieces[1:])
        at = 0
        for p in pieces:
            assert p["start"] == at and p["length"] == len(p["ids"])
            assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
            at += p["length"]
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    for r in packing.packed_sequences(out).collect():
        assert r["ids"] == [i for p in sorted(by_seq[r["sequence_id"]], key=lambda r: r["offset"]) for i in p["ids"]]
    assert packing.pack_documents(docs.where("doc_id > 100"), path).count() == 0


def test_ids_equal_tokenizers_on_documents():
    import pyarrow.parquet as pq
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = packing.vocabulary_path()
    for text in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist():
        assert packing.encode(text, path).tolist() == reference.encode(text or "", add_special_tokens=False).ids + [0]


def test_runs_of_over_a_million_spaces():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path, n = packing.vocabulary_path(), 1_000_100
    for text in (" " * n, "\n" * n, "a" + " " * n + "b  c", "it's\n" + "\n" * n + "'s x", "　 \t" * (n // 3 + 1) + "1",
                 "x" + " " * n + "<|endoftext|>" + "\n" * n + "\x1c y" + " \n" * n + "!", "a" + " " * 200_000 + "b" + " " * n):
        assert packing.encode(text, path).tolist() == reference.encode(text, add_special_tokens=False).ids + [0]
