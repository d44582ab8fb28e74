"""Substring dedup: repeated word windows, found by Aho-Corasick automata.

1. ``seeds``: each window of ``window`` words is known by the least hash of the
   ``SEED_WORDS``-word phrases in it; equal windows have equal seeds, so only
   windows whose seed recurs can recur.
2. ``confirm``: windows with a recurring seed are counted by 96 bits of hash
   over their whole word sequence; a recurring one gets the smallest doc_id it
   starts in.
3. ``locate``: each block of documents compiles the passages (runs of confirmed
   windows) that its documents need into an automaton over word codes (so a
   match is the whole word sequence, not a hash) and streams all its documents
   through it.

Documents are dealt into blocks by a hash of id and text, so automata stay of
one size and a document meets one automaton, whatever the number of phrases.
Hashes travel as arrays, one row for each bucket that a batch has something
for.  A phrase that a third of the documents share is one entry per batch among
the seeds and one per block among the windows.  Blocks and buckets grow in
number with the text.

Defined cases: null and empty texts have no words; texts shorter than a window
lose nothing; rows with one doc_id don't take words from each other; a null
doc_id counts as larger than all others; repeated rows give a row each; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import read_table
from lapse.llm.hashing import mix, phrase_hash, word_hashes
from lapse.session import materialize

WINDOW = 13
SEED_WORDS = 4
BLOCK_BYTES = 4 << 20
LEAST_BUCKETS = 32
CHUNK_WORDS = 1 << 19
NO_ID = np.iinfo(np.int64).max


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    span = 1
    while span < n:
        step = min(span, n - span)
        x = np.minimum(x[:len(x) - step], x[step:])
        span += step
    return x


class Chunk:
    """Words of several documents in one row of arrays."""

    def __init__(self, texts: list[bytes], window: int):
        self.words = [t.split() for t in texts]         # bytes: ASCII white space only
        sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        total = int(self.first[-1])
        self.hash = np.concatenate([np.zeros(0, np.uint64), *map(word_hashes, self.words)])
        doc = np.repeat(np.arange(len(texts)), sizes)
        size = max(0, total - window + 1)
        self.starts = np.flatnonzero(doc[:size] == doc[window - 1:]) if size else np.zeros(0, np.int64)
        self.doc = doc[self.starts]                     # of each whole window
        self.window = window

    def seeds(self) -> np.ndarray:
        """Seed of each whole window."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        phrases = phrase_hash(self.hash, SEED_WORDS, 1)
        return sliding_min(phrases, self.window - SEED_WORDS + 1)[self.starts]

    def hashes(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits of hash over the whole of the chosen windows (by number)."""
        at = self.starts[chosen]
        long = phrase_hash(self.hash, self.window, 2)[at]
        return long, (phrase_hash(self.hash, self.window, 3)[at] >> np.uint64(32)).astype(np.uint32)


def chunks(texts: list[bytes], window: int) -> Iterator[tuple[int, Chunk]]:
    """(number of the first document, chunk); a chunk ends after enough bytes."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= 6 * CHUNK_WORDS or i + 1 == len(texts):
            yield begin, Chunk(texts[begin:i + 1], window)
            begin, size = i + 1, 0


def _bytes(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column.cast(pa.binary())]


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _block(doc: int, text: bytes, blocks: int) -> int:
    return xxhash.xxh64_intdigest(text, seed=xxhash.xxh32_intdigest(str(doc))) % blocks


def _spread(where: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, row numbers) of the buckets that have rows."""
    order = np.argsort(where, kind="stable")
    edges = np.flatnonzero(np.append(True, where[order][1:] != where[order][:-1])) if len(where) else []
    for a, b in zip(edges, [*edges[1:], len(where)]):
        yield int(where[order[a]]), order[a:b]


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


SHARED = -1         # instead of a block: the batch has told its blocks
SEED_ROWS = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("seed", pa.list_(pa.int64())), ("tag", pa.list_(pa.int32()))])
NEED_ROWS = pa.schema([("block", pa.int32()), ("seed", pa.list_(pa.int64()))])
WINDOW_ROWS = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("long", pa.list_(pa.int64())),
                         ("short", pa.list_(pa.int32())), ("least", pa.list_(pa.int64())), ("many", pa.list_(pa.bool_()))])
FOUND_ROWS = pa.schema([("block", pa.int32()), ("long", pa.list_(pa.int64())), ("short", pa.list_(pa.int32())),
                        ("least", pa.list_(pa.int64()))])
TEXT_ROWS = pa.schema([("block", pa.int32()), ("texts", pa.binary())])
KEPT_ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} " + (f"array<{names[f.type.value_type]}>" if pa.types.is_list(f.type) else names[f.type])
                     for f in schema)


def _seeds(window: int, blocks: int, buckets: int):
    """Map: the distinct seeds of a batch.

    A seed that two documents of the batch share is known to recur, and one in
    rows of one doc_id in several blocks may: its blocks are told right away, and its bucket gets one entry for the whole batch, so
    a phrase that a third of all documents share is one entry per batch there.
    Any other seed is an entry of its bucket with its block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = _ids(batch["doc_id"]), _bytes(batch["text"])
            parts = []
            for begin, chunk in chunks(texts, window):
                seed, doc = chunk.seeds(), chunk.doc
                fresh = np.append(True, (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])) if len(seed) else np.zeros(0, bool)
                parts.append((seed[fresh], doc[fresh] + begin))
            seed, row = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            if not len(seed):
                continue
            block = np.fromiter((_block(int(i), t, blocks) for i, t in zip(ids, texts)), np.int64, len(texts))[row]
            order = np.lexsort((block, seed))
            seed, block, doc = seed[order], block[order], ids[row[order]]
            heads = np.flatnonzero(np.append(True, seed[1:] != seed[:-1]))
            # an entry has one block, so rows of one id in several blocks are told as well
            shared = np.logical_or(*(np.maximum.reduceat(x, heads) != np.minimum.reduceat(x, heads) for x in (doc, block)))
            first, tag = seed[heads], np.where(shared, SHARED, block[heads]).astype(np.int32)
            rows = []
            for bucket, at in _spread((mix(first) % np.uint64(buckets)).astype(np.int64)):
                rows.append((bucket, None, first[at].view(np.int64), tag[at]))
            told = np.repeat(shared, np.diff(np.append(heads, len(seed))))
            seed = seed[told]
            for b, at in _spread(block[told]):
                rows.append((b % buckets, b, np.unique(seed[at]).view(np.int64), None))
            yield _rows(SEED_ROWS, rows)

    return run


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _recurring_seeds(table: pa.Table) -> pa.Table:
    """Reduce: of one bucket, the seeds that recur, for each block that has them; what blocks were told goes on."""
    told = table.filter(table["block"].is_valid())
    rows = [(b.as_py(), s.values.to_numpy()) for b, s in zip(told["block"], told["seed"])]
    open_ = table.filter(table["block"].is_null())
    seed, tag = _column(open_, "seed"), _column(open_, "tag")
    order = np.argsort(seed, kind="stable")
    seed, tag = seed[order], tag[order]
    heads = np.flatnonzero(np.append(True, seed[1:] != seed[:-1])) if len(seed) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(seed)))
    many = np.repeat(sizes > 1, sizes) & (tag != SHARED)        # an entry per batch: two are two documents
    seed, block = seed[many], tag[many]
    rows += [(b, np.unique(seed[at])) for b, at in _spread(block)]
    return pa.Table.from_batches([_rows(NEED_ROWS, rows)])


def _pack_texts(window: int, blocks: int):
    """Map: the documents of a batch by block, compressed; repeated rows once with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            found: dict[int, dict[tuple, int]] = {}
            for doc, text in zip(_ids(batch["doc_id"]).tolist(), _bytes(batch["text"])):
                docs = found.setdefault(_block(doc, text, blocks), {})
                docs[doc, text] = docs.get((doc, text), 0) + 1
            rows = []
            for block, docs in found.items():
                head = np.array([(d, n, len(t)) for (d, t), n in docs.items()], np.int64)
                body = b"".join([np.int64(len(head)).tobytes(), head.tobytes(), *(t for _, t in docs)])
                rows.append((block, packer.compress(body)))
            yield _rows(TEXT_ROWS, rows)

    return run


def _unpack_texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(doc ids, times, texts) of the rows that carry texts."""
    ids, times, texts = [], [], []
    for packed in table["texts"].drop_null():
        body = zstandard.ZstdDecompressor().decompress(packed.as_py())
        n = int(np.frombuffer(body, np.int64, 1)[0])
        head = np.frombuffer(body, np.int64, 3 * n, 8).reshape(-1, 3)
        ids.append(head[:, 0])
        times.append(head[:, 1])
        at = 8 + 24 * n
        for size in head[:, 2].tolist():
            texts.append(body[at:at + size])
            at += size
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ids]), np.concatenate([none, *times]), texts


def _windows(window: int, buckets: int):
    """Per block: hashes of the windows whose seed recurs, with the least doc_id of the block."""

    def run(table: pa.Table) -> pa.Table:
        ids, _, texts = _unpack_texts(table)
        need = np.unique(_column(table, "seed").view(np.uint64))
        block = table["block"][0].as_py()
        parts = []
        for begin, chunk in chunks(texts, window):
            chosen = np.flatnonzero(np.isin(chunk.seeds(), need))
            parts.append((*chunk.hashes(chosen), ids[begin + chunk.doc[chosen]]))
        long, short, doc = (np.concatenate(p) for p in zip(*parts)) if parts else [np.zeros(0, np.uint64)] * 3
        order = np.lexsort((doc, short, long))
        long, short, doc = long[order], short[order], doc[order]
        rows = []
        if len(long):
            heads = np.flatnonzero(np.append(True, (long[1:] != long[:-1]) | (short[1:] != short[:-1])))
            many = np.maximum.reduceat(doc, heads) != doc[heads]
            long, short, doc = long[heads], short[heads], doc[heads]
            for bucket, at in _spread((mix(long) % np.uint64(buckets)).astype(np.int64)):
                rows.append((bucket, block, long[at].view(np.int64), short[at].view(np.int32), doc[at], many[at]))
        return pa.Table.from_batches([_rows(WINDOW_ROWS, rows)])

    return run


def _confirm(table: pa.Table) -> pa.Table:
    """Reduce: of one bucket, the recurring windows with their least doc_id, for each block with a larger one."""
    sizes = table["long"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    block = np.repeat(table["block"].to_numpy(), sizes)
    long, short = _column(table, "long"), _column(table, "short")
    least, many = _column(table, "least"), _column(table, "many")
    order = np.lexsort((least, short, long))
    block, long, short, least, many = (x[order] for x in (block, long, short, least, many))
    heads = np.flatnonzero(np.append(True, (long[1:] != long[:-1]) | (short[1:] != short[:-1]))) if len(long) else np.zeros(0, np.int64)
    first = np.repeat(least[heads], np.diff(np.append(heads, len(long))))
    take = (least > first) | many
    rows = []
    block, long, short, first = block[take], long[take], short[take], first[take]
    for b, at in _spread(block):
        rows.append((b, long[at], short[at], first[at]))
    return pa.Table.from_batches([_rows(FOUND_ROWS, rows)])


class Automaton:
    """Aho-Corasick automaton over passages: runs of words in which every window is confirmed.

    A passage comes with the least doc_id of each of its windows.  A word of a
    passage is coded by two characters from two alphabets, so codes can't be
    read out of step and the fan-out of a node stays small; other words get a
    code that no passage has.
    """

    OTHER = "\x01\x02"

    def __init__(self, passages: Iterator[tuple[list[bytes], np.ndarray]], window: int):
        self.window = window
        passages = list(passages)
        vocabulary = sorted({w for p, _ in passages for w in p})
        base = int(np.ceil(np.sqrt(len(vocabulary)))) + 1
        # characters from the plane above surrogates, two alphabets
        self.code = {w: chr(0x10000 + i // base) + chr(0x10000 + base + i % base) for i, w in enumerate(vocabulary)}
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.least: list[tuple[np.ndarray, int]] = []       # of each passage: per window, and the largest
        for words, least in passages:
            passage = "".join(map(self.code.__getitem__, words))
            if passage not in self.machine:
                self.machine.add_word(passage, len(self.least))
                self.least.append((least, int(least.max())))
        if passages:
            self.machine.make_automaton()

    def covered(self, words: list[bytes], doc: int) -> np.ndarray:
        """Mask of the words inside any window of a passage that starts in a smaller document."""
        mask = np.zeros(len(words) + 1, np.int64)
        if self.code:
            other = self.OTHER
            text = "".join([self.code.get(w, other) for w in words])
            for end, number in self.machine.iter(text):
                least, most = self.least[number]
                stop = end // 2 + 1
                begin = stop - len(least) - self.window + 1
                if most < doc:
                    mask[begin] += 1
                    mask[stop] -= 1
                else:
                    at = begin + np.flatnonzero(least < doc)
                    mask[at] += 1
                    mask[at + self.window] -= 1
        return np.cumsum(mask[:-1]) > 0


def _needed_passages(table: pa.Table, ids: np.ndarray, texts: list[bytes], window: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The passages that the documents of one block share with smaller ones, read from its own texts."""
    long, short, least = _column(table, "long").view(np.uint64), _column(table, "short").view(np.uint32), _column(table, "least")
    if not len(long):
        return
    order = np.lexsort((short, long))
    long, short, least = long[order], short[order], least[order]
    for begin, chunk in chunks(texts, window):
        a, b = chunk.hashes(np.arange(len(chunk.starts)))
        at = np.searchsorted(long, a)
        first = np.full(len(a), NO_ID)
        open_ = np.flatnonzero(at < len(long))
        while len(open_):                               # more than once only if 64 bits are equal and 32 aren't
            open_ = open_[long[at[open_]] == a[open_]]
            equal = short[at[open_]] == b[open_]
            first[open_[equal]] = least[at[open_[equal]]]
            open_ = open_[~equal]
            at[open_] += 1
            open_ = open_[at[open_] < len(long)]
        hit = np.flatnonzero(first < ids[begin + chunk.doc])
        cuts = np.flatnonzero((np.diff(chunk.starts[hit]) != 1) | (np.diff(chunk.doc[hit]) != 0)) + 1
        for run in np.split(hit, cuts):
            if len(run):
                d = int(chunk.doc[run[0]])
                i = int(chunk.starts[run[0]] - chunk.first[d])
                yield chunk.words[d][i:i + len(run) + window - 1], first[run]


def _locate(window: int):
    """Per block: compile the needed passages, stream all documents, keep the words that none covers."""

    def run(table: pa.Table) -> pa.Table:
        ids, times, texts = _unpack_texts(table)
        machine = Automaton(_needed_passages(table, ids, texts, window), window)
        rows = []
        for doc, n, text in zip(ids.tolist(), times.tolist(), texts):
            words = text.split()
            gone = machine.covered(words, doc)
            kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
            row = (None if doc == NO_ID else doc, len(words), len(words) - len(kept), b" ".join(kept).decode())
            rows += [row] * n
        return pa.Table.from_batches([_rows(KEPT_ROWS, rows)])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs`` (doc_id, text).

    ``kept`` has the words that no window covers which also starts in a document
    with a smaller doc_id, joined by one space.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    buckets = max(LEAST_BUCKETS, blocks)
    texts = docs.mapInArrow(_pack_texts(window, blocks), _ddl(TEXT_ROWS))

    def with_texts(found: DataFrame) -> DataFrame:
        return texts.unionByName(found, allowMissingColumns=True).groupBy("block")

    seeds = (docs.mapInArrow(_seeds(window, blocks, buckets), _ddl(SEED_ROWS))
             .groupBy("bucket").applyInArrow(_recurring_seeds, _ddl(NEED_ROWS)))
    seeds = materialize(seeds, "seeds")
    found = (with_texts(seeds).applyInArrow(_windows(window, buckets), _ddl(WINDOW_ROWS))
             .groupBy("bucket").applyInArrow(_confirm, _ddl(FOUND_ROWS)))
    found = materialize(found, "repeats")
    return with_texts(found).applyInArrow(_locate(window), _ddl(KEPT_ROWS))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, and the digest of what is left."""
    kept = remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT rid, doc_id, s, array_to_string(list_slice(w, s + 1, s + 13), ' ') AS k
  FROM (SELECT rid, doc_id, w, unnest(range(0, len(w) - 12)) AS s FROM d WHERE len(w) >= 13)),
least_id AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT rid, unnest(range(s, s + 13)) AS p FROM win JOIN least_id ON win.k = least_id.k WHERE first < doc_id),
words AS (SELECT rid, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d),
left_over AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM words ANTI JOIN gone ON words.rid = gone.rid AND words.p = gone.p GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over ON d.rid = left_over.rid
"""
