"""Best-fit-decreasing packing of tokenized documents into fixed-length sequences.

Pieces of one length are interchangeable, and so are open sequences with the
same room.  So best-fit decreasing runs over the histogram of lengths: a segment
tree over remaining capacities (one leaf per capacity, holding runs of
consecutive sequence numbers) gives the tightest open sequence in logarithmic
time, and a run of equal sequences takes a run of equal pieces in one move.
The histogram has at most ``capacity`` rows however many documents there are,
and the list of moves is bounded by the capacity as well, so this runs on the
driver; the rest is distributed: pieces are numbered within their length by
salted windows and find their move by a broadcast join.  The packing is the one
best fit gives for the whole table, not one per partition.

Tokens come from a byte-level BPE vocabulary in rank form (its path is a
parameter).  It gives the ids that the ``tokenizers`` file of the vocabulary
gives, at several times the speed; tests compare both.

Defined cases: a null text is empty and gives the end id alone; longer documents
are cut so that only their first piece is short; repeated rows are packed each;
an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import number_within, read_table
from lapse.session import materialize

CAPACITY = 2048
END_ID = 0
RANK_BUCKETS = 256
SPECIAL = {"<|endoftext|>": 50256}      # fixed value of the vocabulary
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")
_ENCODERS: dict = {}


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """The encoder of a rank file, built once per process."""
    if path not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        _ENCODERS[path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODERS[path]


def _ids(text: str, path: str) -> np.ndarray:
    return encoder(path).encode_to_numpy(text, allowed_special="all", disallowed_special=())


def _ids_around_runs(text: str, path: str) -> np.ndarray:
    """Ids of a text whose runs of white space are too long for the pattern's backtracking.

    As the pattern has it, such a run is one piece, without its last character
    if other text than a special token follows; what is between runs has no
    match that reaches into them.
    """
    parts, at = [], 0
    for run in LONG_RUN.finditer(text):
        begin, end = run.span()
        if end < len(text) and not text.startswith(tuple(SPECIAL), end):
            end -= 1
        parts += [_ids(text[at:begin], path), encoder(path)._encode_single_piece(text[begin:end])]
        at = end
    return np.concatenate([*parts, _ids(text[at:], path)])


def encode(text: str | None, path: str) -> np.ndarray:
    """Ids of the whole text and the end id."""
    try:
        ids = _ids(text or "", path)
    except ValueError:                  # about a million characters of white space in a row
        ids = _ids_around_runs(text, path)
    return np.append(ids, END_ID).astype("<u4")


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of the documents (doc_id, text), at most ``capacity`` ids each; ``ids`` on request."""
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = encode(text.as_py(), path)
                first = (len(ids) - 1) % capacity + 1
                starts = [0, *range(first, len(ids), capacity)]
                for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    row = (doc, n, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    out.append((*row, ids[a:b].astype("i4")) if with_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = [f.split()[0] for f in schema.split(", ")]
            columns = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


class CapacityTree:
    """Segment tree over remaining capacities; a leaf holds runs [first sequence, count]."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves < capacity + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.runs: list[list[list[int]]] = [[] for _ in range(self.leaves)]

    def add(self, room: int, first: int, n: int) -> None:
        if n:
            self.runs[room].append([first, n])
            self._change(room, n)

    def _change(self, room: int, n: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += n
            at //= 2

    def take(self, room: int, n: int) -> tuple[int, int]:
        """Up to ``n`` consecutive sequences with this room: (first, how many)."""
        run = self.runs[room][-1]
        got = min(n, run[1])
        first = run[0]
        run[0] += got
        run[1] -= got
        if not run[1]:
            self.runs[room].pop()
        self._change(room, -got)
        return first, got

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` with an open sequence."""
        at = need + self.leaves
        if self.count[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_moves(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Moves (length, first rank, end rank, first sequence, pieces per sequence, tokens before them).

    Lengths go from long to short.  After a piece is put into the tightest
    sequence, that one is still the tightest while the next equal piece fits, so
    each sequence of a run takes ``room // length`` of them.
    """
    tree, moves, opened = CapacityTree(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            per = (capacity if room is None else room) // length
            want = -(-left // per)
            if room is None:
                room, first, got = capacity, opened, want
                opened += want
            else:
                first, got = tree.take(room, want)
            placed = min(left, got * per)
            moves.append((length, rank, rank + placed, first, per, capacity - room))
            full = placed // per
            tree.add(room - per * length, first, full)
            if placed % per:
                tree.add(room - (placed % per) * length, first + full, 1)
            left, rank = left - placed, rank + placed
    return moves


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    ranked = number_within(pieces, ["length"], "rank", RANK_BUCKETS)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    moves = spark.createDataFrame(
        best_fit_moves(histogram, capacity),
        "length long, rank_from long, rank_to long, first long, per long, used long")
    nth = F.col("rank") - F.col("rank_from")
    return (ranked.join(F.broadcast(moves), "length")       # moves are bounded by the capacity
            .where("rank >= rank_from AND rank < rank_to")
            .withColumn("sequence_id", F.col("first") + F.floor(nth / F.col("per")).cast("long"))
            .withColumn("offset", F.col("used") + F.pmod(nth, F.col("per")) * F.col("length"))
            .drop("rank", "rank_from", "rank_to", "first", "per", "used"))


def packed_sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences of packed pieces that carry ``ids``."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    pieces = materialize(tokenize(docs, path or vocabulary_path(), capacity, with_ids), "pieces")
    return pack(pieces, capacity)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return pack_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
