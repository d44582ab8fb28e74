"""Target-distribution importance resampling with segment deduplication.

Features are runs of one or two words, counted in hashed buckets.  A bucket's
gain compares its rate in the target texts with its rate in the corpus; a
document's weight is the mean gain of its features, and seeded Gumbel noise on
top turns the highest scores into a draw without replacement.

Corpus counts come from segments: newlines cut texts into lines, equal lines
are pooled by Spark, each distinct line's features are counted once and
multiplied by its occurrences.  Pairs of words that a newline stands between
belong to no line and are added separately.  Weighing does the same inside each
Arrow batch: a distinct line's gains are summed once, seams are added.

A feature's bucket is the crc32 of its bytes.  Words are hashed once; the hash
of a pair is combined from those of its words, as crc32 is linear.

Bounded: the histogram and the gains have ``buckets`` entries whatever the
corpus; long texts are worked through in pieces of ``AT_ONCE`` bytes.  Ranks
are numbered over range partitions, so no task holds a group of equal scores.

Defined cases: null and empty texts have no features and weight 0; a null
doc_id is hashed as the empty string and comes last among ties; repeated rows
are counted, weighed and drawn one by one; an empty corpus or target gives
smoothed gains; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import read_table
from lapse.operators.prefix import running_totals
from lapse.session import materialize

BUCKETS = 10_000
SMOOTH = 10_000             # added to both totals
SEED = 7
LEAST_WORDS = 20
SHARE = 25                  # per cent of the eligible documents that are drawn
AT_ONCE = 4 << 20           # bytes of text that are cut into words together

SPACE = 0x20
#: Of each byte: a-z, 0-9 and all of other letters stay, A-Z become a-z, the rest separates words.
PLAIN = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else SPACE for b in range(256))


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1)).astype(np.uint32)
    return c


def _apply(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit numbers, given by its values at every byte of each place."""
    return (tables[0][c & np.uint32(255)] ^ tables[1][(c >> np.uint32(8)) & np.uint32(255)]
            ^ tables[2][(c >> np.uint32(16)) & np.uint32(255)] ^ tables[3][c >> np.uint32(24)])


CRC = _crc_table()


def _zeros_tables() -> list[np.ndarray]:
    """What 1, 2, 4, ... zero bytes do to a crc32, for lengths up to 2^32."""
    places = np.arange(256, dtype=np.uint32)
    by_byte = np.stack([places << np.uint32(8 * j) for j in range(4)])
    step = (by_byte >> np.uint32(8)) ^ CRC[by_byte & np.uint32(255)]
    out = [step]
    while len(out) < 32:
        out.append(np.stack([_apply(out[-1], row) for row in out[-1]]))
    return out


ZEROS = _zeros_tables()


def joined_crc(first: np.ndarray, second: np.ndarray, second_bytes: np.ndarray) -> np.ndarray:
    """crc32 of ``first + b' ' + second`` from the crc32 of both and the length of the second."""
    c = ~first
    c = ~((c >> np.uint32(8)) ^ CRC[(c ^ np.uint32(SPACE)) & np.uint32(255)])
    for k in range(int(second_bytes.max(initial=0)).bit_length()):
        longer = (second_bytes >> k) & 1 == 1
        c[longer] = _apply(ZEROS[k], c[longer])
    return c ^ second


def _pieces(lines: list[bytes]) -> Iterator[tuple[list[int], bytes, np.ndarray, bool]]:
    """(lines, their bytes with separators, the end of each, whether the first word was in the piece before).

    A line over ``AT_ONCE`` bytes is cut between words and its pieces share a word.
    """
    held, size = [], 0

    def out() -> tuple[list[int], bytes, np.ndarray, bool]:
        ends = np.cumsum([len(lines[i]) + 1 for i in held])
        return held, b" ".join([*(lines[i] for i in held), b""]).translate(PLAIN), ends, False

    for i, line in enumerate(lines):
        if len(line) <= AT_ONCE:
            held.append(i)
            size += len(line)
            if size >= AT_ONCE:
                yield out()
                held, size = [], 0
            continue
        if held:
            yield out()
            held, size = [], 0
        data = line.translate(PLAIN)
        start, cut, seen = 0, 0, False
        while cut < len(data):
            end = data.find(b" ", cut + AT_ONCE)
            cut = len(data) if end < 0 else end
            piece = data[start:cut] + b" "
            yield [i], piece, np.array([len(piece)]), seen
            body = piece.rstrip()
            start, seen = (start + body.rfind(b" ") + 1, True) if body else (cut, False)
    if held:
        yield out()


def words_of(lines: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(line, crc32, bytes) of the words of each piece, and whether the first word was in the piece before."""
    for held, data, ends, seen in _pieces(lines):
        words = data.split()
        if not words:
            continue
        size = np.fromiter(map(len, words), np.int64, len(words))
        crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        if len(held) == 1:
            line = np.full(len(words), held[0])
        else:
            spaced = np.frombuffer(data, np.uint8) == SPACE
            starts = np.flatnonzero(~spaced[1:] & spaced[:-1]) + 1
            if not spaced[0]:
                starts = np.concatenate(([0], starts))
            line = np.array(held)[np.searchsorted(ends, starts, side="right")]
        yield line, crc, size, seen


def features_of(lines: list[bytes], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line, bucket) of all features inside the lines."""
    for line, crc, size, seen in words_of(lines):
        yield line[seen:], (crc[seen:] % buckets).astype(np.int64)
        pair = np.flatnonzero(line[1:] == line[:-1])
        if len(pair):
            joined = joined_crc(crc[pair], crc[pair + 1], size[pair + 1])
            yield line[pair], (joined % buckets).astype(np.int64)


class Seams:
    """First and last word of each line, and the pairs that stand across newlines."""

    def __init__(self, lines: list[bytes]) -> None:
        n = len(lines)
        self.first, self.first_bytes = np.zeros(n, np.uint32), np.zeros(n, np.int64)
        self.last, self.filled = np.zeros(n, np.uint32), np.zeros(n, bool)

    def add(self, line: np.ndarray, crc: np.ndarray, size: np.ndarray) -> None:
        new = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
        new = new[~self.filled[line[new]]]
        self.first[line[new]], self.first_bytes[line[new]] = crc[new], size[new]
        end = np.flatnonzero(np.concatenate((line[1:] != line[:-1], [True])))
        self.last[line[end]] = crc[end]
        self.filled[line] = True

    def pairs(self, owner: np.ndarray, line: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(owner, bucket) of the pairs, for lines in order, each with the text that owns it."""
        some = self.filled[line]
        owner, line = owner[some], line[some]
        at = np.flatnonzero(owner[1:] == owner[:-1])
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = line[at], line[at + 1]
        return owner[at], (joined_crc(self.last[a], self.first[b], self.first_bytes[b]) % buckets).astype(np.int64)


def _lines_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(text, distinct line) of every line in order, and the distinct lines."""
    number: dict[str, int] = {}
    owner, line = [], []
    for i, text in enumerate(texts):
        for x in (text or "").split("\n"):
            owner.append(i)
            line.append(number.setdefault(x, len(number)))
    return np.array(owner, np.int64), np.array(line, np.int64), [x.encode() for x in number]


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in groups of about ``AT_ONCE`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _histogram(found: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(found)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at], pa.int64())], ["bucket", "n"])


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of ``texts`` (text), buckets without any left out."""

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            times = np.asarray(batch["times"], dtype=np.float64)      # exact below 2^53
            for line, bucket in features_of([x.encode() for x in batch["line"].to_pylist()], buckets):
                found += np.bincount(bucket, times[line], buckets).astype(np.int64)
        yield _histogram(found)

    def of_seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in _groups(batch["text"].to_pylist()):
                # only the outer words of a line take part
                data = [x.encode().translate(PLAIN).split() if len(x) < 64 else _ends(x.encode().translate(PLAIN))
                        for text in texts for x in (text or "").split("\n")]
                owner = np.repeat(np.arange(len(texts)), [(text or "").count("\n") + 1 for text in texts])
                some = [i for i, words in enumerate(data) if words]
                if len(some) < 2:
                    continue
                seams = Seams(data)
                at = np.array(some)
                for words, crc, size in ((0, seams.first, seams.first_bytes), (-1, seams.last, None)):
                    crc[at] = [zlib.crc32(data[i][words]) for i in some]
                    if size is not None:
                        size[at] = [len(data[i][words]) for i in some]
                seams.filled[at] = True
                found += np.bincount(seams.pairs(owner, np.arange(len(data)), buckets)[1], minlength=buckets)
        yield _histogram(found)

    schema = "bucket long, n long"
    texts = texts.select("text").where(F.col("text").isNotNull())
    lines = (texts.select(F.explode(F.split("text", "\n")).alias("line"))
             .groupBy("line").agg(F.count(F.lit(1)).alias("times")))
    seams = texts.where(F.contains("text", F.lit("\n")))
    return (lines.mapInArrow(of_lines, schema).unionByName(seams.mapInArrow(of_seams, schema))
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def _ends(data: bytes) -> list[bytes]:
    """First and last word, without cutting the words between."""
    data = data.strip()
    return [data[:end] if (end := data.find(b" ")) >= 0 else data, data[data.rfind(b" ") + 1:]] if data else []


def bucket_gains(target: DataFrame, raw: DataFrame, buckets: int = BUCKETS, smooth: int = SMOOTH) -> DataFrame:
    """(bucket, gain) of every bucket, from the (bucket, n) of target and raw texts."""
    t = target.select(F.col("bucket"), F.col("n").alias("t"))
    s = raw.select(F.col("bucket"), F.col("n").alias("s"))
    both = (target.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
            .join(t, "bucket", "left").join(s, "bucket", "left").fillna(0, ["t", "s"]))
    total = lambda x: F.coalesce(x.agg(F.sum("n")).scalar(), F.lit(0)).cast("double") + F.lit(float(smooth))
    ratio = ((F.col("t") + 1).cast("double") * total(raw)) / ((F.col("s") + 1).cast("double") * total(target))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs`` (doc_id, text)."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, weights = [], []
            for texts in _groups(batch["text"].to_pylist()):
                owner, line, lines = _lines_of(texts)
                gain, n = np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int64)
                seams = Seams(lines)
                for at, crc, size, seen in words_of(lines):
                    n += np.bincount(at[seen:], minlength=len(lines))
                    np.add.at(gain, at[seen:], gains[crc[seen:] % buckets])
                    pair = np.flatnonzero(at[1:] == at[:-1])
                    if len(pair):
                        np.add.at(gain, at[pair], gains[joined_crc(crc[pair], crc[pair + 1], size[pair + 1]) % buckets])
                    seams.add(at, crc, size)
                total, count = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                np.add.at(total, owner, gain[line])
                np.add.at(count, owner, n[line])
                across, bucket = seams.pairs(owner, line, buckets)
                np.add.at(total, across, gains[bucket])
                words.append(count)
                weights.append(np.where(count > 0, total // np.maximum(1, 2 * count - 1), 0))
            words = np.concatenate([*words, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(words), pa.array(np.maximum(0, 2 * words - 1)),
                 pa.array(np.concatenate([*weights, np.zeros(0, np.int64)]))],
                ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Seeded Gumbel noise of a document, in thousandths, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(weighed: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``weighed`` with score and rank: the highest ``share`` per cent of the rows with enough words, from 1; else null."""
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    # equal rows get numbers of their own, so none of them meet in one range
    scored = materialize(scored.withColumn("_tie", F.monotonically_increasing_id()), "scored")
    enough = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    order = F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().alias("null"), "doc_id", "n_features", "weight", "_tie")
    ranked = running_totals(scored.where(enough).withColumn("_at", order).withColumn("_one", F.lit(1).cast("long")),
                            [], "_at", ["_one"])
    drawn = F.col("_one_run") <= F.floor(F.col("_one_all") * F.lit(share) / 100)
    rank = F.when(drawn, F.col("_one_run")).cast("long").alias("rank")
    kept = [c for c in scored.columns if c != "_tie"]
    return ranked.select(*kept, rank).unionByName(scored.where(~enough).select(*kept, F.lit(None).cast("long").alias("rank")))


def gains_of(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket; ``buckets`` numbers, whatever the tables hold."""
    raw = materialize(feature_counts(docs, buckets), "raw_counts")
    wanted = materialize(feature_counts(target, buckets), "target_counts")
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(wanted, raw, buckets).collect():
        gains[r["bucket"]] = r["gain"]
    return gains


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """The drawn documents with all their columns (rows that share doc_id go together)."""
    drawn = draw(weigh(docs, gains_of(docs, target)), share).where("rank IS NOT NULL")
    return docs.join(drawn.select("doc_id").distinct().withColumnRenamed("doc_id", "_drawn"),
                     F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark texts."""
    docs = read_table(spark, sf_dir, "documents")
    gains = gains_of(docs, read_table(spark, sf_dir, "benchmark"))
    return draw(weigh(docs, gains)).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


OP11_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS tab),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
df AS (
  SELECT rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
dn AS (SELECT f, count(*) AS n FROM df GROUP BY f),
bn AS (SELECT f, count(*) AS n FROM bf GROUP BY f),
bucket AS (
  SELECT f, xor(list_reduce(list_transform(range(octet_length(encode(f))),
                              lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT),
                            lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT f FROM dn UNION SELECT f FROM bn), crc_table),
s AS (SELECT bucket, sum(n) AS s FROM dn JOIN bucket USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bn JOIN bucket USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
           (CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM dn) + 10000 AS DOUBLE))
           / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM bn) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
summed AS (
  SELECT rid, count(*) AS n_features, CAST(floor(sum(gain) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight
  FROM df JOIN bucket USING (f) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
                                                         AS DOUBLE) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN summed USING (rid)),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank,
         (25 * count(*) OVER ()) // 100 AS k
  FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN rank <= k THEN CAST(rank AS BIGINT) END AS rank, CAST(n_words AS BIGINT) AS n_words
FROM scored LEFT JOIN ranked USING (rid)
"""
