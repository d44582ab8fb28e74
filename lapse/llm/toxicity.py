"""Toxicity by compression distance to separately trained Zstandard dictionaries.

The texts of each class are cut into windows of words, and Zstandard trains a
dictionary on the windows of toxic texts and another on those of ordinary ones,
in ``HEADS`` bytes.  Both go before one base, trained on ordinary text too, so
that a window of common words has the same length with either, and its gain
(length with the ordinary dictionary minus length with the toxic one) tells what
else it holds.  The largest gain, the mean of the ``TOP`` largest, the mean of
all, and the sum and rate of what passes one byte are measured for each size.

One measure goes beside the method, as dictionaries alone miss texts that are
toxic by how often they say what ordinary texts say once: stems are beginnings
of words that toxic documents repeat and that are far more frequent in them,
each with the log of how much.  The measures, the summed weight of the stems
and the number of windows give the score by a logistic calibration on labelled
rows that dictionaries and stems have not seen, shifted to the classes' true
proportion.

The fit uses at most ``training.ROWS_PER_CLASS`` labelled rows of each class;
every text is scored whole, window by window, in Arrow batches without a
shuffle.

Defined cases: null and empty texts have one empty window and get its score; a
text without white space is one window; repeated rows score alike; a class with
too little text to train on is its own dictionary; without labelled rows of both
classes every score is 0; empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm import training
from lapse.llm.common import read_table

THRESHOLD = 0.3
WINDOW_WORDS = 12
STEM_BYTES = range(4, 9)
STEM_ODDS = 2.0
STEM_EVIDENCE = 24.0
STEM_TIMES = 2              # a document repeats a stem from this many words on
STEM_MOST = 8               # words of one document that count for the rate of a stem
TOP = 3
BASE_BYTES = 30_000
HEADS = (2000,)             # bytes of the trained dictionaries; small ones keep to what recurs most
SEGMENT_BYTES = (32, 16)    # segments that training chooses, in the base and in the heads
DMER_BYTES = 6
CALIBRATION = 4             # every fourth row of the sample calibrates


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def windows(text: str | None) -> list[bytes]:
    words = words_of(text)
    return [b" " + b" ".join(words[i:i + WINDOW_WORDS]) + b" " for i in range(0, max(1, len(words)), WINDOW_WORDS)]


def log_odds(n: int, toxic: int, m: int, plain: int) -> float:
    return float(np.log((n + 0.5) / (toxic + 1)) - np.log((m + 0.5) / (plain + 1)))


def marks_toxic(n: int, toxic: int, m: int, plain: int, least_odds: float, evidence: float) -> bool:
    """Whether a stem in ``n`` toxic and ``m`` ordinary documents is far commoner in toxic ones, beyond chance."""
    if log_odds(n, toxic, m, plain) <= least_odds:
        return False
    share = (n + m) / (toxic + plain)
    statistic = 2 * (n * np.log(n / (toxic * share)) + (m * np.log(m / (plain * share)) if m else 0.0))
    return statistic >= evidence


def toxic_stems(texts: list[tuple[str, int]]) -> dict[bytes, float]:
    """Beginnings of words that toxic documents repeat, with the log ratio of their rates per word."""
    repeated, often, docs, words = [Counter(), Counter()], [Counter(), Counter()], [0, 0], [0, 0]
    for text, y in sorted(set(texts)):
        seen: Counter = Counter()
        for word, n in Counter(words_of(text)).items():
            words[y] += n
            for size in STEM_BYTES:
                if size <= len(word):
                    seen[word[:size]] += n
        docs[y] += 1
        repeated[y].update(s for s, n in seen.items() if n >= STEM_TIMES)
        for stem, n in seen.items():
            often[y][stem] += min(n, STEM_MOST)
    stems = {}
    for stem, n in repeated[1].items():
        rate = log_odds(often[1][stem], words[1], often[0][stem], words[0])
        if rate > STEM_ODDS and marks_toxic(n, docs[1], repeated[0][stem], docs[0], STEM_ODDS, STEM_EVIDENCE):
            stems[stem] = rate
    return stems


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """Content of a dictionary that Zstandard trains on ``samples``; their last bytes where they are too few."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=DMER_BYTES).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Distance:
    """Compressed length with the ordinary dictionary minus that with the toxic one, for each size."""

    def __init__(self, model: dict):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            6, strategy=zstandard.STRATEGY_LAZY2, min_match=4, write_content_size=False, write_checksum=False,
            write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        self.stems = model["stems"]
        self.heads = {s[:STEM_BYTES[0]] for s in self.stems}

        def packer(head: bytes):
            dictionary = zstandard.ZstdCompressionDict(head + model["base"], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=parameters)
            return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress

        self.packers = [(packer(plain), packer(toxic)) for plain, toxic in zip(model["plain"], model["toxic"])]

    def stem_weight(self, text: str | None) -> float:
        """Sum over the words of the largest weight of their stems."""
        stems, heads, head = self.stems, self.heads, STEM_BYTES[0]
        return sum(max(stems.get(w[:n], 0.0) for n in STEM_BYTES) for w in words_of(text) if w[:head] in heads) if stems else 0.0

    def features(self, text: str | None) -> list[float]:
        parts, found = windows(text), []
        for plain, toxic in self.packers:
            gains = np.array([len(plain(w)) - len(toxic(w)) for w in parts], float)
            over = float(np.maximum(gains - 1, 0).sum())
            found += [gains.max(), np.sort(gains)[-TOP:].mean(), gains.mean(), np.log1p(over), over / len(gains)]
        return [float(x) for x in (*found, np.log1p(self.stem_weight(text)), np.log(len(parts)))]


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None) -> dict | None:
    """Dictionaries and calibration from labelled rows; None without both classes."""
    texts, counts = training.labelled_sample(docs, labels, "toxic", allowed)
    fitted = [t for i, t in enumerate(texts) if i % CALIBRATION]
    rest = [t for i, t in enumerate(texts) if not i % CALIBRATION]
    if len({y for _, y in fitted}) < 2 or len({y for _, y in rest}) < 2:
        return None
    plain, toxic = ([w for t in sorted({t for t, y in fitted if y == k}) for w in windows(t)] for k in (0, 1))    # copies are no evidence
    model = {"base": trained(plain, BASE_BYTES, SEGMENT_BYTES[0]),
             "plain": [trained(plain, size, SEGMENT_BYTES[1]) for size in HEADS],
             "toxic": [trained(toxic, size, SEGMENT_BYTES[1]) for size in HEADS],
             "stems": toxic_stems(fitted)}
    distance = Distance(model)
    x, y = np.array([distance.features(t) for t, _ in rest]), np.array([y for _, y in rest], float)
    model["weights"] = training.fit_logistic(x, y).tolist()
    model["weights"][-1] += training.prior_shift(counts, y)
    return model


def score(docs: DataFrame, model: dict | None, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row of ``docs``; ``key`` is any long column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model) if model else None
        weights = np.array(model["weights"]) if model else None
        for batch in batches:
            scores = [training.sigmoid(np.dot(weights[:-1], distance.features(t.as_py())) + weights[-1]) if model else 0.0
                      for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(scores, pa.float64())], [key, "score"])

    return docs.select(F.col(key).cast("long").alias(key), "text").mapInArrow(run, f"{key} long, score double")


def reject_toxic(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, unchanged."""
    if not model:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance, weights = Distance(model), np.array(model["weights"])
        for batch in batches:
            keep = [training.sigmoid(np.dot(weights[:-1], distance.features(t.as_py())) + weights[-1]) < threshold for t in batch["text"]]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document; labels of held-out rows aren't read."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
