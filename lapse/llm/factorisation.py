"""Quality classifier: a factorisation machine over words, structure and metadata.

A text has three kinds of features: hashed words (square roots of their counts,
scaled to length one), levels of structure statistics (shares of symbols,
capitals, repeated lines and so on), and levels of its metadata (the stated
number of characters and whether it fits the text).  Every feature has a weight
and ``FACTORS`` latent factors; two features that meet in a text add the product
of their factors.  All pairs are summed in linear time by

    sum over i < j of <v_i, v_j> x_i x_j = 1/2 sum over f of ((sum v_if x_i)^2 - sum v_if^2 x_i^2).

It is fitted on labelled quality rows, calibrated on labelled rows it has not
seen and shifted to the classes' true proportion.  Labels, language, source and
doc_id are no features.  Texts are scored whole, in Arrow batches, without a
shuffle.

The fit takes at most ``ROWS_PER_CLASS`` labelled rows and ``ENTRIES`` features
of each class, in the order of a hash of doc_id; their features are made by
Spark from whole texts, so no text reaches the driver.

Defined cases: null and empty texts have no words, only levels; a null or
missing n_chars is a level of its own; a null doc_id counts as the empty
string for the fold and is never fitted on; repeated rows are scored alike; a
doc_id with several texts is fitted on its least one, with several labels on
1 if any is; without labelled rows of both classes every score is the smoothed
share of label 1; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.llm import training
from lapse.llm.common import read_table
from lapse.llm.hashing import word_hashes
from lapse.session import materialize

THRESHOLD = 0.3
ROWS_PER_CLASS = 3000
ENTRIES = 1_000_000
BITS = 16                   # of the hashed words
FACTORS = 8
EPOCHS = 60
RATE = 0.05
RIDGE = 1e-3
CALIBRATION = 4             # every fourth row of the sample calibrates
AT_ONCE = 4 << 20           # bytes of a text whose words are held together
LEVELS = 16                 # places of a statistic
WORD_SCALE, LEVEL_SCALE = 1.0, 1.0

SYMBOLS = b"#*$%&|<>"
STATISTICS = ("words", "word_bytes", "symbols", "punctuation", "digits", "capitals", "not_ascii", "controls", "spaces",
              "repeated_lines", "words_per_line", "distinct_words", "commonest_word", "stated_chars", "stated_fits")
PLACES = (1 << BITS) + LEVELS * len(STATISTICS)
BLANK = re.compile(rb"[\x09-\x0D ]")

_CODE = np.arange(256)
_SYMBOL = np.isin(_CODE, list(SYMBOLS))
_DIGIT = (_CODE >= 48) & (_CODE <= 57)
_CAPITAL = (_CODE >= 65) & (_CODE <= 90)
_SMALL = (_CODE >= 97) & (_CODE <= 122)
_SPACE = np.isin(_CODE, [9, 10, 11, 12, 13, 32])
_CONTROL = (_CODE < 32) & ~_SPACE | (_CODE == 127)
_PUNCTUATION = (_CODE < 128) & ~(_SYMBOL | _DIGIT | _CAPITAL | _SMALL | _SPACE | _CONTROL)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, counts) of the words of a text, and how often each byte occurs."""
    places, counts, seen = [], [], np.zeros(256, np.int64)
    start = 0
    while start < len(data):
        blank = BLANK.search(data, start + AT_ONCE)
        end = blank.end() if blank else len(data)
        piece = data[start:end]
        at, n = np.unique(word_hashes(piece.lower().split()) >> np.uint64(64 - BITS), return_counts=True)
        places.append(at.astype(np.int64))
        counts.append(n)
        for a in range(0, len(piece), AT_ONCE):
            seen += np.bincount(np.frombuffer(piece[a:a + AT_ONCE], np.uint8), minlength=256)
        start = end
    if len(places) > 1:
        at, back = np.unique(np.concatenate(places), return_inverse=True)
        return at, np.bincount(back, np.concatenate(counts)).astype(np.int64), seen
    return (places[0], counts[0], seen) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64), seen)


def _share(part: float, whole: float) -> int:
    return int(min(LEVELS - 1, 15 * (part / whole) ** 0.5)) if whole > 0 else 0


def _size(n: float) -> int:
    return min(LEVELS - 1, int(n).bit_length())


def features(text: str | None, stated: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text and its stated number of characters."""
    data = (text or "").encode()
    at, n, seen = _words(data)
    words, size = int(n.sum()), len(data)
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = int(seen[_CAPITAL | _SMALL].sum())
    chars = size - int(seen[128:192].sum())
    levels = (_size(words), _size((size - int(seen[_SPACE].sum())) / max(1, words)),
              _share(seen[_SYMBOL].sum(), size), _share(seen[_PUNCTUATION].sum(), size), _share(seen[_DIGIT].sum(), size),
              _share(seen[_CAPITAL].sum(), letters), _share(seen[128:].sum(), size), _share(seen[_CONTROL].sum(), size),
              _share(seen[_SPACE].sum(), size), _share(len(lines) - len(set(lines)), len(lines)),
              _size(words / max(1, len(lines))), _share(len(at), words), _share(n.max(initial=0), words),
              0 if stated is None else _size(max(0, stated)),
              0 if stated is None else 1 + (stated > chars) + 2 * (stated < chars))
    places = np.concatenate((at, (1 << BITS) + LEVELS * np.arange(len(levels)) + np.array(levels)))
    values = np.concatenate((WORD_SCALE * np.sqrt(n / max(1, words)), np.full(len(levels), LEVEL_SCALE)))
    return places.astype(np.int32), values.astype(np.float32)


def margin(model: dict, places: np.ndarray, values: np.ndarray) -> float:
    """Intercept, weights and all pairs, in time linear in the features."""
    x = values.astype(np.float64)
    vx = model["factors"][places] * x[:, None]
    return float(model["intercept"] + model["weights"][places] @ x + 0.5 * ((vx.sum(axis=0) ** 2).sum() - (vx * vx).sum()))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> dict:
    """Weights and factors by Adam over the whole sample, both classes weighing the same; unseen places stay 0."""
    used, index = np.unique(np.concatenate([p for p, _ in rows]), return_inverse=True)
    x = np.concatenate([v for _, v in rows]).astype(np.float32)
    sizes = np.array([len(p) for p, _ in rows])
    row, first = np.repeat(np.arange(len(rows)), sizes), np.concatenate(([0], np.cumsum(sizes)[:-1]))
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    m = len(used)
    # one row of parameters for each place: its weight, then its factors; the last is the intercept
    theta = np.zeros((m + 1, 1 + FACTORS), np.float32)
    theta[:m, 1:] = np.random.default_rng(13).normal(0, 0.05, (m, FACTORS))
    first_moment, second_moment = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, EPOCHS + 1):
        vx = theta[index, 1:] * x[:, None]
        total = np.add.reduceat(vx, first, axis=0)
        z = (theta[m, 0] + np.add.reduceat(theta[index, 0] * x, first)
             + 0.5 * ((total ** 2).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), first)))
        error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share).astype(np.float32)
        ex = error[row] * x
        grad = np.empty_like(theta)
        grad[:m, 0] = np.bincount(index, ex, m)
        for f in range(FACTORS):
            grad[:m, 1 + f] = np.bincount(index, ex * (total[row, f] - vx[:, f]), m)
        grad[m] = 0
        grad[m, 0] = error.sum()
        grad[:m] += RIDGE * theta[:m]
        first_moment = 0.9 * first_moment + 0.1 * grad
        second_moment = 0.99 * second_moment + 0.01 * grad * grad
        theta -= RATE * (first_moment / (1 - 0.9 ** t)) / (np.sqrt(second_moment / (1 - 0.99 ** t)) + 1e-8)
    weights, factors = np.zeros(PLACES, np.float32), np.zeros((PLACES, FACTORS), np.float32)
    weights[used], factors[used] = theta[:m, 0], theta[:m, 1:]
    return {"weights": weights, "factors": factors, "intercept": float(theta[m, 0])}


def _with_stated(docs: DataFrame, *columns: str) -> DataFrame:
    stated = F.expr("try_cast(n_chars AS bigint)") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(*columns, "text", stated.alias("n_chars"))


def _sample(docs: DataFrame, labels: DataFrame, allowed: Column) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], dict[int, int]]:
    """[(label, places, values)] of the rows to fit on, and the labelled rows of each class."""
    picked = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in picked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = (picked.where("y = 0").orderBy(*order).limit(ROWS_PER_CLASS)
              .union(picked.where("y = 1").orderBy(*order).limit(ROWS_PER_CLASS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py(), c) for t, c in zip(batch["text"], batch["n_chars"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["y"], pa.array([len(p) for p, _ in found], pa.int64()),
                 pa.array([p for p, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
                ["doc_id", "y", "size", "places", "values"])

    one = (_with_stated(docs, "doc_id").join(F.broadcast(chosen), "doc_id")       # at most 2 * ROWS_PER_CLASS ids
           .groupBy("doc_id", "y").agg(F.min(F.struct(F.col("text").isNull().alias("none"), "text", "n_chars")).alias("r"))
           .select(F.col("doc_id").cast("long"), "y", "r.text", "r.n_chars"))
    made = materialize(one.mapInArrow(run, "doc_id long, y int, size long, places array<int>, values array<float>"), "fm_sample")
    before = Window.partitionBy("y").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)     # at most ROWS_PER_CLASS rows
    kept = made.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("before") <= ENTRIES)
    rows = kept.orderBy(*order).select("y", "places", "values").collect()
    return [(r["y"], np.array(r["places"], np.int32), np.array(r["values"], np.float32)) for r in rows], counts


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> dict:
    """The calibrated model, from the labelled rows that ``allowed`` (a column of ``labels``) admits."""
    rows, counts = _sample(docs, labels, allowed)
    fitted = [r for i, r in enumerate(rows) if i % CALIBRATION]
    rest = [r for i, r in enumerate(rows) if not i % CALIBRATION]
    if len({r[0] for r in fitted}) < 2 or len({r[0] for r in rest}) < 2:
        return {"share": (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)}
    model = fit([r[1:] for r in fitted], np.array([r[0] for r in fitted], np.float32))
    y = np.array([r[0] for r in rest], float)
    slope, shift = training.fit_logistic(np.array([[margin(model, *r[1:])] for r in rest]), y)
    return model | {"slope": slope, "shift": shift + training.prior_shift(counts, y)}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text and, if there, n_chars)."""

    def one(text: str | None, stated: int | None) -> float:
        if "share" in model:
            return model["share"]
        return training.sigmoid(model["slope"] * margin(model, *features(text, stated)) + model["shift"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t.as_py(), c) for t, c in zip(batch["text"], batch["n_chars"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.float64())], ["doc_id", "score"])

    return _with_stated(docs, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, score double")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
