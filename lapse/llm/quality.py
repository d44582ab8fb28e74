"""Quality rules: base counts, then a logistic regression over hashed n-grams.

Features are word 1- and 2-grams and character ``CHAR_GRAM``-grams (of UTF-8
bytes), hashed into 2 x 2^BITS places, as shares of the text's n-grams.  The
regression is fitted on labelled quality rows and its log-odds are calibrated
on rows it has not seen, shifted to the classes' true proportion.  Every text
is counted and scored whole in Arrow batches, without a shuffle; fixed
thresholds decide.

The fit uses at most ``training.ROWS_PER_CLASS`` labelled rows of each class.

Defined cases: null and empty texts have no words and fail the base rules;
repeated rows are judged alike; without labelled rows of both classes the base
rules decide alone; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm import training
from lapse.llm.common import read_table
from lapse.llm.hashing import phrase_hash, word_hashes

# The base rules and the symbols they count.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50          # per cent of the words
THRESHOLD = 0.5
BITS = 17
CHAR_GRAM = 4
SCALE = 30.0                # of the shares, so that weights stay small
EPOCHS = 60
CALIBRATION = 4             # every fourth row of the sample calibrates
AT_ONCE = 1 << 20           # bytes whose n-grams are held together


def counts(data: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text and its word hashes."""
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    points = int(seen[:128].sum() + seen[192:].sum() - seen[9:14].sum() - seen[32])
    lines = [x for x in data.split(b"\n") if x.strip()]
    triples = phrase_hash(hashes, 3, 5)
    order = np.argsort(triples, kind="stable")
    equal = triples[order[1:]] == triples[order[:-1]]
    mask = np.zeros(len(hashes) + 3, bool)
    for at in (order[1:][equal], order[:-1][equal]):
        for j in range(3):
            mask[at + j] = True
    return (len(hashes), points, int(seen[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), int(mask.sum()))


def places(data: bytes, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, hashed places) of all n-grams; part 0 has words, part 1 characters."""
    top = np.uint64(64 - BITS)
    if len(hashes):
        yield 0, np.concatenate([phrase_hash(hashes, n, 6) >> top for n in (1, 2)]).astype(np.int64)
    chars = np.frombuffer(data, np.uint8)
    for at in range(0, max(0, len(chars) - CHAR_GRAM + 1), AT_ONCE):
        part = chars[at:at + AT_ONCE + CHAR_GRAM - 1].astype(np.uint32)
        code = np.zeros(len(part) - CHAR_GRAM + 1, np.uint32)
        for j in range(CHAR_GRAM):
            code = (code << np.uint32(8)) | part[j:j + len(code)]
        yield 1, (((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64) + (1 << BITS))


def log_odds(weights: np.ndarray, intercept: float, data: bytes, hashes: np.ndarray) -> float:
    total, number = [0.0, 0.0], [0, 0]
    for part, at in places(data, hashes):
        total[part] += float(weights[at].sum(dtype=np.float64))
        number[part] += len(at)
    return intercept + SCALE * sum(t / n for t, n in zip(total, number) if n)


def _shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = text.encode()
    found: list[list[np.ndarray]] = [[], []]
    for part, at in places(data, word_hashes(data.split())):
        found[part].append(at)
    index, share = [], []
    for at in found:
        if at:
            i, n = np.unique(np.concatenate(at), return_counts=True)
            index.append(i.astype(np.int32))
            share.append((SCALE * n / n.sum()).astype(np.float32))
    none = [np.zeros(0, np.int32)]
    return np.concatenate(index or none), np.concatenate(share or none).astype(np.float32)


def fit(texts: list[tuple[str, int]]) -> tuple[np.ndarray, float]:
    """Weights and intercept, by Adam over the whole sample with both classes weighing the same."""
    rows = [_shares(t) for t, _ in texts]
    y = np.array([y for _, y in texts], np.float32)
    index = np.concatenate([i for i, _ in rows])
    share = np.concatenate([s for _, s in rows])
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    w, b = np.zeros(2 << BITS, np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, EPOCHS + 1):
        z = np.bincount(row, weights=w[index] * share, minlength=len(y)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grad = np.bincount(index, weights=error[row] * share, minlength=len(w)).astype(np.float32) + 1e-6 * w
        gb = float(error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix, fixv = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= (0.1 * (m / fix) / (np.sqrt(v / fixv) + 1e-8)).astype(np.float32)
        b -= 0.1 * (mb / fix) / (vb / fixv + 1e-16) ** 0.5
    return w, b


def train(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Weights and calibration from labelled rows; None without both classes."""
    texts, proportion = training.labelled_sample(docs, labels, "quality")
    fitted = [t for i, t in enumerate(texts) if i % CALIBRATION]
    rest = [t for i, t in enumerate(texts) if not i % CALIBRATION]
    if len({y for _, y in fitted}) < 2 or len({y for _, y in rest}) < 2:
        return None
    w, b = fit(fitted)
    z = np.array([[log_odds(w, b, t.encode(), word_hashes(t.encode().split()))] for t, _ in rest])
    y = np.array([y for _, y in rest], float)
    slope, shift = training.fit_logistic(z, y)
    return {"weights": w, "intercept": b, "slope": slope, "shift": shift + training.prior_shift(proportion, y)}


ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                  ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                  ("score", pa.float64())])


def judge(docs: DataFrame, model: dict | None) -> DataFrame:
    """Counts, base verdict and quality score of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                data = (text.as_py() or "").encode()
                hashes = word_hashes(data.split())
                found = counts(data, hashes)
                failed = found[0] < LEAST_WORDS or 100 * found[4] > MOST_REPEATED * found[0]
                score = 1.0
                if model:
                    z = log_odds(model["weights"], model["intercept"], data, hashes)
                    score = training.sigmoid(model["slope"] * z + model["shift"])
                rows.append((doc, *found, failed, score))
            columns = list(zip(*rows)) if rows else [[] for _ in ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, ROWS)], schema=ROWS)

    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, score double")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    kept = ~F.col("base_failed") & (F.col("score") >= THRESHOLD)
    return judge(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "score")
