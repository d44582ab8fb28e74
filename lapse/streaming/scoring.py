"""Scoring of request records, in batches and as a stream.

Records are JSON objects; features may be numbers, numeric text or booleans.
Every field is read as text and converted, so no record is lost to a type.
Features made by the encoder (``frequency_*``) count as 0 when absent; any other
missing or unusable field rejects the record, with the names of the fields.
One query reads each landing file once.  Of every micro-batch accepted records
are scored by the saved pipeline and written to one sink, rejected ones to
another, in folders named after the batch: a batch that is run again after a
failure overwrites what it had written, so every record arrives once.  Records
that repeat a ``request_id`` within the watermark are dropped.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import WINDOWS, Windows
from ..session import checkpoint_dir


ENCODED = "frequency_"


REQUEST = ("request_id", "requested_at")      # optional fields of a record


def request_schema(features: list[str], key: str = "account_id") -> T.StructType:
    """Every feature as text: ``true``, ``1`` and ``"1.5"`` all arrive."""
    return T.StructType([T.StructField(key, T.LongType())]
                        + [T.StructField(c, T.StringType()) for c in (*features, *REQUEST)])


def without_repeats(stream: DataFrame, watermark: str) -> DataFrame:
    """Records whose ``request_id`` was not seen within ``watermark`` of ``requested_at``.

    A record without a time counts as requested now, one without an id is never a repeat.
    """
    when = F.coalesce(F.col("requested_at").try_cast("timestamp"), F.current_timestamp())
    named = stream.withColumn("requested_at", when).withColumn("request_id", F.coalesce("request_id", F.expr("uuid()")))
    return named.withWatermark("requested_at", watermark).dropDuplicatesWithinWatermark(["request_id"])


def as_number(c: Column) -> Column:
    """Number of a boolean, a number or numeric text; NULL for anything else and for NaN."""
    text = F.lower(F.trim(c.cast("string")))
    v = F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(text.try_cast("double"))
    return F.when(~F.isnan(v), v)


def parse_records(df: DataFrame, features: list[str], key: str = "account_id", text: Sequence[str] = ()) -> DataFrame:
    """(key, features as DOUBLE, ``text`` columns as they are): absent encoder columns are 0 (P11), other absent ones NULL."""
    have = set(df.columns)

    def value(c: str) -> Column:
        v = as_number(F.col(c)) if c in have else F.lit(None).cast("double")
        return F.coalesce(v, F.lit(0.0)) if c.startswith(ENCODED) else v

    return df.select(key, *[value(c).alias(c) for c in features],
                     *[(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in text])


def split_records(df: DataFrame, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """(complete records, rejected ones with the names of the ``missing`` fields)."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in features]))
    tagged = df.withColumn("missing", missing)
    return tagged.where(F.size("missing") == 0).drop("missing"), tagged.where(F.size("missing") > 0)


def batch_writer(model: PipelineModel, features: list[str], sink: str, run: str, key: str = "account_id"):
    """What is done with a micro-batch: scores to ``sink``, rejects to ``<sink>-rejects``, in the folder of the batch."""
    from ..models.train import score_frame

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_records(batch, features, key).persist()      # read once for both sinks
        try:
            complete, rejected = split_records(parsed, features)
            for rows, path in ((score_frame(model, complete, key), sink), (rejected.select(key, "missing"), f"{sink}-rejects")):
                rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")
        finally:
            parsed.unpersist()

    return write


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.parquet(sink).drop("run", "batch")


def start_scoring(spark: SparkSession, model: PipelineModel, features: list[str], landing: str, sink: str, checkpoint: str,
                  key: str = "account_id", available_now: bool = True, watermark: str | None = "1 hour", files_per_batch: int | None = None):
    """One query over the landing folder with two sinks.  Batches are numbered by ``checkpoint``, whose digest names their folders."""
    reader = spark.readStream.schema(request_schema(features, key))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.json(landing)
    if watermark:
        stream = without_repeats(stream, watermark)
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch_writer(model, features, sink, run, key))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def score_stream(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Land the test-fold records as JSON requests, stream-score them with the scorer, read the sink."""
    from ..models.train import Trainer
    t = Trainer(spark, sf_dir, w)
    _, model, features = t.scorer()
    base = os.path.join(checkpoint_dir(spark), "stream", uuid.uuid4().hex[:8])
    landing, sink, ckpt = (os.path.join(base, p) for p in ("landing", "sink", "checkpoint"))
    t.test.select("account_id", *features).write.mode("overwrite").json(landing)
    start_scoring(spark, model, features, landing, sink, ckpt).awaitTermination()
    return read_sink(spark, sink)
