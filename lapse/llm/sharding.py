"""Sharding by weighted rendezvous hashing of a stable record key.

Every (key, shard) pair gets a hash; with ``u`` its place in (0, 1) and ``w``
the shard's weight, the record goes to the shard of the smallest ``-ln(u) / w``.
A shard's costs depend on nothing but the key and that shard, so a new shard
takes records only into itself, a removed one gives up only its own, and the
share of a shard is its weight over the sum of weights.

The costs are plain column expressions: the assignment is one projection with
no shuffle.  Only the slot numbers need one, on rows without the text.

Defined cases: null keys are one key; a null text counts as empty; repeated
rows share a shard and get slots of their own; an empty table gives no rows;
columns that are not asked for are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import number_within, read_table

SHARDS = 16
SLOT_BUCKETS = 4096


def equal_shards(n: int) -> list[tuple[int, float]]:
    return [(i, 1.0) for i in range(n)]


def shard_of(key: Column, shards: list[tuple[int, float]]) -> Column:
    """The shard number of ``key`` over ``[(shard, weight), ...]``."""
    if not shards or any(w <= 0 for _, w in shards):
        raise ValueError("shards need positive weights")

    def cost(shard: int, weight: float) -> Column:
        place = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)
        return F.struct((-F.log(place) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[cost(i, w) for i, w in shards]))["shard"]


def assign_shards(df: DataFrame, key: str, shards: list[tuple[int, float]], out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; all rows of a key share one."""
    return df.withColumn(out, shard_of(F.col(key), shards))


def write_shards(df: DataFrame, path: str, shard: str = "shard", files_per_shard: int = 1) -> None:
    """One folder per shard; ``files_per_shard`` tasks write an even part of every shard each."""
    df.repartition(files_per_shard).write.mode("overwrite").partitionBy(shard).parquet(path)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 15 by ``doc_id`` (law ``key``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"))
    rows = assign_shards(rows, "doc_id", equal_shards(SHARDS))
    rows = assign_shards(rows, "doc_id", equal_shards(SHARDS + 1), "grown_shard")
    return (number_within(rows, ["shard"], "slot", SLOT_BUCKETS)
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
