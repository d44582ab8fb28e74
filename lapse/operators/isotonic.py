"""Isotonic regression as a lower convex hull, merged in a tree.

The fitted values are the slopes of the lower hull of (cumulative weight,
cumulative sum) in order of the score.  A hull's edges are blocks: a range of
scores, its rows and its ones.  Each range partition pools its scores to the
blocks of its own hull; the blocks of ``FAN_IN`` neighbouring partitions are
pooled again, until one partition holds the hull of all.  What leaves a
partition are blocks, never scores: with whole counts a hull of N rows has
O(N^(2/3)) edges at most (corners of a convex chain on a grid), and that bounds
the last task and the model.  Slopes are compared as whole-number products.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FAN_IN = 16
BLOCK_ROWS = 10_000     # rows of an output batch


def isotonic_blocks(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(low, high, n, ones) of the blocks of the fit, in rising order of their means ``ones / n``.

    Rows without a score (NULL or NaN) or label take no part; equal scores are
    one point.
    """
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks (low, high, n, ones) in order, pooled until their means rise."""
        held: list[list] = []
        for batch in batches:
            for block in zip(*(batch[c].to_pylist() for c in ("low", "high", "n", "ones"))):
                block = list(block)
                while held and held[-1][3] * block[2] >= block[3] * held[-1][2]:
                    before = held.pop()
                    block = [before[0], block[1], before[2] + block[2], before[3] + block[3]]
                held.append(block)
        for at in range(0, len(held), BLOCK_ROWS):
            low, high, n, ones = zip(*held[at:at + BLOCK_ROWS])
            yield pa.RecordBatch.from_arrays([pa.array(low, pa.float64()), pa.array(high, pa.float64()),
                                              pa.array(n, pa.int64()), pa.array(ones, pa.int64())], ["low", "high", "n", "ones"])

    s = F.col(score).cast("double")
    blocks = (scored.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())
              .groupBy(s.alias("low")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("ones"))
              .select("low", F.col("low").alias("high"), "n", "ones"))
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        blocks = materialize(blocks.repartitionByRange(parts, "low").sortWithinPartitions("low")
                             .mapInArrow(pool, "low double, high double, n long, ones long"), "blocks")
        if parts == 1:
            return blocks
        parts = -(-parts // FAN_IN)
