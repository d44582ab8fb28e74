"""Seeded, stratified, exact-size splits that do not depend on row order.

Each row gets h = md5(key || '#' || salt).  Inside its class a row's rank is
its position in h order; the first round(n_class * pct / 100) ranks form the
held-out fold.  A plain ``row_number() over (partition by class)`` would sort
each class in ONE task; instead the rank is built in two levels:

  1. counts per (class, first 3 hex digits of h)  -> <= classes x 4096 rows,
     cumulative offsets over that small frame;
  2. ``row_number`` inside (class, prefix) windows -> 4096 parallel windows
     per class, balanced because md5 is uniform, however skewed the classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX_HEX = 3


def salted_hash(key: str, salt) -> F.Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{salt}")))


def class_rank(df: DataFrame, key: str, label: str, salt) -> DataFrame:
    """df + ``_rank`` (0-based rank in class by salted hash) + ``_n_class``."""
    h = df.withColumn("_h", salted_hash(key, salt)).withColumn(
        "_b", F.conv(F.substring("_h", 1, PREFIX_HEX), 16, 10).cast("int"))
    counts = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wc = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wt = Window.partitionBy(label)
    offsets = (counts.withColumn("_off", F.sum("_c").over(wc) - F.col("_c"))
                     .withColumn("_n_class", F.sum("_c").over(wt))
                     .select(label, "_b", "_off", "_n_class"))
    wr = Window.partitionBy(label, "_b").orderBy("_h", key)
    # the window has the rows where the join wants them
    return (h.withColumn("_in", F.row_number().over(wr)).join(offsets, [label, "_b"])
             .withColumn("_rank", F.col("_off") + F.col("_in") - 1)
             .drop("_h", "_b", "_off", "_in"))


def holdout_size(n_class, pct: int):
    """round-half-up(n * pct / 100) in integer arithmetic."""
    return F.expr(f"({n_class} * {int(pct)} + 50) div 100") if isinstance(n_class, str) else \
        ((n_class * int(pct) + 50) / 100).cast("long")


def stratified_split(df: DataFrame, key: str, label: str, pct: int, salt,
                     held_out: str = "test", rest: str = "train", fold_col: str = "fold") -> DataFrame:
    r = class_rank(df, key, label, salt)
    return (r.withColumn(fold_col, F.when(F.col("_rank") < holdout_size("_n_class", pct), F.lit(held_out))
                                   .otherwise(F.lit(rest)))
             .drop("_rank", "_n_class"))

