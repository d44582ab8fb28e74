"""Audit / profile operators: one aggregate pass, then an unpivot to long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantile import quantiles

PROFILE_DIGITS = 6


def numeric_profile(df: DataFrame, cols: Sequence[str], digits: int = PROFILE_DIGITS) -> DataFrame:
    """``describe()``: column, count, mean, std, min, q25, q50, q75, max.

    Moments come from one aggregate over the long form; the three exact
    quartiles of every column come from one shared set of quantile passes.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("kv")
    ).select("kv.column", "kv.v")
    mom = long.groupBy("column").agg(
        F.count("v").alias("count"),
        F.round(F.avg("v"), digits).alias("mean"),
        F.round(F.stddev_samp("v"), digits).alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"))
    qs = quantiles(long, "v", [0.25, 0.5, 0.75], ["column"])
    qw = qs.groupBy("column").agg(
        *[F.round(F.max(F.when(F.col("q") == q, F.col("value"))), digits).alias(n)
          for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return mom.join(qw, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def null_census(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """column, n_null: one aggregate pass, unpivoted."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null").fillna(0, ["n_null"])


def sentinel_census(df: DataFrame, cols: Sequence[str], sentinel: str = "?") -> DataFrame:
    """column, n_sentinel: how many values still equal the sentinel text."""
    wide = df.agg(*[F.sum((F.col(c).cast("string") == F.lit(sentinel)).cast("long")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "n_sentinel").fillna(0, ["n_sentinel"])


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """table, n_rows, n_cols for every named DataFrame (one count job each, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def date_range_audit(sources: dict[str, DataFrame], lo: str, hi: str) -> DataFrame:
    """source, min_d, max_d, n_before (d < lo), n_after (d > hi) per date column."""
    parts = []
    for name, df in sources.items():
        d = F.col("d")
        parts.append(df.agg(F.min(d).alias("min_d"), F.max(d).alias("max_d"),
                            F.count(F.when(d < F.lit(lo).cast("date"), 1)).alias("n_before"),
                            F.count(F.when(d > F.lit(hi).cast("date"), 1)).alias("n_after"))
                       .select(F.lit(name).alias("source"), "min_d", "max_d", "n_before", "n_after"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
