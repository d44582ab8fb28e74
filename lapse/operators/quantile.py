"""Exact continuous quantiles (linear interpolation, nulls / NaN skipped) at scale.

Spark's ``percentile`` keeps a value->count map and merges it in a single
reducer per group, which does not survive billions of distinct values in one
group.  ``quantiles`` narrows instead of sorting: a histogram over buckets that
rise with the value (``STEPS`` to an octave, counted map-side) tells the bucket
of each wanted order statistic and how many values lie below it; only the values
of those buckets are pooled, spread over range partitions and ranked.  Many
quantiles and groups share both passes.  One value that a third of the rows
share is one row; values that all lie in one bucket are still spread by range.
The result equals ``percentile`` / DuckDB ``quantile_cont``:
lo + (hi - lo) * (pos - floor(pos)),  pos = q * (n - 1).

The input is read twice: write it first if it is dear to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .prefix import running_totals


STEPS = 1024            # buckets to an octave
LOWEST = 1100           # octaves below 1 that a double can reach, with room


def bucket_of(x: Column) -> Column:
    """A whole number that never falls when the double ``x`` rises."""
    size = F.least(F.floor(F.log2(F.abs(x)) * STEPS), F.lit(float(LOWEST * STEPS))).cast("long") + (LOWEST * STEPS + 1)
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0).cast("long"))


def _order_statistics(qs: Sequence[float], n: Column) -> list[tuple[int, int, Column, Column]]:
    """(quantile, 0 for the lower or 1 for the upper, rank from 0, fraction between them) of each wanted value."""
    out = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (n - 1).cast("double")
        out += [(i, t, rank, pos - F.floor(pos)) for t, rank in ((0, F.floor(pos)), (1, F.ceil(pos)))]
    return out


def quantiles(df: DataFrame, value_col: str, qs: Sequence[float], group_cols: Sequence[str] = (),
              *, alias: str = "value") -> DataFrame:
    """Rows ``(*group_cols, q, alias)`` for every non-empty group and every q."""
    g = list(group_cols)
    x = (df.select(*g, F.col(value_col).cast("double").alias("x"))
           .where(F.col("x").isNotNull() & ~F.isnan("x")).withColumn("_b", bucket_of(F.col("x"))))
    counts = x.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))       # a row for each bucket
    below = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_below", F.coalesce(F.sum("n").over(below), F.lit(0))).withColumn("_all", F.sum("n").over(whole))
    held = lambda rank, first, n: (rank >= first) & (rank < first + n)
    wanted = F.lit(False)
    for _, _, rank, _ in _order_statistics(qs, F.col("_all")):
        wanted = wanted | held(rank, F.col("_below"), F.col("n"))
    # at most two buckets for each quantile and group
    brackets = materialize(placed.where(wanted).select(*g, "_b", "_below", "_all"), "brackets")
    keys = [*g, "_b"]
    other = brackets.withColumnsRenamed({k: f"{k}__w" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"{k}__w")) for k in keys]
    pooled = (x.join(other, same).groupBy(*keys, "_below", "_all", "x").agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(pooled, keys, "x", ["n"])
    first = F.col("_below") + F.col("n_run") - F.col("n")
    hit = [F.when(held(rank, first, F.col("n")), F.struct(F.lit(i).alias("qi"), F.lit(t).alias("t"), frac.alias("frac")))
           for i, t, rank, frac in _order_statistics(qs, F.col("_all"))]
    hits = (ranked.select(*g, "x", F.explode(F.array_compact(F.array(*hit))).alias("h"))
                  .groupBy(*g, "h.qi")
                  .agg(F.max(F.when(F.col("h.t") == 0, F.col("x"))).alias("v_lo"),
                       F.max(F.when(F.col("h.t") == 1, F.col("x"))).alias("v_hi"), F.max("h.frac").alias("frac")))
    q_of = F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("qi") + 1)
    return hits.select(*g, q_of.alias("q"),
                       (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac")).alias(alias))


def quantile_cont(df: DataFrame, col: str, q: float, *, alias: str = "value",
                  exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """One-row DataFrame ``[alias]`` (NULL when there is no value).

    ``exact=False`` uses the mergeable GK sketch (``percentile_approx``).
    """
    if not exact:
        x = (df.select(F.col(col).cast("double").alias("x"))
               .where(F.col("x").isNotNull() & ~F.isnan("x")))
        return x.agg(F.percentile_approx("x", F.lit(q), accuracy).alias(alias))
    v = quantiles(df, col, [q], alias=alias).select(alias)
    return df.sparkSession.range(1).select(v.scalar().alias(alias))


def quantile_array(df: DataFrame, col: str, qs: Sequence[float], *, alias: str = "edges"):
    """Scalar-subquery Column: array of the quantiles in ascending q order."""
    v = quantiles(df, col, qs)
    arr = v.agg(F.transform(F.array_sort(F.collect_list(F.struct("q", "value"))),
                            lambda s: s["value"]).alias(alias))
    return arr.scalar()
