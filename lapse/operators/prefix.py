"""Running totals over an ordered value, without a task per group.

Rows are range-partitioned by (group, value), so partitions are even however
the values are spread (one outlier, or one group with everything); totals per
partition give each partition its start, a window per partition does the rest.
There is one path for every size: a small frame has small partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def running_totals(d: DataFrame, group_cols: Sequence[str], value: str, counts: Sequence[str],
                   descending: bool = False) -> DataFrame:
    """``d`` with ``<c>_run`` (total up to and including the row, in order of
    ``value``) and ``<c>_all`` (group total) for each column of ``counts``.

    ``d`` has at most one row per (group, value): pool ties first.
    """
    g = list(group_cols)
    by = F.desc(value) if descending else F.asc(value)
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: both passes must see the same ranges
    x = materialize(d.repartitionByRange(parts, *g, by).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = x.groupBy(*g, "_part").agg(*[F.sum(c).alias(c) for c in counts])
    whole = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per range partition and group
    starts = totals.select(*g, "_part",
                           *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_start") for c in counts],
                           *[F.sum(c).over(whole).alias(f"{c}_all") for c in counts])
    run = Window.partitionBy(*g, "_part").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = [*g, "_part"]
    starts = starts.withColumnsRenamed({k: f"{k}__s" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"{k}__s")) for k in keys]         # a NULL group is a group
    out = x.select("*", *[F.sum(c).over(run).alias(f"{c}_run") for c in counts]).join(starts, same)
    for c in counts:
        out = out.withColumn(f"{c}_run", F.col(f"{c}_run") + F.col(f"{c}_start"))
    return out.drop("_part", *[f"{k}__s" for k in keys], *[f"{c}_start" for c in counts])
