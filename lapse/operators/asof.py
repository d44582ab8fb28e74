"""As-of join: for each row the last event of its key up to its own date.

Both sides are put into one order (key, date, events before rows) and cut into
range partitions, so a key that holds a third of everything is spread over many
tasks.  Inside a partition a window carries the last event forward; what a
partition's first key needs from before is the last event of the partitions
before it, one row each.  No row meets all events of its key, as it would in a
join on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def asof_join(rows: DataFrame, events: DataFrame, key: str, at: str, event_at: str, take: dict[str, str],
              tie: Sequence[str] = ()) -> DataFrame:
    """``rows`` with columns of the last event whose ``event_at`` is not after ``at``.

    ``take`` maps event columns to their names in the result.  Events of one
    date are ordered by ``tie``.  Rows without a key, a date or such an event
    get NULLs; events without a key or date never count.
    """
    known = events.where(F.col(key).isNotNull() & F.col(event_at).isNotNull())
    if not known.columns or set(take.values()) & set(rows.columns):
        raise ValueError("names of event columns clash with those of the rows")
    event = F.struct(*[F.col(c).alias(n) for c, n in take.items()])
    ties = F.struct(F.lit(0).alias("_"), *tie)
    side = known.select(F.col(key).alias("_k"), F.col(event_at).alias("_at"), F.lit(0).alias("_side"), ties.alias("_tie"),
                        F.xxhash64(event).alias("_spread"), event.alias("_event"))
    types = {f.name: f.dataType for f in side.schema}
    # equal rows are spread by a number of their own
    spine = rows.select(F.col(key).cast(types["_k"]).alias("_k"), F.col(at).cast(types["_at"]).alias("_at"), F.lit(1).alias("_side"),
                        F.lit(None).cast(types["_tie"]).alias("_tie"), F.monotonically_increasing_id().alias("_spread"),
                        F.lit(None).cast(types["_event"]).alias("_event"), F.struct(*rows.columns).alias("_row"))
    order = ["_at", "_side", "_tie", "_spread"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: the partitions and what they pass on must be the same
    x = materialize(spine.unionByName(side, allowMissingColumns=True).repartitionByRange(parts, "_k", *order)
                    .withColumn("_part", F.spark_partition_id()), "asof")
    upto = Window.partitionBy("_part", "_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = x.withColumn("_found", F.last("_event", ignorenulls=True).over(upto))
    last = x.where("_side = 0").groupBy("_part").agg(
        F.max_by(F.struct("_k", "_event"), F.struct("_k", *order)).alias("_last"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (x.select("_part").distinct().join(last, "_part", "left")           # a row for each partition
               .select("_part", F.last("_last", ignorenulls=True).over(before).alias("_carried")))
    out = found.where("_side = 1").join(carried, "_part", "left")
    got = F.coalesce("_found", F.when(F.col("_carried._k") == F.col("_k"), F.col("_carried._event")))
    out = out.select("_row", got.alias("_got"))
    return out.select(*[F.col("_row")[c].alias(c) for c in rows.columns], *[F.col("_got")[n].alias(n) for n in take.values()])
