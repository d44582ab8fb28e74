"""Membership operators: semi/anti joins, existence flags, bridge joins, key audits.

Key sets are never collected to the driver (``isin(list)``); they stay
DataFrames, pre-aggregated with ``distinct`` (map-side) before the join so a
left join can never fan out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def semi_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``members`` (``isin`` without collect)."""
    return df.join(members.select(key), key, "left_semi")


def existence_flag(spine: DataFrame, events: DataFrame, key: str, name: str) -> DataFrame:
    """spine + ``name`` = 1 if the key has at least one event, else 0."""
    keys = events.select(key).distinct().withColumn("_hit", F.lit(1))
    return (spine.join(keys, key, "left")
                 .withColumn(name, F.coalesce(F.col("_hit"), F.lit(0)).cast("int"))
                 .drop("_hit"))


def bridge_keys(facts: DataFrame, bridge: DataFrame, fact_key: str, bridge_key: str,
                target_key: str) -> DataFrame:
    """Distinct ``target_key`` values reached from ``facts`` through ``bridge``
    (card.disp_id -> disp.disp_id -> disp.account_id).  A semi join keeps one
    bridge row per match however many facts hit it; ``distinct`` dedups targets.
    """
    # distinct first: a bridge key hit by a third of all facts reaches the join as one row
    hits = facts.select(F.col(fact_key).alias(bridge_key)).distinct()
    return bridge.join(hits, bridge_key, "left_semi").select(target_key).distinct()


def key_audit(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              wrong_left_key: str, target_key: str) -> DataFrame:
    """One row comparing the right join path with a mismatched-key path.

    right path : left.left_key  == right.right_key  -> distinct left.target_key
    wrong path : left.wrong_left_key in right.right_key (keys of another space)
    """
    rk = right.select(F.col(right_key).alias("_k")).distinct()
    good = (left.join(rk, F.col(left_key) == F.col("_k"), "left_semi")
                .select(target_key).distinct().withColumn("_good", F.lit(1)))
    bad = (left.join(rk, F.col(wrong_left_key) == F.col("_k"), "left_semi")
               .select(target_key).distinct().withColumn("_bad", F.lit(1)))
    both = good.join(bad, target_key, "full")
    return both.agg(F.count("_good").alias("n_right_path"), F.count("_bad").alias("n_wrong_path"),
                    F.count(F.when(F.col("_good").isNotNull() & F.col("_bad").isNotNull(), 1)).alias("n_overlap"))
