"""As-of join, bucketed layout, reduced curves."""

import random

import pytest
from pyspark.sql import functions as F

from lapse.operators.asof import asof_join


def plain(rows, events):
    out = []
    for i, k, at in rows:
        seen = [(d, e) for kk, d, e in events if kk == k and k is not None and d is not None and at is not None and d <= at]
        out.append((i, k, at, *(max(seen)[::-1] if seen else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, keys, days, hot", [(1, 6, 30, 0.0), (2, 1, 50, 1.0), (3, 9, 3, 0.5), (4, 40, 400, 0.3)])
def test_against_plain(spark, seed, keys, days, hot):
    """A hot key lies in many range partitions; what they pass on must be right."""
    rng = random.Random(seed)
    key = lambda: 3 if rng.random() < hot else rng.choice([None, *range(keys)])
    rows = [(i, key(), rng.choice([None, rng.randrange(days), rng.randrange(days)])) for i in range(150)]
    rows += [rows[0]] * 3
    events = [(key(), rng.choice([None, rng.randrange(days)] + [rng.randrange(days)] * 4), e) for e in range(rng.choice([0, 20, 120]))]
    left = spark.createDataFrame(rows, "id long, k long, at int").repartition(3)
    right = spark.createDataFrame(events, "k int, d int, e long").repartition(2)
    got = asof_join(left, right, "k", "at", "d", {"e": "last_e", "d": "last_d"}, ["e"])
    assert got.columns == ["id", "k", "at", "last_e", "last_d"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, events)


def test_hot_key_is_spread(spark):
    from lapse import session
    seen = {}
    session.MATERIALIZE_HOOKS.append(lambda name, df: seen.update({name: [r.n for r in df.groupBy("_part").agg(F.count("*").alias("n")).collect()]}))
    try:
        rows = spark.range(4000).select("id", F.lit(1).alias("k"), (F.col("id") % 1000).alias("at"))
        got = asof_join(rows, rows.select("k", F.col("at").alias("d")), "k", "at", "d", {"d": "last_d"})
        assert got.where("last_d <=> at").count() == 4000
    finally:
        session.MATERIALIZE_HOOKS.pop()
    parts = seen["asof"]
    assert len(parts) >= 6 and max(parts) <= 0.35 * sum(parts)


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, 2)], "k int, at int")
    with pytest.raises(ValueError):
        asof_join(df, df, "k", "at", "at", {"at": "at"})


def test_bucketed_tables_need_no_exchange(spark, sf_dir):
    from lapse.plans.roundtrip import rewrite_by_account
    df = rewrite_by_account(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("AdaptiveSparkPlan", "") and plan.count("Bucketed: true") == 2, plan


def test_corners_keep_the_area(spark):
    from lapse.operators.curves import corners, score_curve
    rng = random.Random(4)
    rows = [(rng.randrange(400) / 400, int(rng.random() < 0.4)) for _ in range(900)] + [(0.5, 1)] * 50
    curve = score_curve(spark.createDataFrame(rows, "p double, y int"), "p", "y")
    points = lambda c: sorted((r["fp"], r["tp"]) for r in c.collect())
    whole, few = points(curve), points(corners(curve))
    area = lambda ps: sum((x1 - x0) * (y0 + y1) for (x0, y0), (x1, y1) in zip([(0, 0)] + ps, ps))
    assert area(whole) == area(few) and set(few) <= set(whole) and len(few) < len(whole) and few[-1] == whole[-1]
    around = list(zip([(0, 0)] + few, few, few[1:]))
    assert all((b[0] - a[0]) * (c[1] - b[1]) != (c[0] - b[0]) * (b[1] - a[1]) for a, b, c in around)
