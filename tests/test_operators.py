"""Quantile, split, curve and permutation operators against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.operators.curves import ap_from_curve, auc_from_curve, score_curve
from lapse.operators.profile import null_census, numeric_profile
from lapse.operators.quantile import quantile_cont, quantiles
from lapse.operators.split import stratified_split


def _vals(seed, n, skew=False):
    rnd = random.Random(seed)
    v = [rnd.gauss(0, 1) * 10 ** rnd.randint(-3, 3) for _ in range(n)]
    if skew:                     # a third of all rows hold one value
        v[: n // 3] = [0.75] * (n // 3)
    return v


@pytest.mark.parametrize("seed,n,skew", [(1, 1, False), (2, 2, False), (3, 500, False), (4, 999, True)])
def test_quantiles_equal_numpy(spark, seed, n, skew):
    v = _vals(seed, n, skew)
    df = spark.createDataFrame([(x,) for x in v] + [(None,), (float("nan"),)], "x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.q: r.value for r in quantiles(df, "x", qs).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.percentile(np.array(v), q * 100)), rel=1e-12, abs=1e-12)


def test_grouped_quantiles_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), ("c", None)], "g string, x double")
    got = {(r.g, r.q): r.value for r in quantiles(df, "x", [0.5], ["g"]).collect()}
    assert got == {("a", 0.5): 2.0, ("b", 0.5): 10.0}
    empty = spark.createDataFrame([(None,)], "x double")
    assert quantile_cont(empty, "x", 0.5).first().value is None


@pytest.mark.parametrize("values", [
    [float(i) for i in range(400)] + [1e15],             # one outlier
    [7.25] * 300,                                         # one value for all rows
    [0.0, -0.0, 1e-300, -1e300, 1e300],
])
def test_quantiles_of_odd_distributions(spark, values):
    df = spark.createDataFrame([(x,) for x in values], "x double").repartition(5)
    got = {r.q: r.value for r in quantiles(df, "x", [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
    for q, v in got.items():
        assert v == pytest.approx(float(np.percentile(np.array(values), q * 100)), rel=1e-12, abs=1e-300)


def test_outlier_does_not_fill_one_partition(spark):
    from lapse.operators.prefix import running_totals
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 1e15).otherwise(F.exp(F.col("id") / 9000)).alias("x"),
                                    F.lit(1).cast("long").alias("n"))
    sizes = running_totals(df, [], "x", ["n"]).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 20_000
    rows = running_totals(df, [], "x", ["n"]).orderBy("x").collect()
    assert [r.n_run for r in rows] == list(range(1, 20_001)) and {r.n_all for r in rows} == {20_000}


def test_running_totals_keep_null_groups(spark):
    from lapse.operators.prefix import running_totals
    df = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("a", 1.0, 5)], "g string, x double, n long")
    got = {(r.g, r.x): (r.n_run, r.n_all) for r in running_totals(df, ["g"], "x", ["n"], descending=True).collect()}
    assert got == {(None, 2.0): (3, 5), (None, 1.0): (5, 5), ("a", 1.0): (5, 5)}


def _brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def _brute_ap(s, y):
    P = sum(y)
    order = sorted(set(s), reverse=True)
    ap, tp, fp = 0.0, 0, 0
    for t in order:
        pos = sum(1 for a, b in zip(s, y) if a == t and b == 1)
        neg = sum(1 for a, b in zip(s, y) if a == t and b == 0)
        tp, fp = tp + pos, fp + neg
        ap += pos / P * tp / (tp + fp)
    return ap


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_auc_ap_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    s = [round(rnd.random(), 2) for _ in range(300)]          # many ties
    y = [int(rnd.random() < 0.2 + 0.5 * x) for x in s]
    df = spark.createDataFrame(list(zip(s, y)), "p double, y int")
    curve = score_curve(df, "p", "y")
    assert auc_from_curve(curve).first().roc_auc == pytest.approx(_brute_auc(s, y), abs=1e-12)
    assert ap_from_curve(curve).first().average_precision == pytest.approx(_brute_ap(s, y), abs=1e-9)
    flipped = df.withColumn("p", 1 - F.col("p"))
    assert auc_from_curve(score_curve(flipped, "p", "y")).first().roc_auc == pytest.approx(1 - _brute_auc(s, y), abs=1e-12)


def test_metric_edges(spark):
    tied = spark.createDataFrame([(0.3, 0), (0.3, 1), (0.3, 1)], "p double, y int")
    assert auc_from_curve(score_curve(tied, "p", "y")).first().roc_auc == 0.5
    one_class = spark.createDataFrame([(0.3, 1), (0.6, 1)], "p double, y int")
    assert auc_from_curve(score_curve(one_class, "p", "y")).first().roc_auc is None
    perfect = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "p double, y int")
    assert auc_from_curve(score_curve(perfect, "p", "y")).first().roc_auc == 1.0
    two = spark.createDataFrame([(0.9, 0), (0.1, 1)], "p double, y int")
    assert auc_from_curve(score_curve(two, "p", "y")).first().roc_auc == 0.0


def test_auc_of_huge_counts(spark):
    """2e9 positives and 8e9 negatives: products pass the range of LONG."""
    curve = spark.createDataFrame(
        [(0.9, 1_500_000_000, 1_000_000_000, 1_500_000_000, 1_000_000_000, 2_000_000_000, 8_000_000_000),
         (0.1, 500_000_000, 7_000_000_000, 2_000_000_000, 8_000_000_000, 2_000_000_000, 8_000_000_000)],
        "s double, pos long, neg long, tp long, fp long, P long, N long")
    want = (1.5e9 * 7e9 + 0.5 * (1.5e9 * 1e9 + 0.5e9 * 7e9)) / (2e9 * 8e9)
    assert auc_from_curve(curve).first().roc_auc == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("rows", [[(0.3, 1), (0.6, 1)], [(0.3, 0), (0.6, 0)], [], [(None, 1), (float("nan"), 0)]])
def test_points_of_one_class_and_of_nothing(spark, rows):
    from lapse.plans.metrics import pr_points_of, roc_points_of
    df = spark.createDataFrame(rows, "p double, y int")
    curve = score_curve(df, "p", "y")
    scored = [r for r in rows if r[0] == r[0] and r[0] is not None]
    roc, pr = roc_points_of(curve).collect(), pr_points_of(curve).collect()
    assert len(roc) == len(pr) == len(scored) + 1
    only = {y for _, y in scored}
    for r in roc:
        if r.threshold is not None:
            assert (r.tpr is None) == (1 not in only) and (r.fpr is None) == (0 not in only)
    assert ap_from_curve(curve).first().average_precision is None or 1 in only


def test_grouped_curves(spark):
    df = spark.createDataFrame([("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.9, 0), ("b", 0.1, 1)], "g string, p double, y int")
    got = {r.g: r.roc_auc for r in auc_from_curve(score_curve(df, "p", "y", ["g"]),
                                                  ["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_stratified_split_exact_sizes_and_order_free(spark):
    rows = [(i, int(i % 10 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, y int")
    s1 = {r.k: r.fold for r in stratified_split(df, "k", "y", 20, 42).collect()}
    s2 = {r.k: r.fold for r in stratified_split(df.orderBy(F.rand(7)).repartition(5), "k", "y", 20, 42).collect()}
    assert s1 == s2
    test = [k for k, f in s1.items() if f == "test"]
    assert sum(1 for k in test if k % 10 == 0) == 20          # round(100 * 0.2)
    assert sum(1 for k in test if k % 10 != 0) == 180         # round(900 * 0.2)


def test_profile_and_null_census(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (3.0, None), (4.0, 1.0)], "a double, b double")
    p = {r.column: r for r in numeric_profile(df, ["a"]).collect()}["a"]
    assert (p["count"], p.mean, p.min, p.q25, p.q50, p.q75, p.max) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert p.std == pytest.approx(1.290994, abs=1e-6)
    nc = {r.column: r.n_null for r in null_census(df).collect()}
    assert nc == {"a": 0, "b": 2}


def _written(spark, make):
    """Rows of each table that ``make`` writes on its way, by name."""
    from lapse import session
    seen = []
    hook = lambda name, df: seen.append((name, df.count()))
    session.MATERIALIZE_HOOKS.append(hook)
    try:
        return make(), dict(seen)
    finally:
        session.MATERIALIZE_HOOKS.remove(hook)


@pytest.mark.parametrize("name, expr, most", [
    ("spread", "exp(rand(3) * 12)", 0.01), ("normal", "randn(4) * 100", 0.01), ("one value", "7.25D", 1e-4),
    ("hot value", "if(rand(5) < 0.4, 5.0D, rand(6) * 10)", 0.01), ("outlier", "if(id = 7, 1e300D, rand(7))", 0.01),
    ("one bucket", "1 + rand(8) / 1e6", 1.0)])
def test_only_brackets_are_ranked(spark, name, expr, most):
    """What is written and sorted is a small part of the values, unless all lie in one bucket."""
    n = 40_000
    df = spark.range(n, numPartitions=4).selectExpr("id", f"CAST({expr} AS double) AS x")
    qs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got, written = _written(spark, lambda: {r.q: r.value for r in quantiles(df, "x", qs).collect()})
    x = np.sort(np.array([r.x for r in df.collect()]))
    for q in qs:
        assert got[q] == pytest.approx(np.quantile(x, q), rel=1e-12)
    assert written["ranged"] <= max(1, most * len(set(x.tolist()))) and written["brackets"] <= 2 * len(qs)


def test_buckets_rise(spark):
    from lapse.operators.quantile import bucket_of
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, float("inf"), float("-inf"), 1.0, 2.0]])
    df = spark.createDataFrame([(float(v),) for v in np.sort(x)], "x double")
    b = [r[0] for r in df.select(bucket_of(F.col("x"))).collect()]
    assert b == sorted(b) and None not in b
