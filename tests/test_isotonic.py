"""Isotonic regression by hulls: brute force, many distinct scores under a small heap."""

import os
import random
import subprocess
import sys

import pytest

from lapse.operators import isotonic

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plain(rows):
    """{score: fitted value}: at place i the largest over j <= i of the smallest over k >= i of the mean of j to k."""
    by = {}
    for s, y in rows:
        if s is not None and s == s and y is not None:
            n, ones = by.get(s, (0, 0))
            by[s] = n + 1, ones + y
    keys = sorted(by)
    n, ones = [by[k][0] for k in keys], [by[k][1] for k in keys]
    mean = lambda j, k: sum(ones[j:k + 1]) / sum(n[j:k + 1])
    return {s: max(min(mean(j, k) for k in range(i, len(keys))) for j in range(i + 1)) for i, s in enumerate(keys)}


@pytest.mark.parametrize("seed, n, places", [(1, 60, 40), (2, 60, 5), (3, 40, 1), (4, 2, 2), (5, 0, 1)])
@pytest.mark.parametrize("fan_in", [2, 16])
def test_against_brute_force(spark, monkeypatch, seed, n, places, fan_in):
    monkeypatch.setattr(isotonic, "FAN_IN", fan_in)
    rng = random.Random(seed)
    rows = [(rng.randrange(places) / places, int(rng.random() < 0.5)) for _ in range(n)] + [(None, 1), (float("nan"), 0), (0.5, None)]
    blocks = isotonic.isotonic_blocks(spark.createDataFrame(rows, "p double, y int"), "p", "y").collect()
    blocks.sort(key=lambda b: b["low"])
    values = [b["ones"] / b["n"] for b in blocks]
    assert all(a < b for a, b in zip(values, values[1:])) and sum(b["n"] for b in blocks) == n
    want = plain(rows)
    for s, v in want.items():
        assert abs([x for b, x in zip(blocks, values) if b["low"] <= s <= b["high"]][0] - v) < 1e-12


def test_stage_gives_the_fitted_values(spark):
    from lapse.models.train import calibrate, calibrator
    rng = random.Random(8)
    rows = [(i, p := rng.randrange(50) / 50, int(rng.random() < p)) for i in range(300)]
    df = spark.createDataFrame(rows, "account_id long, score double, churned int")
    want = plain([r[1:] for r in rows])
    for r in calibrate(calibrator(df), df).collect():
        assert abs(r["calibrated"] - want[r["score"]]) < 1e-12


SCRIPT = """
import sys; sys.path.insert(0, %r)
from pyspark.sql import functions as F
from lapse.session import get_session
from lapse.operators.isotonic import isotonic_blocks
spark = get_session("local[2]", shuffle_partitions=40, extra={"spark.driver.memory": "600m", "spark.driver.maxResultSize": "2m"})
n = 1_000_000
df = spark.range(n).select((F.col("id") / n).alias("p"), (F.pmod(F.col("id") * 2654435761, F.lit(1 << 32)) / float(1 << 32) < F.col("id") / n).cast("int").alias("y"))
rows = isotonic_blocks(df, "p", "y").orderBy("low").collect()
v = [r["ones"] / r["n"] for r in rows]
assert all(a < b for a, b in zip(v, v[1:])) and sum(r["n"] for r in rows) == n
print("BLOCKS", len(rows), sum(r["ones"] for r in rows))
"""


def test_a_million_distinct_scores_under_a_small_heap():
    said = subprocess.run([sys.executable, "-c", SCRIPT % ROOT], capture_output=True, text=True, timeout=300)
    found = [x.split() for x in said.stdout.splitlines() if x.startswith("BLOCKS")]
    assert found, said.stderr[-2000:]
    blocks, ones = int(found[0][1]), int(found[0][2])
    held, total = [], 0
    for i in range(1_000_000):      # pool-adjacent-violators over all rows at once
        y = int((i * 2654435761 % (1 << 32)) / float(1 << 32) < i / 1_000_000)
        total += y
        n = 1
        while held and held[-1][1] * n >= y * held[-1][0]:
            a, b = held.pop()
            n, y = n + a, y + b
        held.append((n, y))
    assert (blocks, ones) == (len(held), total) and blocks < 30_000
