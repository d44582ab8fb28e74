"""Tree attributions: subsets by enumeration, additivity on a fitted booster, truncated boosters."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.models import attribution as at
from lapse.models.train import ModelParams, Trainer, gbt, positive_probability, truncated


def random_tree(rng, tree, features, depth):
    nodes = []

    def grow(level, cover):
        i = len(nodes)
        nodes.append({"tree": tree, "weight": 0.5 + tree, "id": i, "prediction": rng.normal(), "cover": cover, "left": -1, "right": -1,
                      "feature": -1, "categories": -1, "threshold": None})
        if level < depth and (level == 0 or rng.random() < 0.8):
            share = rng.uniform(0.1, 0.9)
            nodes[i] |= {"feature": int(rng.integers(features)), "threshold": float(rng.integers(-2, 3)),
                         "left": grow(level + 1, cover * share), "right": grow(level + 1, cover * (1 - share))}
        return i

    grow(0, 100.0)
    return nodes


def expected(nodes, x, known):
    """The tree's value if only the features of ``known`` are known: others weigh both children."""
    by = {n["id"]: n for n in nodes}

    def walk(n):
        if n["left"] < 0:
            return n["prediction"]
        a, b = by[n["left"]], by[n["right"]]
        if n["feature"] in known:
            return walk(a if x[n["feature"]] <= n["threshold"] else b)
        return (a["cover"] * walk(a) + b["cover"] * walk(b)) / n["cover"]

    return nodes[0]["weight"] * walk(by[0])


@pytest.mark.parametrize("depth, features", [(1, 2), (2, 3), (3, 4), (5, 4)])
def test_equals_enumeration(depth, features):
    rng = np.random.default_rng(depth)
    trees = [random_tree(rng, t, features, depth) for t in range(6)]
    paths = at.leaf_paths([n for t in trees for n in t])
    x = rng.integers(-3, 4, (12, features)).astype(float)
    x[0, 0] = np.nan
    got = at.attributor(paths, features)(x)
    value = lambda row, s: sum(expected(t, row, s) for t in trees)
    for row, phi in zip(x, got):
        for j in range(features):
            rest = [f for f in range(features) if f != j]
            want = sum(math.factorial(len(s)) * math.factorial(features - len(s) - 1) / math.factorial(features)
                       * (value(row, {*s, j}) - value(row, set(s)))
                       for n in range(features) for s in itertools.combinations(rest, n))
            assert abs(phi[j] - want) < 1e-9
        assert abs(phi.sum() + at.base_value(paths) - value(row, set(range(features)))) < 1e-9


def test_small_blocks_and_no_rows(monkeypatch):
    rng = np.random.default_rng(3)
    paths = at.leaf_paths(random_tree(rng, 0, 3, 4))
    x = rng.normal(size=(50, 3))
    whole = at.attributor(paths, 3)(x)
    monkeypatch.setattr(at, "CELLS", 1)
    assert np.array_equal(at.attributor(paths, 3)(x), whole)
    assert at.attributor(paths, 3)(x[:0]).shape == (0, 3)
    stump = at.leaf_paths([random_tree(rng, 0, 1, 0)[0] | {"left": -1}])
    assert at.attributor(stump, 3)(x).any() == False and stump["value"].shape == (1,)  # noqa: E712


@pytest.fixture(scope="module")
def trainer(spark):
    return Trainer(spark, "/root/testdata/sf0.01", params=ModelParams(gbt_iter=20))


def test_sums_to_the_margin(spark, trainer):
    r = trainer.fit_gbt()
    paths = at.paths_of(spark, r.model)
    assert len(paths["value"]) <= len(r.model.stages[-1].trees) * 2 ** trainer.params.gbt_depth
    from pyspark.ml.functions import vector_to_array
    margin = r.model.transform(trainer.test).select("account_id", vector_to_array("rawPrediction")[1].alias("real"))
    both = at.attributions(trainer.test, r.features, paths).join(margin, "account_id")
    total = F.aggregate("attribution", F.lit(0.0), lambda a, b: a + b)
    worst = both.agg(F.max(F.abs(F.col("real") - F.col("margin"))), F.max(F.abs(F.col("real") - at.base_value(paths) - total)),
                     F.count(F.lit(1))).first()
    assert worst[0] < 1e-6 and worst[1] < 1e-6 and worst[2] == trainer.test.count()


def test_queries(spark, monkeypatch):
    from lapse.models import train
    monkeypatch.setattr(train.PARAMS, "gbt_iter", 12)
    top = at.tree_attribution(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["rank"] for r in top) == list(range(1, len(top) + 1)) and all(r["importance"] >= abs(r["mean_attribution"]) for r in top)
    rows = at.tree_attribution_rows(spark, "/root/testdata/sf0.001").collect()
    by = {}
    for r in rows:
        by.setdefault(r["account_id"], {})[r["rank"]] = abs(r["attribution"])
    assert all(sorted(v) == [1, 2, 3] and v[1] >= v[2] >= v[3] for v in by.values())


def test_truncated_booster_is_a_shorter_fit(spark, trainer):
    feats = trainer.features
    long = gbt(feats, trainer.params, 9).fit(trainer.fit_part)
    short = gbt(feats, trainer.params, 4).fit(trainer.fit_part)
    cut = truncated(spark, long, 4)
    assert len(cut.stages[-1].trees) == 4
    scores = lambda m: {r.account_id: r.score for r in positive_probability(m, trainer.test).select("account_id", "score").collect()}
    assert scores(cut) == scores(short)
    with pytest.raises(ValueError):
        truncated(spark, long, 10)
