"""Additive attributions of a fitted boosted ensemble, row by row.

A leaf is a product of tests on the features of its path.  With ``z`` the share
of the training weight that a feature's tests let through and ``o`` (0 or 1)
whether the row passes them, knowing a set S of features gives the leaf
``value * prod(o in S) * prod(z not in S)``.  The Shapley value of feature j in
this game is ``value * (o_j - z_j)`` times an integral over t in (0, 1) of
``prod over i != j of (z_i (1 - t) + o_i t)``: a polynomial of degree (features
on the path - 1), so a Gauss-Legendre rule of half as many points is exact and
no subset is enumerated.  Work per row is leaves x path length^2 / 2.

Leaves are bounded by the model (trees x 2^depth), so their table goes to every
task; rows are attributed in Arrow batches without a shuffle, and means are
taken by Spark.  A row's attributions sum to its margin less the base value
(the margin that the training weights expect).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import WINDOWS, Windows

CELLS = 1 << 21         # (row, leaf, path place) cells that are worked on together


def tree_table(spark: SparkSession, model, path: str) -> DataFrame:
    """(tree, weight, id, prediction, cover, left, right, feature, threshold) of a fitted ensemble, from Spark ML's own format."""
    model.write().overwrite().save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").select("tree", "weight")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction", F.col("nodeData.impurityStats")[0].alias("cover"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"), F.col("nodeData.split.numCategories").alias("categories"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"))
    return nodes.join(trees, "tree")


def leaf_paths(nodes: Sequence) -> dict[str, np.ndarray]:
    """Arrays over (leaf, path place): the feature, the interval (low, high] and the share ``zero`` it lets through.

    Tests of one feature on a path are one place.  Unused places let everything
    through.  ``nodes`` are rows of ``tree_table``.
    """
    by = {(n["tree"], n["id"]): n for n in nodes}
    if any(n["left"] >= 0 and n["categories"] >= 0 for n in by.values()):
        raise ValueError("splits on categories have no interval")
    leaves = []
    stack = [(n, {}) for (_, i), n in sorted(by.items()) if i == 0]
    while stack:
        node, path = stack.pop()
        if node["left"] < 0:
            leaves.append((node["weight"] * node["prediction"], path))
            continue
        for child, (low, high) in ((node["left"], (-np.inf, node["threshold"])), (node["right"], (node["threshold"], np.inf))):
            below = by[node["tree"], child]
            a, b, z = path.get(node["feature"], (-np.inf, np.inf, 1.0))
            share = below["cover"] / node["cover"] if node["cover"] else 0.0
            stack.append((below, path | {node["feature"]: (max(a, low), min(b, high), z * share)}))
    width = max([1, *(len(p) for _, p in leaves)])
    feature = np.zeros((len(leaves), width), np.int64)
    low, high = np.full(feature.shape, -np.inf), np.full(feature.shape, np.inf)
    zero = np.ones(feature.shape)
    for i, (_, path) in enumerate(leaves):
        for j, (f, (a, b, z)) in enumerate(path.items()):
            feature[i, j], low[i, j], high[i, j], zero[i, j] = f, a, b, z
    return {"value": np.array([v for v, _ in leaves]), "feature": feature, "low": low, "high": high, "zero": zero}


def base_value(paths: dict[str, np.ndarray]) -> float:
    """The margin expected without knowing any feature."""
    return float(paths["value"] @ paths["zero"].prod(axis=1))


def attributor(paths: dict[str, np.ndarray], n_features: int) -> Callable[[np.ndarray], np.ndarray]:
    """A function from rows (n, features) to their attributions (n, features).

    It holds arrays alone, so that it can be sent to tasks as it is.
    """
    value, feature, low, high, zero = (paths[k] for k in ("value", "feature", "low", "high", "zero"))
    points, shares = np.polynomial.legendre.leggauss((feature.shape[1] + 1) // 2)
    points, shares = (points + 1) / 2, shares / 2
    order = np.argsort(feature, axis=None, kind="stable")
    present, first = np.unique(feature.ravel()[order], return_index=True)
    at_once = max(1, CELLS // feature.size)

    def run(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), n_features))
        for at in range(0, len(x), at_once):
            part = np.where(np.isnan(x[at:at + at_once]), np.inf, x[at:at + at_once])[:, feature]     # NaN goes right
            passed = ((part > low) & (part <= high)).astype(float)
            total = np.zeros_like(passed)
            for t, share in zip(points, shares):
                factor = zero * (1 - t) + passed * t
                total += share * factor.prod(axis=2, keepdims=True) / factor
            total *= value[:, None] * (passed - zero)
            out[at:at + at_once, present] = np.add.reduceat(total.reshape(len(part), -1)[:, order], first, axis=1)
        return out

    return run


def attributions(df: DataFrame, features: Sequence[str], paths: dict[str, np.ndarray], key: str = "account_id") -> DataFrame:
    """(key, margin, attribution array in the order of ``features``) of every row."""
    names, attribute, base = list(features), attributor(paths, len(features)), base_value(paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch[c].to_numpy(zero_copy_only=False) for c in names]).astype(float)
            found = attribute(x)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(names), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(base + found.sum(axis=1)), flat], [key, "margin", "attribution"])

    kind = df.schema[key].dataType.simpleString()
    return (df.select(key, *[F.col(c).cast("double").alias(c) for c in names])
            .mapInArrow(run, f"`{key}` {kind}, margin double, attribution array<double>"))


def paths_of(spark: SparkSession, model: PipelineModel) -> dict[str, np.ndarray]:
    """The leaves of a fitted pipeline's booster."""
    from .train import model_path
    table = tree_table(spark, model.stages[-1], model_path(spark, "attributed"))
    return leaf_paths(table.collect())          # trees x 2^(depth + 1) nodes at most


def _explained(spark: SparkSession, sf_dir: str, w: Windows) -> tuple[DataFrame, list[str]]:
    from .train import Trainer
    r = (t := Trainer(spark, sf_dir, w)).fit_gbt()
    return attributions(t.test, r.features, paths_of(spark, r.model)), r.features


def _named(found: DataFrame, features: list[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in features])
    return found.select("account_id", "margin", F.posexplode("attribution").alias("i", "attribution")).select(
        "account_id", "margin", F.get(names, F.col("i")).alias("feature"), "attribution")


def tree_attribution(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Mean absolute attribution of every feature of the fitted booster over the test fold."""
    means = _named(*_explained(spark, sf_dir, w)).groupBy("feature").agg(
        F.avg(F.abs("attribution")).alias("importance"), F.avg("attribution").alias("mean_attribution"))
    order = Window.orderBy(F.desc("importance"), "feature")       # a row per feature
    return means.withColumn("rank", F.row_number().over(order).cast("long"))


def tree_attribution_rows(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS, k: int = 3) -> DataFrame:
    """M10 per row: the ``k`` features that move each test account's margin most."""
    found, features = _explained(spark, sf_dir, w)
    by = F.array_sort(F.transform("attribution", lambda a, i: F.struct((-F.abs(a)).alias("size"), i.alias("i"), a.alias("a"))))
    names = F.array(*[F.lit(c) for c in features])
    return (found.select("account_id", "margin", F.posexplode(F.slice(by, 1, k)).alias("at", "r"))
            .select("account_id", "margin", (F.col("at") + 1).cast("long").alias("rank"),
                    F.get(names, F.col("r")["i"]).alias("feature"), F.col("r")["a"].alias("attribution")))
