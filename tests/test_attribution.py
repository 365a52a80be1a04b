"""Tree attribution against all subsets, and the exact KS probability against all orders."""

import itertools
import random
from math import factorial

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfline.operators import attribution, drift


@pytest.fixture(scope="module")
def trees(spark):
    rnd = random.Random(1)
    rows = [(rnd.random(), rnd.random(), float(rnd.randrange(3)), rnd.random()) for _ in range(400)]
    df = spark.createDataFrame([(*r, 2 * r[0] + r[1] * r[2] + 0.1 * r[3]) for r in rows], "a double, b double, c double, d double, y double")
    ready = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    return GBTRegressor(labelCol="y", maxIter=4, maxDepth=4, seed=1).fit(ready), rows


def worth(own, known, x):
    """Prediction when only the features in ``known`` are: the others follow the training rows."""
    total = 0.0
    for leaf in own.leaves:
        part = leaf.value
        for j, f in enumerate(leaf.features):
            part *= float(leaf.low[j] < x[f] <= leaf.high[j]) if f in known else leaf.shares[j]
        total += part
    return total


def test_attributions_are_those_of_all_subsets(spark, trees):
    model, rows = trees
    own = attribution.attributor(model, spark, 4)
    x = np.array(rows[:25])
    got = own.attribute(x)
    for r, phi in zip(x, got):
        for f in range(4):
            others = [g for g in range(4) if g != f]
            want = sum(factorial(k) * factorial(3 - k) / factorial(4) * (worth(own, {*s, f}, r) - worth(own, set(s), r))
                       for k in range(4) for s in itertools.combinations(others, k))
            assert abs(phi[f] - want) < 1e-10
        assert abs(own.base + phi.sum() - model.predict(__import__("pyspark.ml.linalg", fromlist=["Vectors"]).Vectors.dense(r))) < 1e-9


def test_categories_on_a_path():
    node = lambda i, left, right, n, y, split=None: {"id": i, "leftChild": left, "rightChild": right, "rawCount": n, "prediction": y, "split": split}
    split = lambda f, cut, k: {"featureIndex": f, "leftCategoriesOrThreshold": cut, "numCategories": k}
    nodes = {0: node(0, 1, 2, 10, 0.0, split(0, [0.0, 2.0], 3)), 1: node(1, -1, -1, 4, 5.0), 2: node(2, 3, 4, 6, 0.0, split(1, [0.5], -1)), 3: node(3, -1, -1, 3, 1.0), 4: node(4, -1, -1, 3, 2.0)}
    leaves = attribution.leaves_of(nodes, 1.0)
    for leaf in leaves:
        leaf.table = attribution.pattern_table(leaf)
    own = attribution.Attributor(leaves, 5 * 0.4 + 0.6 * 0.5 + 2 * 0.6 * 0.5, 2)
    for x, y in (((0.0, 0.1), 5.0), ((2.0, 0.9), 5.0), ((1.0, 0.1), 1.0), ((1.0, 0.9), 2.0)):
        assert abs(own.base + own.attribute(np.array([x])).sum() - y) < 1e-12


def by_orders(d, n, m):
    """Share of all orders of n and m values with a gap of d or more."""
    hit = total = 0
    for ups in itertools.combinations(range(n + m), m):
        i = j = 0
        far = 0
        for k in range(n + m):
            i, j = (i, j + 1) if k in ups else (i + 1, j)
            far = max(far, abs(i * m - j * n))
        hit, total = hit + (far >= round(d * n * m)), total + 1
    return hit / total


@pytest.mark.parametrize("n,m", [(1, 1), (3, 3), (5, 2), (4, 7), (8, 8), (6, 1)])
def test_exact_probability_is_the_share_of_orders(n, m):
    for edge in range(n * m + 1):
        assert abs(drift.exceedance(edge / (n * m), n, m) - by_orders(edge / (n * m), n, m)) < 1e-12


def test_exact_and_asymptotic_meet(spark):
    df = spark.createDataFrame([("small", 0.5, 20, 30), ("large", 0.05, 1000, 1000), ("beyond", 0.05, 1001, 1000), ("one", 1.0, 1000, 1000)], "feature string, ks double, n_base long, n_cur long")
    both = drift.ks_pvalue_by_size(df).withColumn("far", drift.ks_pvalue(F.col("ks"), F.col("n_base"), F.col("n_cur")))
    got = {r.feature: r for r in both.collect()}
    assert got["beyond"].p_value == got["beyond"].far and got["small"].p_value != got["small"].far
    assert abs(got["large"].p_value - got["large"].far) < 0.02 and 0 <= got["one"].p_value < 1e-200
    assert drift.ks_pvalue_by_size(df.limit(0)).count() == 0


def test_leaves_name_their_features_in_one_order():
    """Paths that meet the same features in another order are added up together, to the same attributions."""
    node = lambda i, left, right, n, y, split=None: {"id": i, "leftChild": left, "rightChild": right, "rawCount": n, "prediction": y, "split": split}
    split = lambda f, cut: {"featureIndex": f, "leftCategoriesOrThreshold": [cut], "numCategories": -1}
    trees = [{0: node(0, 1, 2, 10, 0.0, split(a, 0.5)), 1: node(1, -1, -1, 4, 5.0), 2: node(2, 3, 4, 6, 0.0, split(b, 0.5)), 3: node(3, -1, -1, 2, 1.0), 4: node(4, -1, -1, 4, 2.0)} for a, b in ((0, 1), (1, 0))]
    leaves = [leaf for nodes in trees for leaf in attribution.leaves_of(nodes, 1.0)]
    assert sorted(leaf.features for leaf in leaves) == [[0], [0, 1], [0, 1], [0, 1], [0, 1], [1]]
    for leaf in leaves:
        leaf.table = attribution.pattern_table(leaf)
    base = sum(leaf.value * float(np.prod(leaf.shares)) for leaf in leaves)
    own = attribution.Attributor(leaves, base, 2)
    for x, y in (((0.1, 0.1), 10.0), ((0.9, 0.9), 4.0), ((0.9, 0.1), 6.0), ((0.1, 0.9), 6.0)):
        phi = own.attribute(np.array([x]))[0]
        assert abs(base + phi.sum() - y) < 1e-12
        for f in range(2):
            alone = worth(own, {f}, x) - worth(own, set(), x)
            beside = worth(own, {0, 1}, x) - worth(own, {1 - f}, x)
            assert abs(phi[f] - (alone + beside) / 2) < 1e-12
