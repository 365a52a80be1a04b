"""Attribution of single predictions to features, over the trees that Spark fitted."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.models import BANDS, IDS, NUMERIC, DemandModel, encode
from shelfline.session import scratch_path

#: the features of the demand model in the order of its vector
FEATURES = [*IDS, *BANDS, *NUMERIC]
#: rows that are attributed together; bounds what is kept of the conditions
SLICE = 4096


@dataclass
class Leaf:
    """A leaf as the path to it: for each feature on the path what it admits, and the share of the training rows that went the
    same way; and the attributions of each pattern of features that admit a row (bit j for the j-th feature)."""

    features: list[int]
    low: list[float]
    high: list[float]
    categories: list[frozenset | None]
    shares: list[float]
    value: float
    table: np.ndarray | None = None


def leaves_of(nodes: dict[int, dict], weight: float) -> list[Leaf]:
    """The leaves of one tree from its stored nodes, each with the conditions and cover shares along its path."""
    found, todo = [], [(0, {})]
    while todo:
        at, path = todo.pop()
        node = nodes[at]
        if node["leftChild"] < 0:
            parts = sorted(path.items())
            found.append(Leaf([f for f, _ in parts], [p[0] for _, p in parts], [p[1] for _, p in parts], [p[2] for _, p in parts],
                              [p[3] for _, p in parts], node["prediction"] * weight))
            continue
        split = node["split"]
        f, cut = split["featureIndex"], split["leftCategoriesOrThreshold"]
        low, high, kinds, share = path.get(f, (-np.inf, np.inf, None, 1.0))
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            part = share * nodes[child]["rawCount"] / node["rawCount"]
            if split["numCategories"] < 0:
                own = (low, min(high, cut[0]), kinds, part) if left else (max(low, cut[0]), high, kinds, part)
            else:
                side = frozenset(cut) if left else frozenset(float(i) for i in range(split["numCategories"])) - frozenset(cut)
                own = (low, high, side if kinds is None else kinds & side, part)
            todo.append((child, {**path, f: own}))
    return found


def pattern_table(leaf: Leaf) -> np.ndarray:
    """Shapley values of the leaf for each pattern.

    Without a feature a row goes on with the share of the training rows that did, with it by its own value; so the worth of a set of
    features is a product over the path, and the sum over sets of one size is a coefficient of the product of
    (share + admitted t). The arrays run over all patterns at once.
    """
    d = len(leaf.features)
    admitted = (np.arange(2**d)[:, None] >> np.arange(d) & 1).astype(float)
    out = np.zeros((2**d, d))
    for j in range(d):
        sizes = np.zeros((2**d, d))
        sizes[:, 0] = 1.0
        for n, g in enumerate(g for g in range(d) if g != j):
            sizes[:, 1:n + 2] = sizes[:, 1:n + 2] * leaf.shares[g] + sizes[:, :n + 1] * admitted[:, g:g + 1]
            sizes[:, 0] *= leaf.shares[g]
        weights = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
        out[:, j] = leaf.value * (admitted[:, j] - leaf.shares[j]) * (sizes @ weights)
    return out


@dataclass
class Attributor:
    """All leaves of a model. What is sent to tasks is bounded by the model: trees x 4^depth x depth numbers at most."""

    leaves: list[Leaf]
    base: float
    size: int

    def attribute(self, x: np.ndarray) -> np.ndarray:
        """Attributions of each row of ``x`` to each feature."""
        parts = [self.attribute_slice(x[i:i + SLICE]) for i in range(0, len(x), SLICE)]
        return np.concatenate(parts) if parts else np.zeros((0, self.size))

    def attribute_slice(self, x: np.ndarray) -> np.ndarray:
        """The same of few rows. Leaves share most of their conditions, so each distinct one is tried once and its answers, a byte a row, are kept.
        The row of a leaf's table that a pattern asks for is taken whole and added to those of the leaves with the same features."""
        columns, out, tried, sums = np.ascontiguousarray(x.T), np.zeros((self.size, len(x))), {}, {}
        for leaf in self.leaves:
            code = np.zeros(len(x), np.min_scalar_type(2 ** len(leaf.features) - 1))  # a bit for each feature on the path
            for j, f in enumerate(leaf.features):
                condition = (f, leaf.low[j], leaf.high[j], leaf.categories[j])
                if condition not in tried:
                    ok = (columns[f] > leaf.low[j]) & (columns[f] <= leaf.high[j])
                    if leaf.categories[j] is not None:
                        ok &= np.isin(columns[f], list(leaf.categories[j]))
                    tried[condition] = ok
                code |= tried[condition] * code.dtype.type(1 << j)
            part = leaf.table.take(code, axis=0)
            if (own := tuple(leaf.features)) in sums:
                sums[own] += part
            else:
                sums[own] = part
        for features, part in sums.items():
            for j, f in enumerate(features):
                out[f] += part[:, j]
        return out.T


def attributor(trees, spark, size: int) -> Attributor:
    """From a fitted boosted-tree model: its nodes are written to the shared folder and read as a table of nodes."""
    path = scratch_path(spark, "trees")
    trees.write().overwrite().save(path)
    by_tree: dict[int, dict[int, dict]] = {}
    for r in spark.read.parquet(f"{path}/data").collect():  # the model's nodes, at most trees x 2^(depth + 1)
        by_tree.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"].asDict(recursive=True)
    leaves = [leaf for t, nodes in sorted(by_tree.items()) for leaf in leaves_of(nodes, trees.treeWeights[t])]
    for leaf in leaves:
        leaf.table = pattern_table(leaf)
    return Attributor(leaves, sum(leaf.value * float(np.prod(leaf.shares)) for leaf in leaves), size)


def attributions(model: DemandModel, df: DataFrame) -> DataFrame:
    """``df`` with ``base_value``, ``prediction`` (before it is cut at zero) and an ``attribution_<feature>`` for each feature.

    Base value and attributions add up to the prediction of the row. A missing feature follows the
    training rows that went each way (path-dependent). The work is one pass over the rows in Arrow batches, without a shuffle
    beyond the joins of the encoding.
    """
    spark = df.sparkSession
    own = attributor(model.trees, spark, len(FEATURES))
    sent = spark.sparkContext.broadcast(own)
    ready = model.trees.transform(model.stages.transform(encode(df, model.encodings, model.overall)))
    rows = ready.select(*df.columns, "prediction", vector_to_array("features").alias("_x"))
    columns, names = df.columns, [f"attribution_{f}" for f in FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("_x").flatten().to_numpy(zero_copy_only=False)
            values = sent.value.attribute(flat.reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros((0, len(names)))
            kept = [batch.column(c) for c in (*columns, "prediction")]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(values[:, i]) for i in range(len(names))]], [*columns, "prediction", *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + ["prediction double", *[f"{n} double" for n in names]])
    return rows.mapInArrow(run, schema).withColumn("base_value", F.lit(own.base))


def global_importance(attributed: DataFrame) -> DataFrame:
    """Mean absolute attribution of each feature, and its share of the sum."""
    means = attributed.agg(*[F.avg(F.abs(F.col(f"attribution_{f}"))).alias(f) for f in FEATURES])
    long = means.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("mean_abs")) for f in FEATURES])), sum(F.col(f) for f in FEATURES).alias("_all"))
    return long.select("feature", "mean_abs", (F.col("mean_abs") / F.nullif(F.col("_all"), F.lit(0.0))).alias("share"))
