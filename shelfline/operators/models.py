"""Demand model: boosted trees trained by Spark, batch scoring, importances."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, isqrt

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.forecast import forecast_metrics
from shelfline.session import materialize, scratch_path, shuffle_width

IDS = ["store_id", "product_id"]
BANDS = ["store_cluster", "volume_band"]
NUMERIC = ["discount_factor", "year", "month", "day", "hour"]
# Trees, learning rate, depth, seed.
TREES, RATE, DEPTH, SEED = 100, 0.1, 6, 42


@dataclass
class DemandModel:
    """A fitted model: the sales per id and fold, the overall mean, feature stages and trees."""

    encodings: dict[str, DataFrame]
    overall: DataFrame
    stages: PipelineModel
    trees: GBTRegressionModel


#: rows are put together by their bins where at most this share of them remains
MOST_SHARE = 0.9
#: parts of the training rows; a row is encoded by the means of the other parts
FOLDS = 5


def fold_totals(df: DataFrame, target: str) -> DataFrame:
    """Sum and number of the target per series, bands and fold, as two arrays in a stored table: one pass over the rows serves the
    overall mean, the encodings and the categories."""
    own = [F.when(F.col("_fold") == i, F.col(target)) for i in range(FOLDS)]
    return materialize(df.groupBy(*IDS, *BANDS).agg(
        F.array(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in own]).alias("_s"), F.array(*[F.count(x) for x in own]).alias("_n"), F.count("*").alias("_rows")), "totals")


def mean_encoding(totals: DataFrame, col: str) -> DataFrame:
    """Sum and number of the target per id and fold, as two arrays in a stored table. Ids grow with the data, so they
    are encoded by an aggregate and a join; a label index would gather them all on the driver."""
    folds = lambda c: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(FOLDS)])
    return materialize(totals.groupBy(col).agg(folds("_s").alias("_s"), folds("_n").alias("_n")), "encoding")


def overall_mean(totals: DataFrame) -> DataFrame:
    """The mean target as one row."""
    add = lambda c: sum((F.get(c, F.lit(i)) for i in range(FOLDS)), F.lit(0.0))
    return materialize(totals.agg((F.sum(add("_s")) / F.nullif(F.sum(add("_n")), F.lit(0.0))).alias("_overall")), "overall")


def band_index(totals: DataFrame) -> list[StringIndexerModel]:
    """The categories of each band, the most frequent first, as ``StringIndexer`` orders them."""
    labels = {c: [r[0] for r in totals.where(F.col(c).isNotNull()).groupBy(c).agg(F.sum("_rows").alias("_rows")).orderBy(F.desc("_rows"), c).collect()] for c in BANDS}
    return [StringIndexerModel.from_labels(own, inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c, own in labels.items()]


def encode(df: DataFrame, encodings: dict[str, DataFrame], overall: DataFrame) -> DataFrame:
    """Add the mean target of the ids; an unseen id gets the overall mean.

    Training rows carry ``_fold`` and take the mean of the other folds, so that no row is encoded by its own target.
    """
    out = df.join(F.broadcast(overall))  # one row
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    for col, table in encodings.items():
        # the means are taken once per id, the last one over all folds
        mean = lambda s, n: s / F.nullif(n, F.lit(0.0))
        means = F.array(*[mean(add("_s") - F.get("_s", F.lit(i)), add("_n") - F.get("_n", F.lit(i))) for i in range(FOLDS)], mean(add("_s"), add("_n")))
        out = out.join(table.select(col, means.alias("_means")), col, "left")
        own = F.get("_means", F.col("_fold") if "_fold" in df.columns else F.lit(FOLDS))
        out = out.withColumn(f"{col}_mean", F.coalesce(own, F.col("_overall"))).drop("_means")
    return out.drop("_overall")


def feature_cuts(gbt: GBTRegressor, rows: DataFrame) -> list[list[float] | int]:
    """Where the trainer cuts each feature of these rows, found by its own step: at most ``maxBins`` values a feature.
    A feature that is a category has the number of its kinds instead."""
    jvm, module = rows.sparkSession._jvm, lambda at, name: getattr(getattr(at, f"{name}$"), "MODULE$")
    ml = jvm.org.apache.spark.ml
    gbt._transfer_params_to_java()
    kinds = module(ml.util, "MetadataUtils").getCategoricalFeatures(rows._jdf.schema().apply("features"))
    strategy = gbt._java_obj.getOldBoostingStrategy(kinds, jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()).treeStrategy()
    instances = module(ml.util, "DatasetUtils").extractInstances(gbt._java_obj, rows._jdf, module(jvm.scala, "None"))
    metadata = module(ml.tree.impl, "DecisionTreeMetadata").buildMetadata(instances, strategy, 1, gbt.getFeatureSubsetStrategy())
    found = module(ml.tree.impl, "RandomForest").findSplits(instances, metadata, gbt.getSeed())
    return [sorted({s.threshold() for s in own}) if metadata.isContinuous(f) else metadata.numBins()[f] for f, own in enumerate(found)]


def binned(rows: DataFrame, target: str, cuts: list[list[float] | int]) -> DataFrame:
    """One row for each combination of bins that occurs: the bins as ``features``, the mean target and the number of rows as ``_weight``.

    Trees see the bins of a row only. Rows of a combination always get one prediction, so gains and leaf values follow from their number
    and mean, and the trees are those of all rows. Combinations grow with the bins that occur together and not with the rows;
    where hardly any two rows share one, there are as many as rows.
    """
    x = rows.select(F.col(target).cast("double").alias("_y"), vector_to_array("features").alias("_x")).select("_y", *[F.get("_x", F.lit(i)).alias(f"_b{i}") for i in range(len(cuts))])
    cut = [i for i, c in enumerate(cuts) if c and not isinstance(c, int)]
    if cut:  # the trees send a value that equals the cut to the left
        x = Bucketizer(splitsArray=[[-np.inf, *np.nextafter(cuts[i], np.inf).tolist(), np.inf] for i in cut],
                       inputCols=[f"_b{i}" for i in cut], outputCols=[f"_c{i}" for i in cut]).transform(x)
    # the bins of a row are packed into as few numbers as hold them
    words, at, used = [], {}, 64
    for i, c in enumerate(cuts):
        bits = (c if isinstance(c, int) else len(c) + 1).bit_length()
        if used + bits > 62:
            words, used = [*words, F.lit(0).cast("long")], 0
        bin_ = F.col(f"_c{i}") if i in cut else F.col(f"_b{i}") if isinstance(c, int) else F.lit(0)
        words[-1], at[i], used = words[-1].bitwiseOR(F.shiftleft(bin_.cast("long"), used)), (len(words) - 1, used, 2**bits - 1), used + bits
    names = [f"_w{k}" for k in range(len(words))]
    cells = x.select("_y", *[w.alias(k) for k, w in zip(names, words)]).groupBy(*names).agg(F.avg("_y").alias(target), F.count("*").cast("double").alias("_weight"))
    bins = [F.shiftrightunsigned(f"_w{k}", low).bitwiseAND(F.lit(mask)).cast("double").alias(f"_b{i}") for i, (k, low, mask) in at.items()]
    out = VectorAssembler(inputCols=[f"_b{i}" for i in at], outputCol="_f").transform(cells.select(target, "_weight", *bins))
    # which features are categories is kept beside the column
    return materialize(out.select(F.col("_f").alias("features", metadata=rows.schema["features"].metadata), target, "_weight"), "binned")


def with_cuts(trees: GBTRegressionModel, cuts: list[list[float] | int], spark) -> GBTRegressionModel:
    """Trees over bins as trees over the values, with the number of rows in each node: at most trees x 2^(depth + 1) nodes."""
    path = scratch_path(spark, "trees")
    trees.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    held = [r.asDict(recursive=True) for r in nodes.collect()]
    for r in held:
        node = r["nodeData"]
        node["rawCount"] = round(node["impurityStats"][0])
        if node["leftChild"] >= 0 and node["split"]["numCategories"] < 0:
            of = cuts[node["split"]["featureIndex"]]
            node["split"]["leftCategoriesOrThreshold"] = [of[ceil(node["split"]["leftCategoriesOrThreshold"][0]) - 1]]
    spark.createDataFrame(held, nodes.schema).write.mode("overwrite").parquet(f"{path}/data")
    return GBTRegressionModel.load(path)


def train(df: DataFrame, target: str = "observed_sales", trees: int = TREES, max_bins: int = 64) -> DemandModel:
    """Gradient-boosted regression over all rows, two low-cardinality categories indexed.

    Every level of every tree reads its rows again, so rows that fall into the same bins of all features are put together first.
    """
    df = df.withColumn("_fold", F.pmod(F.xxhash64(*df.columns), F.lit(FOLDS)).cast("int"))
    totals = fold_totals(df, target)
    overall = overall_mean(totals)
    encodings = {c: mean_encoding(totals, c) for c in IDS}
    assemble = VectorAssembler(inputCols=[f"{c}_mean" for c in IDS] + [f"{c}_i" for c in BANDS] + NUMERIC, outputCol="features")
    stages = PipelineModel(stages=[*band_index(totals), assemble])
    ready = materialize(stages.transform(encode(df, encodings, overall)).select("features", target), "features")
    gbt = GBTRegressor(labelCol=target, maxIter=trees, stepSize=RATE, maxDepth=DEPTH, seed=SEED, maxBins=max_bins, checkpointInterval=10)
    cuts = feature_cuts(gbt, ready)
    cells = binned(ready, target, cuts)
    n, rows = cells.count(), ready.count()  # from the files' footers
    if n > MOST_SHARE * rows or n < max_bins:  # the trainer asks for at least as many rows as a category has kinds
        return DemandModel(encodings, overall, stages, gbt.fit(ready))
    # each bin is one value here; with as many bins allowed the trainer looks at all rows to find them, not at some
    gbt = gbt.copy({gbt.weightCol: "_weight", gbt.maxBins: min(max(max_bins, isqrt(n) + 1), 46_340)})
    return DemandModel(encodings, overall, stages, with_cuts(gbt.fit(cells), cuts, df.sparkSession))


def score(model: DemandModel, df: DataFrame) -> DataFrame:
    """``forecasted_demand``, never below zero, beside the input columns."""
    ready = model.stages.transform(encode(df, model.encodings, model.overall))
    out = model.trees.transform(ready)
    return out.withColumn("forecasted_demand", F.greatest(F.lit(0.0), F.col("prediction"))).select(*df.columns, "forecasted_demand")


def feature_importance(model: DemandModel, spark) -> DataFrame:
    """Gain importances of the trees, one row per feature."""
    values = model.trees.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(IDS + BANDS + NUMERIC, values)], "feature string, importance double")


def permutation_importance(model: DemandModel, df: DataFrame, features, target: str = "observed_sales", seed: int = SEED) -> DataFrame:
    """Rise of the RMSE when a feature's values are exchanged between rows.

    Each row takes the value of the next row in a hash order within a hash bucket; there
    is a bucket per shuffle partition, so the exchange stays distributed.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(shuffle_width(df.sparkSession)))
    w = Window.partitionBy("_b").orderBy(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]))
    # one order serves all features, and the rows are read again for each
    rows = materialize(df.withColumn("_b", bucket).withColumns({f"_v_{f}": F.coalesce(F.lead(f).over(w), F.col(f)) for f in features}).drop("_b"), "permuted")
    base = forecast_metrics(score(model, rows.select(*df.columns)), target, "forecasted_demand").select(F.col("rmse").alias("base_rmse"))
    parts = []
    for f in features:
        mixed = rows.select(*[F.col(f"_v_{f}").alias(f) if c == f else F.col(c) for c in df.columns])
        m = forecast_metrics(score(model, mixed), target, "forecasted_demand")
        parts.append(m.select(F.lit(f).alias("feature"), "rmse"))
    out = reduce(DataFrame.unionByName, parts)
    return out.join(F.broadcast(base)).select("feature", (F.col("rmse") - F.col("base_rmse")).alias("rmse_increase"))  # base is one row
