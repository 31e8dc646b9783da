"""Random forest on scaled vectors."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import binary_label, levels_below
from flowlens.operators import trees as grower
from flowlens.workspace import discard, discard_path, materialize, shared_dir

#: Bins of a feature that a tree tells apart (Spark's default).
BINS = 32
#: From so many rows on a forest is fitted on the cells of its bins, if these are at most a quarter of the rows.
MANY_ROWS, ROWS_PER_CELL = 2_000_000, 4
#: Trees fitted at the same time; cells in a file; cells that a task of one tree's fit reads.
TREES_AT_ONCE, CELLS_PER_FILE, CELLS_PER_TASK = 8, 50_000, 125_000
#: From so many cells times trees on each tree is grown by one task, if a task can hold all cells.
MANY_CELLS = 100_000
#: A forest whose splits make at most so many cells of all features is applied to many rows through a table of these.
TABLE_CELLS = 250_000


def forest(
    trees: int = K.FOREST["trees"],
    depth: int = K.FOREST["depth"],
    subset: str = K.FOREST["subset"],
    weight_col: str | None = K.CLASS_WEIGHT,
    seed: int = K.SEED,
    vec: str = K.SCALED_VECTOR,
    label: str = K.LABEL_INDEX,
) -> RandomForestClassifier:
    weights = {"weightCol": weight_col} if weight_col else {}
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy=subset, seed=seed,
        featuresCol=vec, labelCol=label, **weights,
    )


def features_per_split(subset: str, features: int) -> int | str:
    """How many features a split of a forest may choose from; a strategy that isn't known here stands for itself."""
    counts = {
        "all": features,
        "sqrt": math.ceil(math.sqrt(features)),
        "log2": max(1, math.ceil(math.log(features) / math.log(2))),
        "onethird": math.ceil(features / 3),
    }
    return counts.get(subset, subset)


def fit_forest(df: DataFrame, by_cells: bool | None = None, **params) -> PipelineModel:
    """A forest on all rows. Many rows that share few cells are fitted by ``fit_on_cells``; ``by_cells`` decides otherwise.

    The plain fit keeps each row's node of every tree, so that a level of the trees costs a row one step and not the
    way from the root; the forest is the same.
    """
    rows = df.count() if by_cells is None else 0
    if by_cells or rows >= MANY_ROWS:
        model = fit_on_cells(df, None if by_cells else rows // ROWS_PER_CELL, **params)
        if model is not None:
            return PipelineModel(stages=[model])
    learner = forest(**params).setCacheNodeIds(True).setCheckpointInterval(-1)
    return Pipeline(stages=[learner]).fit(df)


def bin_values(df: DataFrame, vec: str = K.SCALED_VECTOR) -> list[list[float]]:
    """For each feature the ascending values that stand for its bins, from all rows.

    A feature of at most ``BINS`` values has them all; another has its ends and quantiles between them.
    """
    x = df.select(vector_to_array(vec).alias("x"))
    first = x.first()
    if first is None:
        return []
    at = [F.col("x")[i] for i in range(len(first.x))]
    between = [i / (BINS - 1) for i in range(1, BINS - 1)]

    def quantiles(i: int) -> Column:
        return F.percentile_approx(at[i], between)

    # quantiles cost most: only of features that may have more values than bins; the approximate number is off by some percent
    ends = x.agg(*[F.struct(F.approx_count_distinct(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")) for c in at]).first()
    few = [i for i in range(len(at)) if ends[i].n <= 2 * BINS]
    many = [i for i in range(len(at)) if ends[i].n > BINS * 3 // 4]
    read = x.agg(F.lit(0), *[F.collect_set(at[i]) for i in few], *map(quantiles, many)).first()[1:]  # some 2 * BINS values a feature
    values, inner = dict(zip(few, map(sorted, read))), dict(zip(many, read[len(few) :]))
    late = [i for i in few if len(values[i]) > BINS and i not in inner]
    inner |= dict(zip(late, x.agg(F.lit(0), *map(quantiles, late)).first()[1:])) if late else {}
    found = []
    for i, end in enumerate(ends):
        whole = i in values and len(values[i]) <= BINS
        found.append(values[i] if whole else sorted({end.low, *inner[i], end.high}))
    return found


def forest_cells(
    df: DataFrame, values: Sequence[Sequence[float]], vec: str, label: str, weight_col: str | None, held: Column | None = None
) -> DataFrame:
    """Rows per cell: label, weight, the vector of the bins' values as an array, and the number of rows ``n``.

    A value belongs to the nearest bin value, of two as near to the lower. That is the side on which a tree puts it
    that splits halfway between neighbouring bin values, as trees fitted on the cells do.
    ``held`` is NULL at rows to fit on and the weight of the others, which ``n`` leaves out and the column ``held`` adds up.
    """
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    out = F.lit(None).cast("double") if held is None else held
    x = df.select(
        F.col(label).cast("double").alias("label"), weight.alias("weight"), vector_to_array(vec).alias("x"), out.alias("held")
    )
    borders = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in values]
    bins = [levels_below(F.col("x")[i], cuts).alias(f"b{i}") for i, cuts in enumerate(borders)]
    counted = x.select("label", "weight", "held", *bins).groupBy("label", "weight", *(f"b{i}" for i in range(len(bins)))).agg(
        F.count_if(F.col("held").isNull()).alias("n"), F.coalesce(F.sum("held"), F.lit(0.0)).alias("held")
    )
    at = [F.element_at(F.array(*map(F.lit, v)), F.col(f"b{i}") + 1) for i, v in enumerate(values)]
    return counted.select("label", "weight", F.array(*at).alias("x"), "n", *(["held"] if held is not None else []))


def with_draws(cells: DataFrame, trees: int, seed: int) -> DataFrame:
    """``cells`` with a weight per tree, ``w0`` and so on: how often bootstrapping draws the cell's rows, times their weight.

    Each row is drawn a Poisson(1) number of times, the ``n`` rows of a cell thus Poisson(n) times. The numbers depend on
    the cell and the seed only.
    """
    names = [f"w{i}" for i in range(trees)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = (batch.column(c).to_numpy() for c in ("key", "n"))
            drawn = [np.random.default_rng([seed, int(key) & (2**64 - 1)]).poisson(m, trees) for key, m in zip(keys, n)]
            weights = np.array(drawn, dtype=float).reshape(-1, trees) * batch.column("weight").to_numpy()[:, None]
            columns = [batch.column("label"), batch.column("x"), *(pa.array(weights[:, i]) for i in range(trees))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "x", *names])

    keyed = cells.withColumn("key", F.xxhash64("label", "weight", "x"))
    return keyed.mapInArrow(run, "label double, x array<double>, " + ", ".join(f"{n} double" for n in names))


def fit_on_cells(
    df: DataFrame,
    most: int | None = None,
    trees: int = K.FOREST["trees"],
    depth: int = K.FOREST["depth"],
    subset: str = K.FOREST["subset"],
    weight_col: str | None = K.CLASS_WEIGHT,
    seed: int = K.SEED,
    vec: str = K.SCALED_VECTOR,
    label: str = K.LABEL_INDEX,
) -> RandomForestClassificationModel | None:
    """A forest of all rows, fitted on the cells that the features' bins cut them into; None if there are more than ``most``.

    A tree tells no more than ``BINS`` bins of a feature apart, so rows of one label and weight in one cell are the same to
    it. Every row counts, in a cell's number of rows. The cells are bounded by the bins, however many rows there are.
    Each tree is fitted by itself on its own bootstrap weights: of many cells that a task can hold by a task of its own
    (``trees.grow``), else by Spark ML in few tasks, as others are fitted at the same time; the trees are then put together.
    """
    spark, values = df.sparkSession, bin_values(df, vec)
    if not values:
        return None
    cells = materialize(forest_cells(df, values, vec, label, weight_col), "cells")
    number = cells.count()
    if most is not None and number > most:
        discard(cells)
        return None
    given = df.schema[label].metadata
    if not {"num_vals", "vals"} & set(given.get("ml_attr", {})):
        given = {"ml_attr": {"type": "nominal", "num_vals": int(cells.agg(F.max("label")).first()[0]) + 1}}
    per_split = features_per_split(subset, len(values))
    if trees * number >= MANY_CELLS and isinstance(per_split, int) and grower.fits(number, len(values)):
        like = forest(trees, depth, subset, weight_col, seed, vec, label)
        model = _grown(cells, values, like, given["ml_attr"], per_split)
        discard(cells)
        return model
    drawn = materialize(with_draws(cells, trees, seed), "draws", rows_per_file=CELLS_PER_FILE)
    rows = drawn.withColumn(vec, array_to_vector("x")).withColumn(label, F.col("label").alias(label, metadata=given))

    def fit(i: int) -> RandomForestClassificationModel:
        learner = forest(1, depth, subset, f"w{i}", seed + i, vec, label).setBootstrap(False)
        return learner.fit(rows.where(F.col(f"w{i}") > 0).select(label, vec, f"w{i}").coalesce(-(-number // CELLS_PER_TASK)))

    with ThreadPool(TREES_AT_ONCE) as pool:
        fitted = pool.map(inheritable_thread_target(spark)(fit), range(trees), chunksize=1)
    discard(cells)
    discard(drawn)
    return _made_of(spark, [m._java_obj.trees()[0] for m in fitted], fitted[0])


def classes_of(attribute: dict) -> int:
    """The number of classes that the metadata of a label tells of."""
    return int(attribute["num_vals"]) if "num_vals" in attribute else len(attribute["vals"])


def _grown(
    cells: DataFrame, values: Sequence[Sequence[float]], like: RandomForestClassifier, attribute: dict, per_split: int
) -> RandomForestClassificationModel:
    """A forest as ``like`` fits it, its trees grown by tasks on all cells. Spark ML reads it in its own format of saved models."""
    spark, trees, classes = cells.sparkSession, like.getNumTrees(), classes_of(attribute)
    vec, label = like.getFeaturesCol(), like.getLabelCol()
    own = grower.packed(cells, values, classes)
    path, shape = shared_dir(spark, "grown"), shared_dir(spark, "shape")
    marked = F.col(label).alias(label, metadata={"ml_attr": attribute})
    one = spark.createDataFrame([(0.0, [0.0] * len(values), 1.0)], f"`{label}` double, x array<double>, w double")
    small = like.copy({like.numTrees: 1, like.maxDepth: 0, like.featureSubsetStrategy: "all"})
    if like.isSet(like.weightCol):
        one = one.withColumnRenamed("w", like.getWeightCol())
    template = small.fit(one.withColumn(vec, array_to_vector("x")).withColumn(label, marked))
    template.write().save(shape)
    given = json.loads(spark.read.text(f"{shape}/metadata").first()[0])
    given["paramMap"] |= {"numTrees": trees, "maxDepth": like.getMaxDepth(), "featureSubsetStrategy": like.getFeatureSubsetStrategy()}
    spark.createDataFrame([(json.dumps(given | {"numTrees": trees}),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    about = json.loads(spark.read.parquet(f"{shape}/treesMetadata").first()[1])
    about["paramMap"] |= {"maxDepth": like.getMaxDepth()}
    rows = [(i, json.dumps(about | {"uid": f"{about['uid']}_{i}"}), 1.0) for i in range(trees)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    nodes = grower.grown_nodes(spark, own, trees, like.getMaxDepth(), per_split, like.getSeed(), classes)
    inner = F.col("feature") >= 0
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    data = F.struct(*(c for c in nodes.columns if c not in ("treeID", "feature", "threshold")), split.alias("split"))
    nodes.select("treeID", data.alias("nodeData")).write.parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    for folder in (path, shape):
        discard_path(spark, folder)
    return model


def part_of(spark: SparkSession, model: RandomForestClassificationModel, low: int, high: int) -> RandomForestClassificationModel:
    """The forest of the trees from ``low`` up to ``high`` of a fitted one."""
    return _made_of(spark, model._java_obj.trees()[low:high], model)


def _made_of(spark: SparkSession, trees: Sequence, like: RandomForestClassificationModel) -> RandomForestClassificationModel:
    """A forest of the given trees, with the features and classes of ``like``."""
    gateway = spark.sparkContext._gateway
    some = gateway.new_array(gateway.jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        some[i] = tree
    made = gateway.jvm.org.apache.spark.ml.classification.RandomForestClassificationModel
    java = made(some, like.numFeatures, like.numClasses)
    java.set(java.numTrees(), len(trees))  # a saved forest is read back by this number
    return RandomForestClassificationModel(java).setFeaturesCol(like.getFeaturesCol())


def running_predictions(model: RandomForestClassificationModel, df: DataFrame, sizes: Sequence[int]) -> tuple[DataFrame, list[str]]:
    """``df`` with a prediction column for the first trees of a forest, for each of the ascending ``sizes``.

    Every tree votes once: the votes of the trees between two sizes are added to those of the trees before. Of
    classes with equal votes the first wins, as in a forest's own prediction.
    """
    votes, names, low = None, [], 0
    for high in sizes:
        part = part_of(df.sparkSession, model, low, high).setPredictionCol("").setProbabilityCol("").setRawPredictionCol("__votes")
        df = part.transform(df)
        own = vector_to_array("__votes")
        df = df.withColumn("__sum", own if votes is None else F.zip_with("__sum", own, lambda a, b: a + b)).drop("__votes")
        votes, low = "__sum", high
        names.append(f"__prediction_{high}")
        df = df.withColumn(names[-1], (F.array_position("__sum", F.array_max("__sum")) - 1).cast("double"))
    return df.drop("__sum"), names


def cell_table(spark: SparkSession, model: RandomForestClassificationModel) -> tuple[list[list[float]], DataFrame, Column] | None:
    """For each feature the ascending thresholds of all splits, the forest's columns for each cell that these make, and the
    cell of an array ``__x``.

    None if there are more than ``TABLE_CELLS`` or a split goes by categories. Made once per model.
    """
    if not hasattr(model, "cell_table"):
        path = shared_dir(spark, "splits")
        model.write().save(path)
        split = F.col("nodeData.split")
        inner = spark.read.parquet(f"{path}/data").where(F.col("nodeData.leftChild") >= 0)
        cut = F.when(split["numCategories"] == -1, split["leftCategoriesOrThreshold"][0])
        found = inner.groupBy(split["featureIndex"].alias("f")).agg(F.sort_array(F.collect_set(cut)).alias("cuts"), F.count_if(cut.isNull()).alias("no"))
        rows = found.collect()  # a row per feature, with no more thresholds than it has bins
        discard_path(spark, path)
        cuts = {r["f"]: r["cuts"] for r in rows}
        cuts = [cuts.get(i, []) for i in range(model.numFeatures)]
        known = not any(r["no"] for r in rows) and math.prod(len(c) + 1 for c in cuts) <= TABLE_CELLS
        model.cell_table = (cuts, _by_cell(spark, model, cuts), _cell(cuts)) if known else None
    return model.cell_table


def _by_cell(spark: SparkSession, model: RandomForestClassificationModel, cuts: Sequence[Sequence[float]]) -> DataFrame:
    at, stride = [], 1
    for own in cuts:
        ends = F.array(*(F.lit(float(c)) for c in [*own, math.inf]))
        at.append(F.element_at(ends, (F.floor(F.col("__cell") / stride) % (len(own) + 1) + 1).cast("int")))
        stride *= len(own) + 1
    cells = spark.range(0, stride, 1, 4 * spark.sparkContext.defaultParallelism).withColumnRenamed("id", "__cell")
    applied = model.transform(cells.withColumn(model.getFeaturesCol(), array_to_vector(F.array(*at))))
    return materialize(applied.drop(model.getFeaturesCol()), "cells")


def _cell(cuts: Sequence[Sequence[float]]) -> Column:
    cell, stride = F.lit(0).cast("long"), 1
    for i, own in enumerate(cuts):
        cell += levels_below(F.col("__x")[i], own) * F.lit(stride).cast("long")
        stride *= len(own) + 1
    return F.when(F.col("__x").isNotNull(), cell)


def transform_by_cells(model: RandomForestClassificationModel, df: DataFrame) -> DataFrame:
    """What ``model.transform(df)`` gives, through a table of the forest's cells if they are few.

    Rows between the same thresholds of every feature go the same way through every tree. The cells
    follow from the forest alone, whatever the rows.
    """
    known = cell_table(df.sparkSession, model)
    if known is None:
        return model.transform(df)
    rows = df.withColumn("__x", vector_to_array(model.getFeaturesCol())).withColumn("__cell", known[2]).drop("__x")
    return rows.join(F.broadcast(known[1]), "__cell", "left").drop("__cell")


def predict(model: PipelineModel, df: DataFrame, benign: float = 0.0, by_cells: bool | None = None) -> DataFrame:
    """Predicted class, class probabilities and the 0/1 columns of truth and prediction.

    Many rows go through ``transform_by_cells``, with the same result; ``by_cells`` decides otherwise. Read them from a written table.
    """
    if by_cells or by_cells is None and len(model.stages) == 1 and df.count() >= MANY_ROWS:
        applied = transform_by_cells(model.stages[-1], df)
    else:
        applied = model.transform(df)
    return applied.withColumns(
        {
            K.FLAG: binary_label(F.col(K.PREDICTION), benign),
            K.TRUTH: binary_label(F.col(K.LABEL_INDEX), benign),
        }
    )


def attack_probability(df: DataFrame, out: str = K.SCORE, probability: str = K.PROBABILITY, benign: int = 0) -> DataFrame:
    """1 minus the probability of the benign class, as a plain score column."""
    return df.withColumn(out, F.lit(1.0) - vector_to_array(probability)[benign])


def feature_importance(
    spark: SparkSession, model: PipelineModel, features: Sequence[str], k: int | None = None
) -> DataFrame:
    """(feature, importance), highest first; names come from the feature list the vectors follow."""
    scores = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(score)) for name, score in zip(sorted(features), scores, strict=True)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), F.asc("feature"))
    return ranked.limit(k) if k else ranked
