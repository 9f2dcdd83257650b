"""Default models on Spark ML: splitting, training, comparing, explaining."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.columns import half_even, stable_hash
from loanloom.operators import evaluation, tree_shapley
from loanloom.operators.audit import AUC_TARGET
from loanloom.operators.distributions import sample_rows
from loanloom.operators.features import CATEGORICALS, numeric_columns
from loanloom.operators.ordered import order_cuts, small_copy
from loanloom.operators.scoring import DECISION_THRESHOLD, class_weights, predicted_label
from loanloom.session import ROWS_PER_BUCKET, materialise

LABEL = "defaulted"
WEIGHT = "class_weight"
FOLDS = 5
#: Fits side by side in a cross-validation, and rows of a part of such a fit at least.
FITS, FOLD_ROWS = 10, 50_000
#: Training rows of fits side by side at most, where one fit has fewer: a forest of 200 trees keeps 2 to 3 KB for each row.
FIT_ROWS = 3_000_000
TEST_SHARE = 0.20
SEED = 42
PENALTY_C = 0.1

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
BOOSTING = "Gradient Boosting"


def model_inputs(features: DataFrame, exclude: Sequence[str] = ("customer_id", LABEL, *(f"{c}_id" for c in CATEGORICALS))) -> list[str]:
    """Model columns: every numeric column but ids and the label."""
    return numeric_columns(features, exclude)


def prepare(features: DataFrame, inputs: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Booleans to integers, NULL to zero; returns the table and its model columns."""
    inputs = list(inputs or model_inputs(features))
    booleans = {f.name for f in features.schema if isinstance(f.dataType, T.BooleanType)}
    columns = [F.coalesce(F.col(f"`{c}`").cast("int") if c in booleans else F.col(f"`{c}`"), F.lit(0)).alias(c)
               for c in inputs]
    return features.select("customer_id", F.col(LABEL).cast("int").alias(LABEL), *columns), inputs


def split_cuts(df: DataFrame, test_share: float = TEST_SHARE, label: str = LABEL, seed: int = SEED,
               key: str = "customer_id", hashes: Column | None = None) -> DataFrame:
    """Per class, the hash up to which its rows go to the test set; only ``label`` and ``key`` (or its ``hashes``) are read."""
    hashed = df.select(label, (stable_hash(F.col(key), seed) if hashes is None else hashes).alias("__hash"))
    return small_copy(order_cuts(hashed, "__hash", {"__cut": test_share}, by=[label]))


def stratified_split(df: DataFrame, test_share: float = TEST_SHARE, label: str = LABEL, seed: int = SEED,
                     key: str = "customer_id", cuts: DataFrame | None = None) -> DataFrame:
    """Add ``split``: the same share of every class goes to the test set.

    Rows are ordered by a hash of the key, so the split is the same for any
    partitioning; the cut per class comes from range totals, not from a window over a class.
    ``cuts`` may be those of the same keys found before.
    """
    cuts = split_cuts(df, test_share, label, seed, key) if cuts is None else cuts
    return (df.withColumn("__hash", stable_hash(F.col(key), seed)).join(cuts, label, "left")
            .withColumn("split", F.when(F.col("__hash") <= F.col("__cut"), "test").otherwise("train"))
            .drop("__hash", "__cut"))


def fold_cuts(df: DataFrame, folds: int = FOLDS, label: str = LABEL, seed: int = SEED, key: str = "customer_id",
              hashes: Column | None = None) -> DataFrame:
    """Per class, the hashes at which its folds end; only ``label`` and ``key`` (or its ``hashes``) are read."""
    hashed = df.select(label, (stable_hash(F.col(key), seed + 1) if hashes is None else hashes).alias("__hash"))
    return small_copy(order_cuts(hashed, "__hash", {f"__cut{i}": i / folds for i in range(1, folds)}, by=[label]))


def stratified_folds(df: DataFrame, folds: int = FOLDS, label: str = LABEL, seed: int = SEED,
                     key: str = "customer_id", cuts: DataFrame | None = None) -> DataFrame:
    """Add ``fold`` 0 .. folds-1, each holding the same share of every class; ``cuts`` as in :func:`stratified_split`."""
    cuts = fold_cuts(df, folds, label, seed, key) if cuts is None else cuts
    names = [f"__cut{i}" for i in range(1, folds)]
    passed = sum((F.when(F.col("__hash") > F.col(name), 1).otherwise(0) for name in names), F.lit(0))
    return (df.withColumn("__hash", stable_hash(F.col(key), seed + 1)).join(cuts, label, "left")
            .withColumn("fold", passed.cast("int")).drop("__hash", *names))


def with_class_weight(df: DataFrame, label: str = LABEL, weights: DataFrame | None = None) -> DataFrame:
    """Attach the balanced class weight."""
    weights = class_weights(df, label) if weights is None else weights
    return df.join(small_copy(weights.select(label, WEIGHT)), label)


def training_set(features: DataFrame, inputs: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Model table with split, fold and class weight, written once before training.

    Split, folds and weights follow from keys and labels alone, so the wide rows are read and written once, and the
    hashes that many passes put in order are made once for them all.
    """
    table, inputs = prepare(features, inputs)
    key = F.col("customer_id")
    keys = materialise(table.select(LABEL, F.struct(stable_hash(key, SEED).alias("split"), stable_hash(key, SEED + 1).alias("fold")).alias("hashes")))
    cuts = split_cuts(keys, hashes=F.col("hashes.split"))
    train_keys = keys.join(cuts, LABEL, "left").where(~F.coalesce(F.col("hashes.split") <= F.col("__cut"), F.lit(False)))
    weighted = with_class_weight(stratified_split(table, cuts=cuts), weights=class_weights(train_keys, LABEL))
    train = F.col("split") == "train"
    rows = stratified_folds(weighted, cuts=fold_cuts(train_keys, hashes=F.col("hashes.fold"))).withColumns(
        {WEIGHT: F.when(train, F.col(WEIGHT)).otherwise(1.0), "fold": F.when(train, F.col("fold")).otherwise(-1)})
    # Equal parts, a core each: a pass of a fit lasts as long as its largest part.
    cores = features.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, -(-keys.count() // (cores * ROWS_PER_BUCKET)))
    return materialise(rows.repartition(parts, "customer_id")), inputs


def estimators(inputs: Sequence[str], n_train: int) -> dict[str, Pipeline]:
    """The three candidate models.

    The logistic penalty follows from C: a loss summed over n balanced rows and
    scaled by C equals a mean loss with penalty ``1 / (C * n)``.
    """
    assemble = VectorAssembler(inputCols=list(inputs), outputCol="features")
    scaled = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    shared = {"labelCol": LABEL, "weightCol": WEIGHT}
    return {
        LOGISTIC: Pipeline(stages=[assemble, scaled, LogisticRegression(
            featuresCol="scaled", regParam=1.0 / (PENALTY_C * n_train), elasticNetParam=0.0,
            standardization=False, maxIter=1000, **shared)]),
        FOREST: Pipeline(stages=[assemble, RandomForestClassifier(
            numTrees=200, maxDepth=8, minInstancesPerNode=10, seed=SEED,
            cacheNodeIds=True,    # the same trees: rows keep their places instead of walking from every root for each level
            **shared)]),
        BOOSTING: Pipeline(stages=[assemble, GBTClassifier(
            labelCol=LABEL, maxIter=200, stepSize=0.05, maxDepth=4, subsamplingRate=0.8,
            minInstancesPerNode=10, seed=SEED)]),
    }


def vectors_of(pipeline: Pipeline, train: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Label, weight, ``keep`` and the vector that the first stage of ``pipeline`` makes of the inputs."""
    assemble = pipeline.getStages()[0]
    return assemble.transform(train).select(LABEL, WEIGHT, *keep, assemble.getOutputCol())


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """``pipeline`` fitted to ``train``: rows become vectors once, which are kept while its later stages pass over them."""
    assemble, *rest = pipeline.getStages()
    rows = vectors_of(pipeline, train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([assemble, *Pipeline(stages=rest).fit(rows).stages])
    finally:
        rows.unpersist()


def probability(column: str = "probability") -> Column:
    return vector_to_array(column)[1]


def score(model: PipelineModel, table: DataFrame) -> DataFrame:
    """All rows with their default probability and thresholded label."""
    scored = model.transform(table).withColumn("p_default", probability())
    drop = [c for c in ("features", "scaled", "rawPrediction", "probability", "prediction") if c in scored.columns]
    return scored.drop(*drop).withColumn("predicted", predicted_label(F.col("p_default"), DECISION_THRESHOLD))


def fold_auc(pipeline: Pipeline, train: DataFrame, fold: int) -> float:
    """AUC of one stored fold under a model of the others; ``train`` may hold the assembled vectors already."""
    assemble, *later = pipeline.getStages()
    if assemble.getOutputCol() in train.columns:
        pipeline = Pipeline(stages=later)
    # Folds run side by side: a fit of few rows keeps to few parts, as its many short jobs cost more to start than to run.
    rest = train.where(F.col("fold") != fold)
    parts = -(-rest.count() // FOLD_ROWS)
    if parts < train.sparkSession.sparkContext.defaultParallelism:
        rest = rest.coalesce(max(1, parts))
    model = pipeline.copy().fit(rest)
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    return evaluator.evaluate(model.transform(train.where(F.col("fold") == fold)))


def side_by_side(rows: int, parallelism: int = FITS) -> int:
    """Fits of ``rows`` rows that run at a time."""
    return max(1, min(parallelism, FIT_ROWS // max(1, rows)))


def mean_and_deviation(found: Sequence[float]) -> tuple[float, float]:
    mean = sum(found) / len(found)
    return mean, math.sqrt(sum((x - mean) ** 2 for x in found) / len(found))


def cross_validate(pipeline: Pipeline, train: DataFrame, parallelism: int = FITS) -> tuple[float, float]:
    """Mean and deviation of the AUC over the stored folds, each scored by a model of the others."""
    rows = vectors_of(pipeline, train, ["fold"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(side_by_side(rows.count(), parallelism)) as pool:
            return mean_and_deviation(list(pool.map(lambda fold: fold_auc(pipeline, rows, fold), range(FOLDS))))
    finally:
        rows.unpersist()


def evaluate(scored: DataFrame) -> dict[str, float]:
    """Hold-out metrics of one scored table."""
    auc = evaluation.roc_auc(scored, LABEL, "p_default").first()["roc_auc"]
    ap = evaluation.average_precision(scored, LABEL, "p_default").first()["average_precision"]
    report = evaluation.classification_report(scored, LABEL, "predicted")
    f1 = report.where(F.col("class") == "Default").first()["f1_score"]
    return {"auc_roc": auc, "f1_score": f1, "avg_precision": ap}


def compare(data: DataFrame, inputs: Sequence[str], names: Sequence[str] = (LOGISTIC, FOREST, BOOSTING),
            cross_validated: bool = True, parallelism: int = FITS,
            fitted: Callable[[str], PipelineModel] | None = None) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Train the named models and compare them on the test set.

    The best model is the first one with the highest AUC before rounding; the figures are
    rounded to 4 digits on output.  ``fitted`` may hand over models that are already trained.
    The folds of all models are fitted side by side, ``parallelism`` at a time (fewer of large tables), those of the
    slowest model first.  They share one kept copy of the rows as vectors.
    """
    train = data.where(F.col("split") == "train")
    test = data.where(F.col("split") == "test")
    size = train.count()
    candidates = estimators(inputs, size)
    slowest = sorted(names, key=[BOOSTING, FOREST, LOGISTIC].index)
    models, found, folds = {}, {}, {}
    shared = vectors_of(candidates[LOGISTIC], train, ["fold"]).persist(StorageLevel.MEMORY_AND_DISK)    # all models have the same inputs
    try:
        with ThreadPoolExecutor(side_by_side(size, parallelism)) as pool:
            if cross_validated:
                folds = {name: [pool.submit(fold_auc, candidates[name], shared, fold) for fold in range(FOLDS)] for name in slowest}
            for name in slowest:
                models[name] = fitted(name) if fitted else fit(candidates[name], train)
                found[name] = evaluate(materialise(score(models[name], test).select(LABEL, "p_default", "predicted")))
            validated = {name: mean_and_deviation([f.result() for f in each]) for name, each in folds.items()}
    finally:
        shared.unpersist()
    models = {name: models[name] for name in names}
    rows = [(name, found[name]["auc_roc"], found[name]["f1_score"], found[name]["avg_precision"]) for name in names]
    rows = [(*r, *validated.get(r[0], (None, None))) for r in rows]
    best = max(range(len(rows)), key=lambda i: (rows[i][1], -i))

    def digits(x: float | None) -> float | None:
        return None if x is None else round(x, 4)

    report = data.sparkSession.createDataFrame(
        [(r[0], *map(digits, r[1:]), i == best, TEST_SHARE, len(inputs), r[1] > AUC_TARGET) for i, r in enumerate(rows)],
        "model string, auc_roc double, f1_score double, avg_precision double, cv_auc_mean double, "
        "cv_auc_std double, best boolean, test_size double, n_features int, target_met boolean")
    return report, models


def metrics_document(report: DataFrame) -> DataFrame:
    """The comparison as one nested record: metrics per model, the best one, test share, inputs."""
    metrics = F.struct("auc_roc", "f1_score", "avg_precision", "cv_auc_mean", "cv_auc_std")
    return report.agg(
        F.map_from_entries(F.collect_list(F.struct("model", metrics))).alias("models"),
        F.max(F.when(F.col("best"), F.col("model"))).alias("best_model"),
        F.max("auc_roc").alias("best_auc"), F.max("test_size").alias("test_size"),
        F.max("n_features").alias("n_features"))


def importance_document(ranked: DataFrame, value: str) -> DataFrame:
    """A ranked feature list as one record with two parallel arrays, largest first."""
    pairs = F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("minus"), F.col("feature"))))
    return ranked.agg(pairs.alias("pairs")).select(
        F.transform("pairs", lambda p: p["feature"]).alias("features"),
        F.transform("pairs", lambda p: -p["minus"]).alias(value))


def best_model(report: DataFrame, models: dict[str, PipelineModel]) -> tuple[str, PipelineModel]:
    name = report.where("best").first()["model"]
    return name, models[name]


# -- explanations -------------------------------------------------------------

def feature_importance(model: PipelineModel, inputs: Sequence[str], spark, k: int = 20) -> DataFrame:
    """Tree importances or absolute coefficients, the ``k`` largest first."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(name, round(abs(float(v)), 6)) for name, v in zip(inputs, values.toArray())]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def linear_shapley(df: DataFrame, values: dict[str, Column], weights: dict[str, float],
                   means: dict[str, float], k: int = 20) -> DataFrame:
    """Mean absolute contribution ``w * (x - mean)`` per feature of a linear model.

    Exact over all rows in one aggregation; only its single result row is turned
    into one line per feature.
    """
    sums = df.agg(*[F.avg(F.abs(F.lit(weights[c]) * (values[c] - F.lit(means[c])))).alias(f"s{i}")
                    for i, c in enumerate(values)])
    lines = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s{i}").alias("mean_abs_shap"))
                      for i, c in enumerate(values)])
    return sums.select(F.inline(lines)).orderBy(F.desc("mean_abs_shap"), "feature").limit(k)


def linear_model_shapley(model: PipelineModel, data: DataFrame, inputs: Sequence[str], k: int = 20) -> DataFrame:
    """:func:`linear_shapley` of a fitted logistic pipeline over the scored rows."""
    scaler, classifier = model.stages[1], model.stages[-1]
    centre, width = scaler.mean.toArray(), scaler.std.toArray()
    weights = classifier.coefficients.toArray()
    values = {c: (F.col(f"`{c}`") - F.lit(float(centre[i]))) / F.lit(float(width[i]) if width[i] > 0 else 1.0)
              for i, c in enumerate(inputs)}
    # The scaler centres the training rows, so the mean scaled value is zero.
    return linear_shapley(data, values, {c: float(w) for c, w in zip(inputs, weights)},
                          {c: 0.0 for c in inputs}, k)


def shapley_values(model: PipelineModel, data: DataFrame, inputs: Sequence[str], rounds: int = 4,
                   background: int = 32, seed: int = SEED) -> DataFrame:
    """(customer_id, feature, phi, gap): Shapley values of every row by permutation sampling (Strumbelj and Kononenko 2014).

    Each row and round draws a feature order and a background row.  The walk along the order
    turns the background row into the explained one, a feature at a time: d + 1 mixed rows, whose
    predictions differ by the contributions; of equal ones in a row the first is predicted.  The contributions of a row add up to ``gap``, its mean
    prediction less that of its background rows.  ``background`` rows are drawn by key
    hash; they are an array literal of that fixed size.
    """
    inputs = list(inputs)
    size = len(inputs)
    vector = F.array(*[F.col(f"`{c}`").cast("double") for c in inputs])
    pool = [list(r["x"]) for r in background_rows(data, background, seed + 7).select(vector.alias("x")).collect()]
    if not pool:
        return data.sparkSession.createDataFrame([], "customer_id string, feature string, phi double, gap double")
    pool_array = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in pool])
    draws = data.select("customer_id", vector.alias("x"), F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"))
    draw_id = F.concat_ws("/", "customer_id", F.col("round").cast("string"))
    # The order of the features is that of the hashes of (draw, feature).
    ranked = F.array_sort(F.array(*[F.struct(F.xxhash64(draw_id, F.lit(i), F.lit(seed)).alias("h"), F.lit(i).alias("i")) for i in range(size)]))
    draws = draws.select("customer_id", "round", "x",
                         F.get(pool_array, (stable_hash(draw_id, seed) % len(pool)).cast("int")).alias("z"),
                         F.transform(ranked, lambda p: p["i"]).alias("order"))
    # Mixed rows come back as vectors, which models read as they are.
    kinds = T.StructType([data.schema["customer_id"], *[T.StructField(c, T.IntegerType()) for c in ("round", "own", "after")],
                          T.StructField("x", VectorUDT())])
    predicted = _predicted(model, draws.mapInArrow(_walks(size), kinds), inputs)
    # A prediction ends the contribution of its own step's feature and begins that of the next: no join.
    # The ends of a walk are its last prediction and, taken off, its first.  Features that change no row contribute 0.
    begins, ends = F.col("own") < 0, F.col("after") < 0
    own = F.struct(F.col("own").alias("j"), F.col("p").alias("part"), F.when(ends, F.col("p")).otherwise(0.0).alias("end"))
    after = F.struct(F.col("after").alias("j"), (-F.col("p")).alias("part"), F.when(begins, -F.col("p")).otherwise(0.0).alias("end"))
    every = F.array(*[F.struct(F.lit(i).alias("j"), F.lit(0.0).alias("part"), F.lit(0.0).alias("end")) for i in range(size)])
    parts = F.when(begins & (F.col("round") == 1), F.concat(F.array(own, after), every)).otherwise(F.array(own, after))
    halves = predicted.select("customer_id", F.explode(parts).alias("half")).select("customer_id", "half.*").where("j >= 0")
    # The whole walk of a row is the sum of its contributions: one aggregation, one prediction a mixed row.
    summed = halves.groupBy("customer_id", "j").agg((F.sum("part") / rounds).alias("phi"), (F.sum("end") / rounds).alias("end"))
    names = F.array(*[F.lit(c) for c in inputs])
    whole = F.sum("end").over(Window.partitionBy("customer_id"))
    return summed.select("customer_id", F.get(names, F.col("j")).alias("feature"), "phi", whole.alias("gap"))


def background_rows(data: DataFrame, n: int, seed: int, key: str = "customer_id") -> DataFrame:
    """:func:`sample_rows`, whose keys are put in order alone: only rows that bear one of the first ``n`` are read as a whole."""
    first = F.broadcast(sample_rows(data.select(key), n, key, seed).select(F.col(key).alias("__first")))
    return sample_rows(data.join(first, F.col(key).eqNullSafe(F.col("__first")), "left_semi"), n, key, seed)


def _walks(size: int) -> Callable:
    """A task that turns draws (customer_id, round, x, z, order) into the mixed rows of their walks.

    A step whose feature has the same value in both rows changes nothing, so it makes no row: each row bears the feature
    that it turned (``own``, -1 at the start) and the one that the next row turns (``after``, -1 at the end).
    """
    def walks(batches):
        for batch in batches:
            x, z, order = (np.asarray(batch.column(c).flatten()).reshape(-1, size) for c in ("x", "z", "order"))
            for i in range(0, len(x), 256):
                goal, start, turns = x[i:i + 256], z[i:i + 256], order[i:i + 256].astype(int)
                place = np.argsort(turns, axis=1)
                turned = np.ones((len(goal), size + 1), dtype=bool)
                turned[:, 1:] = np.take_along_axis(goal != start, turns, 1)
                row, step = np.nonzero(turned)
                own = np.where(step > 0, turns[row, step - 1], -1).astype(np.int32)
                after = np.full(len(row), -1, dtype=np.int32)
                after[:-1] = np.where(row[1:] == row[:-1], own[1:], -1)
                mixed = np.where(place[row] < step[:, None], goal[row], start[row])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * size), pa.array(mixed.ravel()))
                # The parts of a dense vector: type 1, no size and no places.
                vectors = pa.StructArray.from_arrays(
                    [pa.array(np.ones(len(row), dtype=np.int8)), pa.nulls(len(row), pa.int32()), pa.nulls(len(row), pa.list_(pa.int32())), lists],
                    ["type", "size", "indices", "values"])
                at = pa.array(i + row)
                yield pa.RecordBatch.from_arrays([batch.column("customer_id").take(at), batch.column("round").take(at), pa.array(own), pa.array(after), vectors],
                                                 ["customer_id", "round", "own", "after", "x"])
    return walks


def _predicted(model: PipelineModel, rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``rows`` with the probability ``p`` of the inputs in the vector ``x``; a model that assembles them takes the vector as it is."""
    first = model.stages[0]
    if isinstance(first, VectorAssembler) and list(first.getInputCols()) == list(inputs):
        scored = PipelineModel(model.stages[1:]).transform(rows.withColumnRenamed("x", first.getOutputCol()))
    else:
        values = rows.withColumn("x", vector_to_array("x"))
        scored = model.transform(values.select("*", *[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(inputs)]))
    return scored.select(*[c for c in rows.columns if c != "x"], probability().alias("p"))


def sampled_shapley(model: PipelineModel, data: DataFrame, inputs: Sequence[str], rounds: int = 4,
                    background: int = 32, k: int = 20, seed: int = SEED) -> DataFrame:
    """Mean absolute :func:`shapley_values` per feature over all rows, the ``k`` largest first."""
    return (shapley_values(model, data, inputs, rounds, background, seed).groupBy("feature")
            .agg(half_even(F.avg(F.abs("phi")), 6).alias("mean_abs_shap"))
            .orderBy(F.desc("mean_abs_shap"), "feature").limit(k))


def explain(name: str, model: PipelineModel, data: DataFrame, inputs: Sequence[str], k: int = 20) -> DataFrame:
    """Mean absolute contributions on the test rows, exact for the linear model and for trees.

    A model that predicts no probability falls back to its own importances.
    """
    test = data.where(F.col("split") == "test")
    if name == LOGISTIC:
        return linear_model_shapley(model, test, inputs, k)
    if not model.stages[-1].hasParam("probabilityCol"):
        native = feature_importance(model, inputs, data.sparkSession, k)
        return native.withColumnRenamed("importance", "mean_abs_shap")
    paths = tree_shapley.model_paths(model, data.sparkSession)
    return tree_shapley.mean_contributions(tree_shapley.tree_contributions(paths, test, inputs), inputs, k)


# The walks travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
