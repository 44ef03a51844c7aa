"""Model training, comparison and scoring.

Ridge is solved from mergeable statistics, the forest's trees grow in parallel tasks, the boosted trees are histogram trees;
every fitted model is a Spark ML stage, so one ``PipelineModel`` saves, loads and scores it.  The assembled
vectors are written once, so the hundreds of passes of a fit read them instead of recomputing them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, Window as W, functions as F

from .. import schemas as S
from ..operators import ridge as R
from ..operators.boosting import BoostedTrees
from ..operators.forest import Forest
from ..operators.median import exact_medians
from ..operators.split import time_split
from ..operators.summarize import regression_metrics
from ..session import checkpoint, scratch_path
from ..sources.store import registry_append, registry_latest

RIDGE, FOREST, BOOSTED = "Ridge Regression", "Random Forest", "Boosted Trees"

# Reference hyper-parameters (library defaults).
FOREST_PARAMS = dict(numTrees=300, maxDepth=14, minInstancesPerNode=3, featureSubsetStrategy="0.85", seed=42)
FOREST_MIN_SPLIT = 8
BOOSTED_PARAMS = dict(rounds=300, learning_rate=0.05, depth=4, min_child=3.0, rows=0.85, columns=0.85, l1=0.1, l2=2.0,
                      seed=42)
RIDGE_ALPHA = 1.0
#: Rows on which a tree of the forest grows within one task.
ROWS_OF_A_TREE = 2_000_000
FILLED, ARRAY, SIDE = "_filled_", "_x", "_side"


def preprocessing(train: DataFrame, features=None) -> list:
    """Stages saved with every model: missing features take the exact training medians, then one array and vector.

    Scaling needs no stage: the ridge solves on standardised features, the trees do not need it.  A
    feature without any training value becomes 0.
    """
    feats = list(features or S.MODEL_FEATURE_COLUMNS)
    medians = exact_medians(train, feats)
    filled = ", ".join(f"coalesce(nullif(cast(`{c}` AS double), double('NaN')), {float(medians[c] or 0.0)!r}D) "
                       f"AS `{FILLED}{c}`" for c in feats)
    array = ", ".join(f"`{FILLED}{c}`" for c in feats)
    return [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
            SQLTransformer(statement=f"SELECT *, array({array}) AS {ARRAY} FROM __THIS__"),
            VectorAssembler(inputCols=[FILLED + c for c in feats], outputCol="features")]


def without_inner(df: DataFrame) -> DataFrame:
    """Predictions without the preprocessing's own columns."""
    return df.drop("features", ARRAY, *[c for c in df.columns if c.startswith(FILLED)])


@dataclass
class Learner:
    """Preprocessing stages and how the last stage is fitted on what ``assembled`` wrote.

    ``fit_last`` gives (Spark ML stage, feature importances); ``kept`` holds what learners of the same vectors share.
    """

    name: str
    stages: list
    params: dict = field(default_factory=dict)
    features: list = field(default_factory=lambda: list(S.MODEL_FEATURE_COLUMNS))
    label: str = S.TARGET_COLUMN

    def fit_last(self, vectors: DataFrame, kept: dict | None = None) -> tuple:
        if self.name == RIDGE:
            rows = vectors.select(self.label, "city", "timestamp", *[F.col(ARRAY)[i].alias(c) for i, c in enumerate(self.features)])
            model = R.solve(R.statistics(rows, self.features, self.label), self.features, self.label, **self.params)
            return model.stage(), model.importances
        if self.name == BOOSTED:
            model = BoostedTrees(**self.params, label=self.label, array=ARRAY).fit(vectors, kept)
            return model.stage(), model.importances
        model = fit_forest(vectors, self.label, kept=kept, **self.params)
        return model, [float(v) for v in model.featureImportances.toArray()]

    def fit(self, df: DataFrame) -> PipelineModel:
        return fit_assembled(self, assembled(self, df))


def fit_forest(vectors: DataFrame, label: str, min_split: int = FOREST_MIN_SPLIT, kept: dict | None = None,
               **params) -> RandomForestRegressionModel:
    """A forest of these Spark ML parameters in which nodes of fewer than ``min_split`` rows are not split.

    Up to ``ROWS_OF_A_TREE`` rows each tree grows within a task; of more rows Spark ML aggregates every level.
    """
    learner = RandomForestRegressor(featuresCol="features", labelCol=label, **params)
    known = {"numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy", "seed"}
    if not (known >= set(params) and re.fullmatch(r"0?\.\d+|1\.0", learner.getFeatureSubsetStrategy())
            and vectors.count() <= ROWS_OF_A_TREE):
        return prune_small(learner.fit(vectors), min_split)
    own = Forest(learner.getNumTrees(), learner.getMaxDepth(), learner.getMinInstancesPerNode(), min_split,
                 float(learner.getFeatureSubsetStrategy()), learner.getSeed(), label=label, array=ARRAY)
    return with_nodes(learner.fit(vectors.limit(1)), own.grow(vectors, kept))


def with_nodes(model: RandomForestRegressionModel, nodes: DataFrame) -> RandomForestRegressionModel:
    """A forest of the same parameters and number of trees with other nodes (treeID, nodeData)."""
    spark = nodes.sparkSession
    source, target = scratch_path(spark, "forest"), scratch_path(spark, "forest-nodes")
    model.write().save(source)
    nodes.write.parquet(f"{target}/data")
    spark.read.text(f"{source}/metadata").write.text(f"{target}/metadata")
    spark.read.parquet(f"{source}/treesMetadata").write.parquet(f"{target}/treesMetadata")
    return RandomForestRegressionModel.load(target)


def prune_small(model: RandomForestRegressionModel, least: int) -> RandomForestRegressionModel:
    """The forest as if nodes of fewer than ``least`` rows had not been split.

    Trees grow from the top, so not splitting a node changes nothing but what hangs below it; counts fall
    on the way down, so a node goes if its parent is too small.  Works on the saved table of nodes, whose
    ids number each tree from the root, left subtree first.
    """
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    source, target = scratch_path(spark, "forest"), scratch_path(spark, "forest-pruned")
    model.write().save(source)
    nodes = spark.read.parquet(f"{source}/data")
    small = nodes.where((F.col("nodeData.leftChild") >= 0) & (F.col("nodeData.rawCount") < least))
    gone = small.select("treeID", F.explode(F.array("nodeData.leftChild", "nodeData.rightChild")).alias("id"))
    kept = (nodes.join(gone, (nodes["treeID"] == gone["treeID"]) & (nodes["nodeData.id"] == gone["id"]), "left_anti")
            .withColumn("new", (F.row_number().over(W.partitionBy("treeID").orderBy("nodeData.id")) - 1).cast("int")))
    right = kept.select(F.col("treeID").alias("_tree"), F.col("nodeData.id").alias("_id"), F.col("new").alias("_right"))
    old = F.col("nodeData")
    leaf = (old["leftChild"] < 0) | (old["rawCount"] < least)
    no_split = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                        F.lit(-1).alias("numCategories"))
    node = F.struct(
        F.col("new").alias("id"), old["prediction"].alias("prediction"), F.when(leaf, -1.0).otherwise(old["impurity"]).alias("impurity"),
        old["impurityStats"].alias("impurityStats"), old["rawCount"].alias("rawCount"), F.when(leaf, -1.0).otherwise(old["gain"]).alias("gain"),
        F.when(leaf, -1).otherwise(F.col("new") + 1).alias("leftChild"), F.when(leaf, -1).otherwise(F.col("_right")).alias("rightChild"),
        F.when(leaf, no_split).otherwise(old["split"]).alias("split"))
    (kept.join(right, (F.col("treeID") == F.col("_tree")) & (old["rightChild"] == F.col("_id")), "left")
     .select("treeID", node.alias("nodeData")).write.parquet(f"{target}/data"))
    spark.read.text(f"{source}/metadata").write.text(f"{target}/metadata")
    spark.read.parquet(f"{source}/treesMetadata").write.parquet(f"{target}/treesMetadata")
    return RandomForestRegressionModel.load(target)


def estimators(train: DataFrame, features=None, label: str = S.TARGET_COLUMN, forest=None, boosted=None,
               alpha: float = RIDGE_ALPHA, only=(RIDGE, FOREST, BOOSTED)) -> dict:
    """The learners asked for; they share their preprocessing."""
    feats = list(features or S.MODEL_FEATURE_COLUMNS)
    params = {RIDGE: dict(alpha=alpha), FOREST: {**FOREST_PARAMS, **(forest or {})}, BOOSTED: {**BOOSTED_PARAMS, **(boosted or {})}}
    stages = preprocessing(train, feats)
    return {name: Learner(name, stages, params[name], feats, label) for name in only}


def assembled(est: Learner, df: DataFrame) -> DataFrame:
    """Label, key, array and vector that the last stage fits on, written once."""
    return checkpoint(PipelineModel(est.stages).transform(df).select(est.label, "city", "timestamp", ARRAY, "features"), "assembled")


def fit_assembled(est: Learner, vectors: DataFrame, kept: dict | None = None) -> PipelineModel:
    """The pipeline fitted on vectors that ``assembled`` wrote; its stages before the last learn nothing."""
    last, importances = est.fit_last(vectors, kept)
    model = PipelineModel([*est.stages, last])
    model.importances = importances
    return model


def side_metrics(model, sides: DataFrame, label: str = S.TARGET_COLUMN) -> dict:
    """{side: its errors}, of the rows of every ``SIDE`` in one pass.

    Predictions are written first: the metrics' filter would be pushed below them with a copy of every tree.
    """
    predicted = checkpoint(model.transform(sides).select(SIDE, label, "prediction"), "predicted")
    found = regression_metrics(predicted, label, "prediction", group=[SIDE], digits=None).collect()
    return {m[SIDE]: {"MAE": m["mae"], "RMSE": m["rmse"], "R2": m["r2"]} for m in found}


def compare(train: DataFrame, test: DataFrame, ests: dict, label: str = S.TARGET_COLUMN):
    """Fit each learner on train; metrics on both sides; the best by (test RMSE, test MAE).

    The learners share their stages before the last (see ``estimators``).
    """
    spark = train.sparkSession
    shared = next(iter(ests.values()))
    train_vectors, test_vectors = assembled(shared, train), assembled(shared, test)
    # Vectors are small as files, so a few tasks would read them; hundreds of trees on a row are worth all cores.
    sides = (train_vectors.withColumn(SIDE, F.lit("train")).unionByName(test_vectors.withColumn(SIDE, F.lit("test")))
             .repartition(spark.sparkContext.defaultParallelism))
    fitted, rows, kept = {}, [], {}
    for name, est in ests.items():
        fitted[name] = model = fit_assembled(est, train_vectors, kept)
        found = side_metrics(model.stages[-1], sides, label)
        tr, te = found["train"], found["test"]
        rows.append((name, tr["MAE"], tr["RMSE"], tr["R2"], te["MAE"], te["RMSE"], te["R2"]))
    # Arrow rows stay a local table, which the caller reads without a job.
    names = ["model_name", *[f"{side}_{m}" for side in ("train", "test") for m in ("MAE", "RMSE", "R2")]]
    metrics = spark.createDataFrame(pa.table([pa.array(c, pa.float64() if i else pa.string()) for i, c in enumerate(zip(*rows))], names))
    best = sorted(rows, key=lambda r: (r[5], r[4]))[0][0]
    return metrics, fitted, best


def feature_importance(registered: DataFrame) -> DataFrame:
    """(feature, importance, model_name) of one registry row, highest first.

    Stored at training: tree importances as shares of the gain; for ridge |coef| on standardised features.
    """
    pairs = F.arrays_zip(F.col("feature_columns").alias("feature"), F.col("feature_importance").alias("importance"))
    return (registered.select("best_model_name", F.inline(pairs))
            .select("feature", "importance", F.col("best_model_name").alias("model_name")).orderBy(F.col("importance").desc()))


def score(model: PipelineModel, rows: DataFrame, digits: int = 1) -> DataFrame:
    """Batch (or streaming) prediction, clipped to 0..500 and rounded."""
    from ..operators.forecast import predict_api
    pred = model.transform(rows)
    return predict_api(without_inner(pred), F.col("prediction")).drop("prediction")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def train_and_register(table: DataFrame, registry_path: str, name: str, features=None, forest=None, boosted=None,
                       label: str = S.TARGET_COLUMN):
    """Training job: compare on the time split, refit the winner on all rows, save and register it.

    The registered metrics are the winner's on the held-out test part.  Returns (winner, fitted model,
    the registry as read back).
    """
    spark = table.sparkSession
    feats = list(features or S.MODEL_FEATURE_COLUMNS)
    parts = time_split(table)
    train, test = (parts.filter(F.col("split") == p).drop("split") for p in ("train", "test"))
    metrics, fitted, best = compare(train, test, estimators(train, feats, label, forest, boosted), label)
    del fitted  # the driver need not hold them while the winner is fitted anew
    held = metrics.filter(F.col("model_name") == best).first().asDict()
    model = estimators(table, feats, label, forest, boosted, only=(best,))[best].fit(table)
    return best, model, register_model(model, table, registry_path, name, best, feats, held)


def register_model(model: PipelineModel, table: DataFrame, registry_path: str, name: str, title: str, feats: list,
                   held: dict | None = None) -> DataFrame:
    """Save a fitted model and append its record; ``held`` has its metrics on held-out rows, if there are any."""
    spark, held = table.sparkSession, held or {}
    number = lambda key: F.lit(held.get(key)).cast("double")
    path = save_model(model, scratch_path(spark, "model"))
    record = table.agg(F.count(F.lit(1)).cast("bigint").alias("training_rows"),
                       F.min("timestamp").alias("training_start"), F.max("timestamp").alias("training_end")).select(
        F.lit(name).alias("name"), number("test_MAE").alias("mae"), number("test_RMSE").alias("rmse"),
        number("test_R2").alias("r2"), F.lit(len(feats)).cast("bigint").alias("feature_count"),
        F.lit(title).alias("best_model_name"), F.array(*[F.lit(c) for c in feats]).alias("feature_columns"),
        "training_rows", "training_start", "training_end", F.col("training_end").alias("created_at"),
        F.lit(path).alias("model_path"), F.array(*[F.lit(v) for v in model.importances]).alias("feature_importance"))
    return registry_append(spark, registry_path, record)


def table_digest(table: DataFrame) -> str:
    """Names a table by its rows, whatever their order: a model trained on it needs no second training."""
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)")).alias("a"),
                    F.sum(F.xxhash64(F.lit("again"), *table.columns).cast("decimal(38,0)")).alias("b")).first()
    return f"{row['n']}-{int(row['a'] or 0) & (1 << 64) - 1:016x}{int(row['b'] or 0) & (1 << 64) - 1:016x}"


def registered_model(table: DataFrame, registry_path: str, name: str, **params) -> DataFrame:
    """The newest registry row of the model trained on just this table; trains and registers it if there is none.

    Models are kept apart by the table's digest, so every caller with the same data shares one training and
    changed data are trained anew.
    """
    from ..session import path_exists
    from ..sources.store import read_registry
    spark, own = table.sparkSession, f"{name}-{table_digest(table)}"
    if path_exists(spark, registry_path):
        found = registry_latest(read_registry(spark, registry_path), own)
        if not found.isEmpty():
            return found
    _, _, registry = train_and_register(table, registry_path, own, **params)
    return registry_latest(registry, own)


def score_registered(registry: DataFrame, name: str, rows, digits: int = 1) -> DataFrame:
    """Load the newest registered model of a name and score ``rows(its stored features)`` with it."""
    latest = registry_latest(registry, name).first()
    if latest is None:
        raise ValueError(f"No registered model: {name}")
    return score_with(latest, rows, digits)


def score_with(latest, rows, digits: int = 1) -> DataFrame:
    return score(PipelineModel.load(latest["model_path"]), rows(list(latest["feature_columns"])), digits)
