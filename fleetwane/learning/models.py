"""Tree regressors on Spark ML.

Each ``train_*`` builder maps the search parameters of a model family to something that fits.
Spark grows the trees; what its estimators lack is done with the node tables of its trees
(``learning/nodes.py``): a minimum number of rows to split a node, columns sampled per boosted
tree, and leaf-wise growth. All models are Spark's own, stored and loaded as such.
"""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwane.learning import nodes
from fleetwane.learning import runs as R
from fleetwane.operators.columns import align_columns, fill_missing_features
from fleetwane.operators.metrics import regression_metrics
from fleetwane.schema import RUL
from fleetwane.session import scratch_dir
from fleetwane.sources.writers import read_feature_columns, write_feature_columns, write_importances

# Memory per task for split statistics: more nodes are grown per pass over the data.
SPLIT_MEMORY_MB = 1024

# The deepest tree Spark grows; stands in for an unlimited depth.
MAX_DEPTH = 30

# Levels that a tree is grown further if leaf-wise growth might go deeper.
DEEPER = 3

# Boosting rounds between checkpoints.
CHECKPOINT_ROUNDS = 10

FOREST, BOOSTED, LEAFWISE = "forest", "boosted", "boosted_leafwise"


def train_forest(params: Mapping) -> Forest:
    """n_estimators, max_depth (None: as deep as Spark grows), min_samples_split, min_samples_leaf, max_features, bootstrap, random_state."""
    estimator = RandomForestRegressor(
        labelCol=RUL,
        maxMemoryInMB=SPLIT_MEMORY_MB,
        numTrees=params.get("n_estimators", 100),
        maxDepth=params.get("max_depth") or MAX_DEPTH,
        minInstancesPerNode=params.get("min_samples_leaf", 1),
        featureSubsetStrategy=params.get("max_features") or "all",
        bootstrap=params.get("bootstrap", True),
        seed=params.get("random_state", 42),
    )
    return Forest(estimator, params.get("min_samples_split", 2))


@dataclass(frozen=True)
class Forest:
    """Fits a forest; splits of nodes with too few rows are cut off its trees."""

    estimator: RandomForestRegressor
    min_samples_split: int = 2

    def fit(self, train: DataFrame) -> RandomForestRegressionModel:
        model = self.estimator.fit(train)
        if self.min_samples_split <= 2:  # every split has two rows
            return model
        return nodes.rebuilt(model, nodes.require_rows_to_split(nodes.node_table(model), self.min_samples_split))


def columns_of_round(features: int, share: float, seed: int, number: int) -> list[int]:
    """The columns that boosted tree ``number`` may use: a seeded draw of ``share`` of them, one at least."""
    wanted = min(features, max(1, round(share * features)))
    return sorted(random.Random(f"{seed}:{number}").sample(range(features), wanted))


@dataclass(frozen=True)
class Boosting:
    """Boosting on squared errors: the mean, then trees on what is left, each on columns of its own.

    A round fits one Spark tree to the residuals (the label less a stored prediction). With
    ``leaves`` the tree is grown by level until it decides which splits leaf-wise growth
    makes, and only those are kept. The prediction is a column; every few rounds the table is
    checkpointed, so that neither plan nor lineage grow with the rounds.
    """

    rounds: int
    depth: int
    rate: float
    subsample: float = 1.0
    columns: float = 1.0
    leaves: int | None = None
    min_rows: int = 1
    seed: int = 42

    def fit(self, train: DataFrame) -> GBTRegressionModel:
        width = train.schema["features"].metadata["ml_attr"]["num_attrs"]
        mean, n = train.agg(F.avg(RUL), F.count(RUL)).first()
        table = train.select("features", vector_to_array("features").alias("cells"), RUL, F.lit(mean).alias("fitted"))
        trees, depth = [nodes.leaf_tree(mean, n)], self.depth
        for number in range(self.rounds):
            if number and number % CHECKPOINT_ROUNDS == 0:
                table = table.checkpoint()
            tree, depth = self._tree(table, number, width, depth)
            trees.append(tree)
            step = F.expr(nodes.as_expression(tree, "cells")) * self.rate
            table = table.withColumn("fitted", F.col("fitted") + step)
        template = GBTRegressor(labelCol=RUL, maxIter=max(1, len(trees)), maxDepth=depth, stepSize=self.rate, subsamplingRate=self.subsample, seed=self.seed)
        return nodes.as_boosted(trees, [1.0, *[self.rate] * self.rounds], template, width)

    def _tree(self, table: DataFrame, number: int, width: int, depth: int) -> tuple[list[nodes.Node], int]:
        """The tree of a round, its features numbered as in the whole vector, and the depth it was grown to."""
        columns = columns_of_round(width, self.columns, self.seed, number)
        left = table.withColumn("residual", F.col(RUL) - F.col("fitted"))
        if len(columns) < width:
            left = VectorSlicer(inputCol="features", outputCol="slice", indices=columns).transform(left)
        while True:
            grower = RandomForestRegressor(
                labelCol="residual",
                featuresCol="slice" if len(columns) < width else "features",
                numTrees=1,
                bootstrap=False,
                subsamplingRate=self.subsample,
                featureSubsetStrategy="all",
                maxDepth=depth,
                minInstancesPerNode=self.min_rows,
                maxMemoryInMB=SPLIT_MEMORY_MB,
                seed=self.seed + number,
            )
            tree = nodes.tree_rows(nodes.node_table(grower.fit(left)))
            if self.leaves is None or depth >= MAX_DEPTH or nodes.deep_enough(tree, self.leaves, depth, self.min_rows):
                break
            depth = min(MAX_DEPTH, depth + DEEPER)
        if self.leaves is not None:
            tree = nodes.with_splits(tree, nodes.best_first(tree, self.leaves))
        return [replace(node, feature=columns[node.feature]) if node.left >= 0 else node for node in tree], depth


def train_boosted(params: Mapping) -> Boosting:
    """n_estimators, max_depth, learning_rate, subsample, colsample_bytree (of the columns, per tree), random_state."""
    return Boosting(
        rounds=params.get("n_estimators", 100),
        depth=params.get("max_depth", 6),
        rate=params.get("learning_rate", 0.3),
        subsample=params.get("subsample", 1.0),
        columns=params.get("colsample_bytree", 1.0),
        seed=params.get("random_state", 42),
    )


def train_boosted_leafwise(params: Mapping) -> Boosting:
    """n_estimators, num_leaves, learning_rate, min_child_samples, random_state; the best leaf is split next."""
    leaves = params.get("num_leaves", 31)
    return Boosting(
        rounds=params.get("n_estimators", 100),
        depth=min(MAX_DEPTH, math.ceil(math.log2(leaves)) + 1),
        rate=params.get("learning_rate", 0.1),
        leaves=leaves,
        min_rows=params.get("min_child_samples", 20),
        seed=params.get("random_state", 42),
    )


ESTIMATORS = {FOREST: train_forest, BOOSTED: train_boosted, LEAFWISE: train_boosted_leafwise}


def preparation(features: Sequence[str]) -> Pipeline:
    """Median imputation (learnt from the training side) and vector assembly."""
    filled = [f"{c}__filled" for c in features]
    return Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=list(features), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="features"),
        ]
    )


def prepare_model_input(df: DataFrame, features: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """The features in training order as doubles, undefined rolling features as zero."""
    aligned = fill_missing_features(align_columns(df, features, keep=keep), features)
    return aligned.select(*keep, *(F.col(c).cast("double").alias(c) for c in features))


def feature_importances(model: PipelineModel, *, splits: bool = False) -> DataFrame:
    """(feature, importance), largest first: share of the gain, or number of splits.

    A fitted model has one entry per feature, so this is a small table.
    """
    assembler, trees = model.stages[-2], model.stages[-1]
    names = [c.removesuffix("__filled") for c in assembler.getInputCols()]
    spark = SparkSession.active()
    if not splits:
        rows = list(zip(names, (float(x) for x in trees.featureImportances.toArray())))
        return sort_importances(spark.createDataFrame(rows, "feature string, importance double"))
    splits_of = nodes.node_table(trees).filter("left >= 0").groupBy("feature").count()
    counts = {r[0]: r[1] for r in splits_of.collect()}  # one row per feature
    rows = [(name, float(counts.get(i, 0))) for i, name in enumerate(names)]
    return sort_importances(spark.createDataFrame(rows, "feature string, importance double"))


def sort_importances(importances: DataFrame) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature")


@dataclass(frozen=True)
class TrainedRun:
    """What one training run leaves behind."""

    family: str
    params: dict
    features: list[str]
    model: PipelineModel
    metrics: dict[str, float]
    example: DataFrame | None = None
    run_id: str = field(default_factory=R.new_run_id)
    started: float = field(default_factory=time.time)

    @property
    def importances(self) -> DataFrame:
        return feature_importances(self.model, splits=self.family == LEAFWISE)


def train_and_evaluate(
    family: str, params: Mapping, train: DataFrame, test: DataFrame, features: Sequence[str]
) -> TrainedRun:
    """Fit on ``train``, predict ``test``, compute the metrics."""
    with model_inputs(train, test, features) as inputs:
        return fit_and_measure(family, params, inputs)


@dataclass(frozen=True)
class ModelInputs:
    """Both sides as vectors, the fitted preparation, and a few rows as an example."""

    features: list[str]
    prepared: PipelineModel
    train: DataFrame
    test: DataFrame
    example: DataFrame


@contextmanager
def model_inputs(train: DataFrame, test: DataFrame, features: Sequence[str]):
    """Both sides as model inputs, prepared once and kept for the passes of training.

    A fit reads its input many times (split candidates, trees), and a search fits many
    models; imputer and assembler are fitted and applied once for all of them. Give both
    sides as filters of one stored table, else the features are computed for each.
    """
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:  # boosting cuts its lineage there every few rounds
        context.setCheckpointDir(scratch_dir(train.sparkSession))
    sides = [prepare_model_input(t, features, keep=[RUL]) for t in (train, test)]
    prepared = preparation(features).fit(sides[0])
    # partitions by bytes: every round of boosting runs a task for each
    tables = [prepared.transform(side).select(*features, RUL, "features").hint("rebalance").persist() for side in sides]
    example = local_copy(sides[1].select(*features), 5)
    try:
        yield ModelInputs(list(features), prepared, *tables, example)
    finally:
        for table in tables:
            table.unpersist()


def local_copy(df: DataFrame, rows: int) -> DataFrame:
    """The first few rows, taken now."""
    return df.sparkSession.createDataFrame(df.limit(rows).collect(), df.schema)


def fit_and_measure(family: str, params: Mapping, inputs: ModelInputs) -> TrainedRun:
    """Train and measure on prepared model inputs."""
    started = time.time()
    trees = ESTIMATORS[family](params).fit(inputs.train)
    metrics = regression_metrics(trees.transform(inputs.test)).first().asDict()
    model = PipelineModel([*inputs.prepared.stages, trees])
    return TrainedRun(family, dict(params), inputs.features, model, metrics, inputs.example, started=started)


def save_run(spark: SparkSession, run: TrainedRun, folder: str, *, experiment: str) -> str:
    """Store the model with its feature list, signature, importances and a small input example, and log the run.

    Layout: ``folder/models/<run_id>/{model,features,signature,importances,example}`` and ``folder/runs``.
    """
    base = f"{folder}/models/{run.run_id}"
    run.model.write().overwrite().save(f"{base}/model")
    write_feature_columns(spark, run.features, f"{base}/features")
    signature = {"inputs": {name: "double" for name in run.features}, "outputs": {"prediction": "double"}}
    spark.createDataFrame([(json.dumps(signature),)], "signature string").coalesce(1).write.mode("overwrite").text(f"{base}/signature")
    write_importances(run.importances, f"{base}/importances")
    if run.example is not None:
        run.example.coalesce(1).write.mode("overwrite").parquet(f"{base}/example")
    return R.append_run(
        spark,
        f"{folder}/runs",
        experiment=experiment,
        params=run.params,
        metrics=run.metrics,
        tags={"model_type": run.family},
        run_id=run.run_id,
        start_time=run.started,
    )


def load_model(spark: SparkSession, folder: str, run_id: str) -> tuple[PipelineModel, list[str]]:
    """The model of a run and its feature names in training order."""
    base = f"{folder}/models/{run_id}"
    return PipelineModel.load(f"{base}/model"), read_feature_columns(spark, f"{base}/features")


def load_signature(spark: SparkSession, folder: str, run_id: str) -> dict[str, dict[str, str]]:
    """The inputs and outputs of a stored model: name -> type."""
    return json.loads(spark.read.text(f"{folder}/models/{run_id}/signature").first()[0])


def check_signature(df: DataFrame, signature: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``df`` if the inputs that it has are numbers, as the stored model takes them; missing ones are filled in later."""
    wrong = {c: t for c, t in df.dtypes if c in signature["inputs"] and not _is_number(t)}
    if wrong:
        raise TypeError(f"the model takes numbers, not {wrong}")
    return df


def _is_number(kind: str) -> bool:
    return kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
