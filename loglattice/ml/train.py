"""Training, selection, explanation and storage of Spark ML models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark import SparkContext
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from loglattice import constants as C


def logistic_regression(label: str = "is_anomaly", weight: str | None = None) -> LogisticRegression:
    lr = LogisticRegression(labelCol=label, maxIter=100, regParam=0.01, elasticNetParam=0.0)
    return lr.setWeightCol(weight) if weight else lr


def decision_tree(label: str = "is_anomaly", depth: int = 10, weight: str | None = None) -> DecisionTreeClassifier:
    dt = DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=C.SEED)
    return dt.setWeightCol(weight) if weight else dt


def random_forest(
    label: str = "is_anomaly", trees: int = 100, depth: int = 12, weight: str | None = None
) -> RandomForestClassifier:
    rf = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=C.SEED)
    return rf.setWeightCol(weight) if weight else rf


CLASSIFIERS = {
    "logistic_regression": logistic_regression,
    "decision_tree": decision_tree,
    "random_forest": random_forest,
}


def train(df: DataFrame, stages: list, classifier) -> PipelineModel:
    """Fit the feature stages and a classifier as one pipeline, so that it scores raw rows."""
    return Pipeline(stages=[*stages, classifier]).fit(df)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Add predictions to a batch or a stream, with the probability of class 1 as ``score``."""
    scored = model.transform(df)
    return scored.withColumn("score", vector_to_array("probability")[1])


def parameter_grid(name: str, classifier) -> list:
    """The grids searched by default: 6, 9 and 4 combinations."""
    grid = ParamGridBuilder()
    for parameter, values in C.SEARCH_GRIDS[name].items():
        grid = grid.addGrid(classifier.getParam(parameter), values)
    return grid.build()


def bounded(rows: DataFrame, small: int = C.SEARCH_ROWS, by: str = "event_id") -> DataFrame:
    """All rows of a search, in a bounded number of partitions; it is the same for all searches of up to ``small`` rows.

    They come sorted by id in partitions whose number depends on the number of rows only: a search runs thousands of
    small jobs, which must neither get a task for each split of the input nor meet the rows in another order on another
    split.
    """
    tasks = max(-(-small // C.SEARCH_SMALL_ROWS_PER_TASK), min(C.SEARCH_TASKS, -(-rows.count() // C.SEARCH_ROWS_PER_TASK)))
    return rows.repartition(tasks, by).sortWithinPartitions(by)


class Apart:
    """The models of a grid, each fitted and judged under local properties of its own.

    Spark hands all threads of a parallel search one Properties object, so that the end of a query in one thread removes
    the query id that another thread is about to read, and the search fails ("Cannot parse null string").
    """

    def __init__(self, models: Iterator, context: SparkContext):
        self.models, self.context = models, context

    def __iter__(self) -> Apart:
        return self

    def __next__(self) -> tuple[int, Model]:
        scala = self.context._jsc.sc()
        scala.setLocalProperties(scala.getLocalProperties().clone())
        return next(self.models)


def select_model(
    name: str,
    train_features: DataFrame,
    label: str = "label",
    weight: str | None = "class_weight",
    grid: list | None = None,
    folds: int = 3,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated search on weighted F1 over assembled features, by the folds in column ``fold`` if it is there."""
    classifier = CLASSIFIERS[name](label=label, weight=weight)
    fits, context = classifier.fitMultiple, train_features.sparkSession.sparkContext
    classifier.fitMultiple = lambda rows, points: Apart(fits(rows, points), context)
    search = CrossValidator(
        estimator=classifier,
        estimatorParamMaps=parameter_grid(name, classifier) if grid is None else grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="f1"),
        numFolds=folds,
        parallelism=parallelism,
        seed=C.SEED,
        foldCol="fold" if "fold" in train_features.columns else "",
    )
    return search.fit(train_features)


def assemble_best(
    features: PipelineModel, candidates: dict[str, Model], test_features: DataFrame, label: str = "label"
) -> tuple[str, float, PipelineModel]:
    """The candidate with the best F1 on held-out rows, behind its feature stages. All are judged from one read."""
    judged = test_features
    for name, model in candidates.items():
        judged = model.transform(judged).select(*judged.columns, F.col("prediction").alias(f"_{name}"))
    guesses = [f"_{name}" for name in candidates]
    cells = judged.groupBy(label, *guesses).count()
    counted = cells.sparkSession.createDataFrame(cells.collect(), cells.schema)  # at most one row per class and guess
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="f1", weightCol="count")
    scores = {name: judge.evaluate(counted, {judge.predictionCol: f"_{name}"}) for name in candidates}
    best = max(scores, key=scores.get)
    winner = candidates[best]
    winner = winner.bestModel if isinstance(winner, CrossValidatorModel) else winner
    return best, scores[best], PipelineModel(stages=[*features.stages, winner])


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Name of every slot of an assembled vector, from its metadata."""
    groups: dict[str, Sequence[dict]] = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = {attr["idx"]: attr["name"] for group in groups.values() for attr in group}
    return [slots[i] for i in sorted(slots)]


def feature_importance(model: Model, features: DataFrame, n: int = 20) -> DataFrame:
    """The n most important features of a tree model, by name. ``features`` is the assembled frame."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    pairs = list(zip(feature_names(features), [float(v) for v in tree.featureImportances.toArray()]))
    table = features.sparkSession.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)


def root_split(model: Model, features: DataFrame) -> tuple[str, float, float]:
    """Feature, threshold and gain of a decision tree's first split on a number."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    root = tree._java_obj.rootNode()
    return feature_names(features)[root.split().featureIndex()], root.split().threshold(), root.gain()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
