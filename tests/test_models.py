import datetime as dt
import json

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from loglattice import constants as C
from loglattice.ml import metrics as M, prep, runs as R, train as T
from loglattice.registry import model_cases


@pytest.fixture(scope="module")
def rows(spark):
    """Rows with every model column; label 1 where the level is ERROR or the latency is high."""
    df = spark.range(1200).selectExpr(
        "cast(id as string) as event_id", "concat('svc', id % 5) as service", "concat('f', id % 2) as log_file",
        "case when id % 7 = 0 then 'ERROR' else 'INFO' end as log_level", "case when id % 3 = 0 then 'GET' else 'NO_HTTP' end as http_method",
        "case when id % 3 = 0 then 'Fast' else 'Not Measured' end as response_category",
        "cast(200 as int) as status_code", "cast((id * 37) % 100 / 100.0 as double) as response_time",
        "cast(id % 24 as int) as event_hour", "cast(id % 28 as int) as event_day", "1 as event_month",
        "cast(id % 7 as int) as event_weekday", "0 as is_weekend", "cast(id % 2 as int) as instance_exists")
    return df.withColumn("is_anomaly", ((F.col("log_level") == "ERROR") | (F.col("response_time") > 0.9)).cast("int"))


def predictions(spark):
    data = [(float(i % 3 == 0), float(i % 5 < 2), round((i % 7) / 7 + (i % 3 == 0) * 0.2, 3)) for i in range(200)]
    return spark.createDataFrame(data, "label double, prediction double, score double")


def test_metrics_equal_spark_evaluators(spark):
    df = predictions(spark)
    mine = M.evaluate(df).first()
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}.items():
        assert mine[name] == pytest.approx(judge.setMetricName(metric).evaluate(df), abs=1e-12), name
    curve = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert mine.roc_auc == pytest.approx(curve.evaluate(df), abs=1e-12)


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)], "label double, prediction double")
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    assert M.weighted_metrics(df).first().f1 == pytest.approx(judge.evaluate(df))


def test_auc_edges(spark):
    frame = lambda data: spark.createDataFrame(data, "label double, score double")
    assert M.roc_auc(frame([(1.0, 0.5), (0.0, 0.5)])).first()[0] == 0.5
    assert M.roc_auc(frame([(1.0, 0.9), (0.0, 0.1)])).first()[0] == 1.0
    assert M.roc_auc(frame([(1.0, 0.9)])).first()[0] is None


def test_split_is_stable_and_complete(rows):
    train, test = prep.split(rows)
    again = prep.split(rows.repartition(7))[0]
    ids = lambda df: {r.event_id for r in df.select("event_id").collect()}
    assert ids(train) == ids(again) and not ids(train) & ids(test) and len(ids(train) | ids(test)) == 1200
    assert 0.75 < len(ids(train)) / 1200 < 0.85
    assert sum(df.count() for df in prep.random_split(rows)) == 1200


def test_undersample_ratio(spark, rows):
    few = rows.where("is_anomaly = 0 or cast(event_id as int) % 4 = 0")
    kept = {r.is_anomaly: r["count"] for r in prep.class_counts(prep.undersample(few, ratio=2)).collect()}
    assert kept[1] == few.where("is_anomaly = 1").count()
    assert abs(kept[0] - 2 * kept[1]) < 0.3 * 2 * kept[1]
    normal = rows.where("is_anomaly = 0")
    assert prep.undersample(normal).count() == normal.count()


def test_class_weights_for_any_classes(spark):
    df = spark.createDataFrame([("x",)] * 6 + [("y",)] * 3 + [("z",)] + [(None,)], "label string")
    got = {r.label: r.class_weight for r in prep.class_weights(df).distinct().collect()}
    assert got == {"x": pytest.approx(10 / 18), "y": pytest.approx(10 / 9), "z": pytest.approx(10 / 3), None: None}
    assert "Exchange hashpartitioning(label" not in prep.class_weights(df)._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_label_ranks_equal_the_indexer(spark, rows):
    fitted = prep.label_indexer("service").fit(rows).transform(rows)
    indexed = {(r.service, r.label) for r in fitted.select("service", "label").distinct().collect()}
    assert indexed == {(r.service, r.label) for r in prep.label_ranks(rows, "service").collect()}
    unseen = spark.createDataFrame([("new",)], "service string")
    assert prep.label_indexer("service").fit(rows).transform(unseen).first().label == 5.0


def test_train_score_save_and_explain(spark, rows, tmp_path):
    model = T.train(rows, prep.anomaly_stages(), T.decision_tree(depth=4))
    scored = T.score(model, rows)
    assert M.evaluate(scored, label="is_anomaly").first().accuracy > 0.95
    top = T.feature_importance(model, scored, 3).collect()
    assert len(top) == 3 and {top[0].feature, top[1].feature} <= {"log_level_vec_ERROR", "log_level_vec_INFO", "response_time"}
    path = str(tmp_path / "model")
    T.save_model(model, path)
    T.save_model(model, path)
    raw = rows.drop("is_anomaly").limit(20)
    assert [r.prediction for r in T.load_model(path).transform(raw).collect()] == [r.prediction for r in model.transform(raw).collect()]
    assert len(T.feature_names(scored)) == scored.first().features.size


@pytest.mark.parametrize("name", list(T.CLASSIFIERS))
def test_classifiers_fit_with_weights(rows, name):
    stages = prep.feature_stages(["log_level"], ["response_time"])
    options = {"trees": 3, "depth": 3} if name == "random_forest" else {}
    classifier = T.CLASSIFIERS[name](label="is_anomaly", weight="class_weight", **options)
    model = T.train(prep.class_weights(rows, "is_anomaly"), stages, classifier)
    assert M.weighted_metrics(T.score(model, rows), "is_anomaly").first().accuracy > 0.7


def test_grids_and_best_model(rows):
    sizes = {n: len(T.parameter_grid(n, make())) for n, make in T.CLASSIFIERS.items()}
    assert sizes == {"logistic_regression": 6, "decision_tree": 9, "random_forest": 4}
    stages = prep.Pipeline(stages=prep.feature_stages(["log_level"], ["response_time"])).fit(rows)
    features = stages.transform(prep.class_weights(rows.withColumn("label", F.col("is_anomaly").cast("double"))))
    forest = T.random_forest("label", 3, 4).fit(features)
    stump = DecisionTreeClassifier(labelCol="label", maxDepth=0).fit(features)
    searched = T.select_model("decision_tree", features, grid=[{}], folds=2)
    name, f1, best = T.assemble_best(stages, {"stump": stump, "forest": forest}, features)
    assert name == "forest" and f1 > 0.8 and best.transform(rows).count() == 1200
    assert T.assemble_best(stages, {"searched": searched}, features)[2].stages[-1] == searched.bestModel


def test_search_rows_do_not_depend_on_the_splits_of_the_input(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("row_key"))
    for most in (1000, 5000):
        some, more = (T.bounded(rows.repartition(n), most, "row_key").rdd.glom().collect() for n in (1, 9))
        assert some == more and len(some) == 1 and (most == 1000 or len(some[0]) == 3000)


def test_a_search_keeps_all_rows_in_a_bounded_number_of_partitions(spark, monkeypatch):
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("row_key"))
    kept = T.bounded(rows, by="row_key")
    assert kept.count() == 30_000 and kept.rdd.getNumPartitions() == 2
    monkeypatch.setattr(C, "SEARCH_ROWS_PER_TASK", 8_000)
    assert T.bounded(rows, by="row_key").rdd.getNumPartitions() == 4
    monkeypatch.setattr(C, "SEARCH_TASKS", 3)
    assert T.bounded(rows, by="row_key").rdd.getNumPartitions() == 3
    assert [T.bounded(rows.limit(n), by="row_key").count() for n in (0, 1)] == [0, 1]


def test_model_selection_fits_on_all_training_rows(spark, monkeypatch):
    kinds = dict(service="svc", log_file="f", log_level="INFO", http_method="GET", response_category="Fast")
    data = spark.range(24_000).select(
        F.concat(F.lit("e"), "id").alias("row_key"), *[F.lit(v).alias(c) for c, v in kinds.items()],
        *[(F.col("id") % (7 + i)).cast("int").alias(c) for i, c in enumerate(C.HEALTH_NUMERIC_FEATURES)],
        (F.col("id") % 7 > 4).cast("double").alias("label"))
    train = prep.class_weights(data.where("row_key <> 'e0'"))
    fitted, search = [], T.select_model

    def counted(name, features):
        fitted.append(features.count())
        return search(name, features, grid=[{}])

    monkeypatch.setattr(model_cases, "health_frames", lambda spark, d: (train, data))
    monkeypatch.setattr(T, "select_model", counted)
    monkeypatch.setattr(T, "CLASSIFIERS", {"decision_tree": T.decision_tree})
    chosen = model_cases.health_model_selection(spark, "").first()
    assert fitted == [23_999] and chosen.model == "decision_tree" and chosen.f1 == 1.0


def test_fits_of_a_search_share_no_local_properties(spark, monkeypatch, rows):
    seen, jvm = [], spark.sparkContext._jvm

    class Seen(DecisionTreeClassifier):
        def _fit(self, dataset):
            seen.append(jvm.System.identityHashCode(spark.sparkContext._jsc.sc().getLocalProperties()))
            return super()._fit(dataset)

    monkeypatch.setattr(T, "CLASSIFIERS", {"seen": lambda label, weight: Seen(labelCol=label, weightCol=weight)})
    features = prep.Pipeline(stages=prep.feature_stages(["log_level"], ["response_time"])).fit(rows).transform(
        prep.class_weights(rows.withColumn("label", F.col("is_anomaly").cast("double"))))
    depths = T.ParamGridBuilder().addGrid(DecisionTreeClassifier.maxDepth, [1, 2]).build()
    assert T.select_model("seen", features, grid=depths, folds=2).bestModel.depth == 2
    assert len(seen) == 5 and len(set(seen)) == 5  # two points in two folds, and the best one again


def test_leakage_report(rows):
    got = {r.feature: r for r in M.leakage_report(
        rows.withColumn("copy", F.col("is_anomaly")), "is_anomaly", ["copy", "log_file", "event_id"]).collect()}
    assert got["copy"].determines_label and got["copy"].distinct_values == 2
    assert got["log_file"].purity >= got["log_file"].baseline and not got["log_file"].determines_label


def test_run_history(spark):
    start = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [(f"Binary_{i}", start + dt.timedelta(days=i), {"f1": i / 3}) for i in range(12)] + [("Other", start, {"f1": 1.0})],
        "run_name string, start_time timestamp, metrics map<string,double>")
    newest = R.recent_runs(runs, "Binary_").collect()
    assert [r.run_name for r in newest] == [f"Binary_{i}" for i in range(11, 1, -1)]
    assert json.loads(newest[1].metrics_json) == {"f1": 3.3333}
    assert json.loads(R.runs_json(runs, "Binary_").first()[0])["runs"]["Binary_11"] == {"f1": 3.6667}
    assert json.loads(R.runs_json(runs, "None_").first()[0]) == {"status": "no_matching_runs", "prefix": "None_"}


def test_cards_are_computed(spark):
    rows = spark.range(300).selectExpr("int(id % 3 = 0) as y", "id % 3 as tell", "id % 7 as quiet")
    runs = spark.createDataFrame([("A_1", dt.datetime(2024, 1, 1), {"f1": 0.5})], "run_name string, start_time timestamp, metrics map<string,double>")
    made = R.model_cards([
        R.model_card("good", rows, "y", ["quiet"], T.decision_tree("y", depth=4), runs=runs, prefix="A_"),
        R.model_card("leaky", rows, "y", ["quiet", "tell"], T.decision_tree("y")),
        R.model_card("rare", rows.where("y = 0 or quiet = 1"), "y", ["quiet"], T.decision_tree("y")),
        R.model_card("unfitted", rows, "y", ["quiet"]),
    ])
    cards = {r.model_name: r for r in made.collect()}
    assert {n: c.status for n, c in cards.items()} == {
        "good": "production_candidate", "leaky": "demo_only", "rare": "paused", "unfitted": "paused"}
    assert cards["good"].target_definition == "y: 100 of 300 rows are positive." and "maxDepth=4" in cards["good"].algorithm
    assert json.loads(cards["good"].metrics_json)["runs"] == {"A_1": {"f1": 0.5}}
    assert cards["leaky"].limitations == "The label follows from tell alone." and cards["unfitted"].algorithm == "none"
