"""Model data, metrics of a rule-based prediction, and fits over the event table."""

from __future__ import annotations

import uuid
from itertools import combinations

from pyspark.sql import functions as F

from loglattice import constants as C
from loglattice.ml import explain as X, metrics as M, prep, runs as R, train as T
from loglattice.operators import serving as K, warning as W
from loglattice.plans import silver as P
from loglattice.registry.case import Cases
from loglattice.registry.fixture import half_up as r, logs, over_logs, over_silver, silver, table
from loglattice.registry.gold_cases import six
from loglattice.session import checkpoint_dir, cut_lineage

CASES = Cases()


def _fraction(seed: int, key: str = "event_id") -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT) / 4294967296.0)"


@CASES.add("train_test_split", "M1", over_logs(
    f"SELECT event_id, CASE WHEN {_fraction(42)} < 0.8 THEN 'train' ELSE 'test' END AS part FROM logs"))
def train_test_split(spark, d):
    train, test = prep.split(logs(spark, d).select("event_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@CASES.add("class_counts", "M2", over_silver(
    f'SELECT is_anomaly, count(*) AS "count" FROM silver WHERE {_fraction(42)} < 0.8 GROUP BY 1 ORDER BY 1'))
def class_counts(spark, d):
    return prep.class_counts(prep.split(silver(spark, d))[0])


_BALANCED = f"""
balanced AS (
  SELECT event_id, is_anomaly FROM silver
  WHERE {_fraction(42)} < 0.8 AND (is_anomaly = 1 OR {_fraction(43)} < (
    SELECT CASE WHEN sum(is_anomaly) > 0 THEN 5.0 * sum(is_anomaly) / (count(*) - sum(is_anomaly)) ELSE 1.0 END
    FROM silver WHERE {_fraction(42)} < 0.8)))
"""


@CASES.add("undersample", "M3", over_silver("SELECT * FROM balanced", _BALANCED))
def undersample(spark, d):
    return prep.undersample(prep.split(silver(spark, d))[0]).select("event_id", "is_anomaly")


@CASES.add("undersample_by_union", "M3 X5", over_silver("SELECT * FROM balanced", _BALANCED))
def undersample_by_union(spark, d):
    return prep.undersample_by_union(prep.split(silver(spark, d).select("event_id", "is_anomaly"))[0])


@CASES.add("class_weights", "M4", over_silver(f"""
SELECT event_id, log_level, {r('(SELECT count(*) FROM silver) / ((SELECT count(DISTINCT log_level) FROM silver) * n)', 6)}
       AS class_weight
FROM silver JOIN (SELECT log_level, count(*) AS n FROM silver GROUP BY log_level) USING (log_level)"""))
def class_weights(spark, d):
    weighted = prep.class_weights(silver(spark, d).select("event_id", "log_level"), "log_level")
    return six(weighted, "class_weight")


@CASES.add("label_ranks", "M5", over_silver("""
SELECT service, count(*) AS "rows", CAST(row_number() OVER (ORDER BY count(*) DESC, service) - 1 AS DOUBLE) AS label
FROM silver GROUP BY service"""))
def label_ranks(spark, d):
    return prep.label_ranks(silver(spark, d), "service")


@CASES.add("label_index", "M5", over_silver("""
SELECT event_id, label FROM silver JOIN (
  SELECT service, CAST(row_number() OVER (ORDER BY count(*) DESC, service) - 1 AS DOUBLE) AS label
  FROM silver GROUP BY service) USING (service)"""))
def label_index(spark, d):
    events = silver(spark, d).select("event_id", "service")
    return prep.label_indexer("service").fit(events).transform(events).select("event_id", "label")


# ------------------------------------------------------------------ metrics of a rule


_RULES = {
    "by_level": ("severity_score >= 2", "severity_score / 4.0"),
    "by_instance": ("instance_id IS NOT NULL", "CASE WHEN instance_id IS NULL THEN 0.0 ELSE (CAST(user_id AS INT) % 97) / 97.0 END"),
    "by_volume": ("kafka_offset % 5 = 0", "(kafka_offset % 1009) / 1009.0"),
}


def _predictions(spark, d, name):
    rule, score = _RULES[name]
    return silver(spark, d).select(
        F.col("is_anomaly").cast("double").alias("label"),
        F.expr(f"CAST({rule} AS INT)").cast("double").alias("prediction"),
        F.expr(f"CAST({score} AS DOUBLE)").alias("score"))


def _predicted(name: str) -> str:
    rule, score = _RULES[name]
    return (f"{name} AS (SELECT CAST(is_anomaly AS DOUBLE) AS label, CAST(CAST({rule} AS INTEGER) AS DOUBLE) AS prediction, "
            f"CAST({score} AS DOUBLE) AS score FROM silver)")


def _metric_sql(name: str) -> str:
    """The five metrics for labels 0 and 1, from counts and from ranks averaged over ties."""
    return f"""
    SELECT accuracy, (p0 * n0 + p1 * n1) / n AS "precision", (r0 * n0 + r1 * n1) / n AS recall,
           (coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * n0 + coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * n1) / n AS f1,
           roc_auc
    FROM (SELECT count(*) AS n, count(*) FILTER (label = 1) AS n1, n - n1 AS n0,
                 count(*) FILTER (label = prediction) / count(*) AS accuracy,
                 coalesce(count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (prediction = 1), 0), 0) AS p1,
                 coalesce(count(*) FILTER (label = 0 AND prediction = 0) / nullif(count(*) FILTER (prediction = 0), 0), 0) AS p0,
                 coalesce(count(*) FILTER (label = 1 AND prediction = 1) / nullif(n1, 0), 0) AS r1,
                 coalesce(count(*) FILTER (label = 0 AND prediction = 0) / nullif(n0, 0), 0) AS r0,
                 (sum(rank) FILTER (label = 1) - n1 * (n1 + 1) / 2.0) / nullif(n1 * n0, 0) AS roc_auc
          FROM (SELECT label, prediction,
                       rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rank FROM {name}))
    """


_FIVE = ["accuracy", "precision", "recall", "f1", "roc_auc"]
_SIX_PLACES = ", ".join(f'{r(chr(34) + m + chr(34), 6)} AS "{m}"' for m in _FIVE)


@CASES.add("evaluate", "M12", over_silver(
    f"SELECT {_SIX_PLACES} FROM ({_metric_sql('by_instance')})", _predicted("by_instance")))
def evaluate(spark, d):
    return six(M.evaluate(_predictions(spark, d, "by_instance")), *_FIVE)


@CASES.add("roc_auc_many_scores", "M12", over_logs(f"""
SELECT {r('(sum(rank) FILTER (label = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0)', 6)} AS roc_auc FROM (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rank,
         count(*) FILTER (label = 1) OVER () AS n1, count(*) FILTER (label = 0) OVER () AS n0
  FROM (SELECT CAST(status_code >= 400 AS INTEGER) AS label, response_time AS score FROM logs WHERE status_code IS NOT NULL))
GROUP BY n1, n0"""))
def roc_auc_many_scores(spark, d):
    timed = P.http_only(logs(spark, d))
    scored = timed.select((F.col("status_code") >= 400).cast("int").alias("label"), F.col("response_time").alias("score"))
    return six(M.roc_auc(scored), "roc_auc")


@CASES.add("confusion_matrix", "M13", over_silver(
    'SELECT label, prediction, count(*) AS "count" FROM by_level GROUP BY ALL ORDER BY 1, 2', _predicted("by_level")))
def confusion_matrix(spark, d):
    return M.confusion_matrix(_predictions(spark, d, "by_level"))


@CASES.add("compare_models", "M14 X4", over_silver(
    "SELECT model, " + _SIX_PLACES + " FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS model, * FROM ({_metric_sql(n)})" for n in _RULES) + ") ORDER BY f1 DESC, model",
    *[_predicted(n) for n in _RULES]))
def compare_models(spark, d):
    return six(M.compare_models({n: M.evaluate(_predictions(spark, d, n)) for n in _RULES}), *_FIVE)


_HEALTH = """
health AS (
  SELECT *, CASE WHEN log_level = 'CRITICAL' OR (log_level = 'ERROR' AND coalesce(response_time, 0) >= 0.6)
                      OR coalesce(status_code, -1) >= 500 THEN 'Critical'
                 WHEN log_level IN ('ERROR', 'WARNING') OR is_anomaly = 1 OR coalesce(response_time, 0) > 0.35
                      OR coalesce(status_code, -1) >= 400 THEN 'Degrading' ELSE 'Healthy' END AS service_health
  FROM silver)
"""
_LEAK_FEATURES = ["service", "log_level", "status_code", "severity_score", "response_category", "response_time"]


def _purity(c: str) -> str:
    return f"""
    SELECT '{c}' AS feature, count(*) AS distinct_values, {r('sum(top) / sum(n)', 6)} AS purity, sum(top) = sum(n) AS determines_label
    FROM (SELECT max(n) AS top, sum(n) AS n FROM (
            SELECT {c}, service_health, count(*) AS n FROM health GROUP BY ALL) GROUP BY {c})"""


@CASES.add("leakage_report", "M19", over_silver(
    f"SELECT *, {r('(SELECT max(n) / sum(n) FROM (SELECT count(*) AS n FROM health GROUP BY service_health))', 6)} AS baseline "
    f"FROM ({' UNION ALL '.join(_purity(c) for c in _LEAK_FEATURES)})", _HEALTH))
def leakage_report(spark, d):
    labelled = P.service_health_label(P.fill_health(silver(spark, d)))
    raw = labelled.withColumns({
        "status_code": F.nullif("status_code", F.lit(-1)),
        "response_time": F.when(F.col("http_method") != C.HEALTH_MARKER, F.col("response_time"))})
    return six(M.leakage_report(raw, "service_health", _LEAK_FEATURES), "purity", "baseline")


def _fixes(features: tuple[str, ...]) -> str:
    names = ", ".join(features)
    listed = ", ".join(f"'{f}'" for f in features)
    return f"""
    SELECT [{listed}] AS features, CAST({len(features)} AS INTEGER) AS "size", count(*) AS distinct_values, bool_and(classes = 1) AS fixes
    FROM (SELECT {names}, count(DISTINCT service_health) AS classes FROM health GROUP BY {names})"""


_PARTS = ["service", "log_level", "status_code", "response_time", "is_anomaly"]
_SETS = [s for n in (1, 2, 3, 4) for s in combinations(_PARTS, n)]


@CASES.add("label_dependencies", "M19", over_silver(f"""
SELECT array_to_string(features, ', ') AS features, "size", distinct_values FROM sets s
WHERE fixes AND NOT EXISTS (SELECT 1 FROM sets t WHERE t.fixes AND t."size" < s."size" AND list_has_all(s.features, t.features))""",
    _HEALTH, f"sets AS ({' UNION ALL '.join(map(_fixes, _SETS))})"))
def label_dependencies(spark, d):
    labelled = P.service_health_label(P.fill_health(silver(spark, d)))
    raw = labelled.withColumns({
        "status_code": F.nullif("status_code", F.lit(-1)),
        "response_time": F.when(F.col("http_method") != C.HEALTH_MARKER, F.col("response_time"))})
    found = M.label_dependencies(raw, "service_health", _PARTS, most=4)
    return found.withColumn("features", F.array_join("features", ", "))


@CASES.add("fold_sizes", "M10", over_logs(f"""
SELECT CAST(floor({_fraction(44)} * 3) AS INTEGER) AS fold, count(*) AS "rows" FROM logs GROUP BY 1"""))
def fold_sizes(spark, d):
    folds = prep.with_fold(logs(spark, d).select("event_id"))
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------ first splits and permuted columns

_SPLIT_FEATURES = ["event_hour", "status_code", "severity_score", "is_anomaly"]
_DEGRADING = ("CAST(log_level IN ('ERROR', 'WARNING') OR is_anomaly = 1 OR coalesce(response_time, 0) > 0.35 "
              "OR coalesce(status_code, -1) >= 400 AS INT)")
_HISTOGRAM = " UNION ALL ".join(f"""
  SELECT '{c}' AS feature, {i} AS place, CAST({c} AS DOUBLE) AS value, count(*) FILTER (degrading = 1) AS ones, count(*) FILTER (degrading = 0) AS zeros
  FROM split_rows GROUP BY {c}""" for i, c in enumerate(_SPLIT_FEATURES))
_GAINS = f"""
split_rows AS (
  SELECT event_hour, coalesce(status_code, -1) AS status_code, severity_score, is_anomaly, {_DEGRADING} AS degrading
  FROM silver WHERE {_fraction(42)} < 0.8),
histogram AS ({_HISTOGRAM}),
cells AS (
  SELECT feature, place, (value + lead(value) OVER (PARTITION BY feature ORDER BY value)) / 2 AS threshold,
         sum(ones) OVER upto AS l1, sum(zeros) OVER upto AS l0, sum(ones) OVER (PARTITION BY feature) AS n1,
         sum(zeros) OVER (PARTITION BY feature) AS n0
  FROM histogram WINDOW upto AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
gains AS (
  SELECT feature, place, threshold, 1 - (n1 / n) ** 2 - (n0 / n) ** 2 - l / n * (1 - (l1 / l) ** 2 - (l0 / l) ** 2)
         - rest / n * (1 - ((n1 - l1) / rest) ** 2 - ((n0 - l0) / rest) ** 2) AS gain
  FROM (SELECT *, n1 + n0 AS n, l1 + l0 AS l, n1 + n0 - l1 - l0 AS rest FROM cells) WHERE threshold IS NOT NULL)
"""


def split_rows(spark, d):
    train = prep.split(silver(spark, d).withColumn("degrading", F.expr(_DEGRADING)).fillna({"status_code": -1}))[0]
    return train.select("degrading", *_SPLIT_FEATURES)


@CASES.add("first_splits", "M8 M15", over_silver(f"""
SELECT feature, arg_max(threshold, (round(gain, 12), -threshold)) AS threshold, {r('max(gain)', 6)} AS gain FROM gains GROUP BY feature""",
    _GAINS))
def first_splits(spark, d):
    return six(X.first_splits(X.class_histograms(split_rows(spark, d), "degrading", _SPLIT_FEATURES)), "gain")


@CASES.add("tree_first_split", "M8 M15", over_silver(f"""
SELECT feature, threshold, {r('gain', 6)} AS gain, CAST(1 AS DOUBLE) AS importance_total
FROM gains ORDER BY round(gain, 12) DESC, place, threshold LIMIT 1""", _GAINS))
def tree_first_split(spark, d):
    """The first split that a fitted tree takes is the one that counts give."""
    from pyspark.ml.feature import VectorAssembler

    rows = split_rows(spark, d)
    vectors = VectorAssembler(inputCols=_SPLIT_FEATURES, outputCol="features").transform(rows)
    model = T.decision_tree("degrading", depth=1).fit(vectors)
    importance = T.feature_importance(model, vectors).agg(F.sum("importance").alias("total")).first()["total"]
    told = spark.createDataFrame([(*T.root_split(model, vectors), importance)], "feature string, threshold double, gain double, importance_total double")
    return six(told, "gain", "importance_total")


_PERMUTED = ["severity_score", "instance_exists", "event_hour"]
_RULE = "CAST(severity_score >= 2 AND instance_exists = 0 OR event_hour % 7 = 0 AS INTEGER)"


def _dealt(column: str) -> str:
    named = ", ".join(f"dealt AS {c}" if c == column else c for c in _PERMUTED)
    return f"""
    SELECT '{column}' AS feature, (SELECT avg(CAST(is_anomaly = {_RULE} AS INTEGER)) FROM permuted_rows) AS accuracy,
           avg(CAST(is_anomaly = {_RULE} AS INTEGER)) AS shuffled_accuracy
    FROM (SELECT is_anomaly, {named} FROM (
      SELECT *, coalesce(lead({column}) OVER dealing, first({column}) OVER (PARTITION BY pile ORDER BY draw, event_id)) AS dealt
      FROM permuted_rows WINDOW dealing AS (PARTITION BY pile ORDER BY draw, event_id)))"""


@CASES.add("permutation_importance", "M7 M9 M15", over_silver(
    f"SELECT feature, {r('accuracy', 6)} AS accuracy, {r('shuffled_accuracy', 6)} AS shuffled_accuracy, "
    f"{r('accuracy - shuffled_accuracy', 6)} AS importance FROM ({' UNION ALL '.join(map(_dealt, _PERMUTED))})", f"""
permuted_rows AS (
  SELECT event_id, is_anomaly, severity_score, CAST(instance_id IS NOT NULL AS INTEGER) AS instance_exists, event_hour,
         {_fraction(45)} AS draw, floor({_fraction(45)} * 8) AS pile
  FROM silver)"""))
def permutation_importance(spark, d):
    rows = P.instance_exists(silver(spark, d)).select("event_id", "is_anomaly", *_PERMUTED)
    told = X.permutation_importance(
        rows, lambda df: df.withColumn("prediction", F.expr(_RULE)), _PERMUTED, label="is_anomaly", groups=8)
    return six(told, "accuracy", "shuffled_accuracy", "importance")


# ------------------------------------------------------------------ run history and cards


def run_history(spark, d):
    """One run per event type and day, its metrics taken from that day's values."""
    by_day = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.max("ts").cast("timestamp").alias("start_time"), F.avg("value").alias("mean"),
        F.count(F.lit(1)).cast("double").alias("n"))
    name = F.concat(F.when(F.col("event_type") == "error", F.lit("Health_")).otherwise(F.lit("Binary_")), "event_type",
                    F.lit("_"), F.col("day").cast("string"))
    return by_day.select(name.alias("run_name"), "start_time",
                         F.create_map(F.lit("mean"), "mean", F.lit("n"), "n").alias("metrics"))


@CASES.add("recent_runs", "M17 X3", f"""
SELECT 'Binary_' || event_type || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_name, max(ts) AS start_time,
       {r('avg(value)', 4)} AS mean_metric, CAST(count(*) AS DOUBLE) AS n_metric
FROM events WHERE event_type <> 'error' GROUP BY event_type, CAST(ts AS DATE) ORDER BY start_time DESC, run_name LIMIT 10""")
def recent_runs(spark, d):
    newest = R.recent_runs(run_history(spark, d), "Binary_")
    return newest.select(
        "run_name", F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        F.col("metrics")["mean"].alias("mean_metric"), F.get_json_object("metrics_json", "$.n").cast("double").alias("n_metric"))


_ANOMALY_FEATURES = ["service", "log_level", "http_method", "status_code", "response_category", "event_hour",
                     "instance_exists", "log_file"]
_HEALTH_FEATURES = ["log_level", "status_code", "severity_score", "response_category", "service", "event_hour", "is_anomaly"]
_WARNING_FEATURES = ["total_logs", "error_count", "warning_count", "event_hour"]


def cards(spark, d, events=None):
    """A card for each model, from the rows it would be trained on."""
    events = silver(spark, d) if events is None else events
    health = P.service_health_label(events.fillna(C.HEALTH_SENTINELS)).where("service_health <> 'Critical'").withColumn(
        "degrading", (F.col("service_health") == "Degrading").cast("int"))
    warning = W.early_warning_target(W.early_warning_base(events))
    history = run_history(spark, d)
    given = [
        R.CardRows("anomaly", P.instance_exists(events), "is_anomaly", _ANOMALY_FEATURES),
        R.CardRows("health", health, "degrading", _HEALTH_FEATURES),
        R.CardRows("early_warning", warning, "early_warning_target", _WARNING_FEATURES),
    ]
    more = {"anomaly": {"classifier": T.random_forest(), "runs": history, "prefix": "Binary_"},
            "health": {"classifier": T.decision_tree("degrading")}}
    facts = cut_lineage(R.card_facts(given))
    return R.model_cards([R.model_card(*card, facts=facts, **more.get(card.name, {})) for card in given])


def _leaks(rows: str, label: str, features: list[str]) -> str:
    """Features each of whose values has one class only."""
    tests = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, bool_and(classes = 1) AS fixes FROM "
        f"(SELECT count(DISTINCT {label}) AS classes FROM {rows} GROUP BY CAST({f} AS VARCHAR))" for f in features)
    return f"(SELECT coalesce(string_agg(feature, ', ' ORDER BY feature), '') FROM ({tests}) WHERE fixes)"


_CARDS = f"""
anomaly_rows AS (SELECT *, CAST(instance_id IS NOT NULL AS INTEGER) AS instance_exists FROM silver),
health_rows AS (
  SELECT * EXCLUDE (status_code, response_time), coalesce(status_code, -1) AS status_code,
         CAST(log_level IN ('ERROR', 'WARNING') OR is_anomaly = 1 OR coalesce(response_time, 0) > 0.35
              OR coalesce(status_code, -1) >= 400 AS INTEGER) AS degrading
  FROM silver
  WHERE NOT (log_level = 'CRITICAL' OR (log_level = 'ERROR' AND coalesce(response_time, 0) >= 0.6)
             OR coalesce(status_code, -1) >= 500)),
card_facts AS (
  SELECT 'anomaly' AS model_name, count(*) AS n, count(*) FILTER (is_anomaly = 1) AS positives, true AS fitted,
         {_leaks('anomaly_rows', 'is_anomaly', _ANOMALY_FEATURES)} AS leaks FROM anomaly_rows
  UNION ALL
  SELECT 'health', count(*), count(*) FILTER (degrading = 1), true, {_leaks('health_rows', 'degrading', _HEALTH_FEATURES)}
  FROM health_rows
  UNION ALL
  SELECT 'early_warning', count(*), count(*) FILTER (early_warning_target = 1), false,
         {_leaks('warning_rows', 'early_warning_target', _WARNING_FEATURES)} FROM warning_rows),
model_cards AS (
  SELECT model_name, n, positives, leaks,
         CASE WHEN leaks = '' THEN 'No feature fixes the label alone.' ELSE 'The label follows from ' || leaks || ' alone.' END
           || CASE WHEN positives < 50 THEN ' Fewer than 50 positive rows.' ELSE '' END AS limitations,
         CASE WHEN NOT fitted OR positives < 50 THEN 'paused' WHEN leaks <> '' THEN 'demo_only'
              ELSE 'production_candidate' END AS status
  FROM card_facts)
"""
# Next hours of the early warning rows: the hour after, of the same service.
_WARNING = """
hours AS (
  SELECT service, event_hour, date_trunc('hour', event_timestamp) AS hour, count(*) AS total_logs,
         count(*) FILTER (log_level = 'ERROR') AS error_count, count(*) FILTER (log_level = 'WARNING') AS warning_count,
         count(*) FILTER (log_level = 'CRITICAL') AS critical_count
  FROM silver GROUP BY ALL),
warning_rows AS (
  SELECT h.*, CAST(coalesce(f.critical_count, 0) > 0 AS INTEGER) AS early_warning_target
  FROM hours h LEFT JOIN hours f ON h.service = f.service AND f.hour = h.hour + INTERVAL 1 HOUR)
"""
CARD_CTES = (_WARNING, _CARDS)


@CASES.add("model_cards", "I16", over_silver(
    "SELECT model_name, positives || ' of ' || n AS share, limitations, status FROM model_cards", *CARD_CTES))
def model_cards(spark, d):
    share = F.regexp_extract("target_definition", "([0-9]+ of [0-9]+)", 1).alias("share")
    return cards(spark, d).select("model_name", share, "limitations", "status")


@CASES.add("model_card_status", "I16 K15", over_silver("""
SELECT count(*) AS models, count(*) FILTER (status = 'production_candidate') AS production_candidates,
       count(*) FILTER (status = 'demo_only') AS demo_only, count(*) FILTER (status = 'paused') AS paused,
       CAST((SELECT count(*) > 0 FROM events WHERE event_type <> 'error') AS BIGINT) AS with_metrics
FROM model_cards""", *CARD_CTES))
def model_card_status(spark, d):
    made = cards(spark, d)
    read = F.get_json_object("metrics_json", "$.status") == "read_from_runs"
    counts = made.agg(F.count_if(read).alias("with_metrics"))
    return K.model_summary(made).withColumn("with_metrics", counts.scalar())


# ------------------------------------------------------------------ fits


def anomaly_frames(spark, d):
    """Balanced training rows and natural test rows of the anomaly model."""
    events = silver(spark, d)
    features = P.feature_dataset(events.withColumn("row_key", F.col("event_id")))
    train, test = prep.split(P.anomaly_model_frame(features), "row_key")
    return prep.undersample(train, key="row_key"), test


def health_frames(spark, d):
    """Weighted training rows and natural test rows of the health model."""
    labelled = P.health_dataset(silver(spark, d).withColumn("row_key", F.col("event_id")))
    rows = P.health_model_rows(labelled).withColumn(
        "label", F.when(F.col("health_model_label") == "Degrading", 1.0).otherwise(0.0))
    train, test = prep.split(rows, "row_key")
    return prep.class_weights(train), test


def _fitted(spark, d, classifier):
    train, test = anomaly_frames(spark, d)
    model = T.train(train, prep.anomaly_stages(), classifier)
    return M.evaluate(T.score(model, test), label="is_anomaly")


def _kinds(source: str, method: str) -> str:
    """Values of the categorical features; each has one vector slot."""
    return (f"(SELECT count(DISTINCT service) + count(DISTINCT log_file) + count(DISTINCT log_level) "
            f"+ count(DISTINCT coalesce(http_method, '{method}')) + count(DISTINCT response_category) FROM {source})")


@CASES.add("anomaly_feature_vectors", "M6", over_silver(f"""
SELECT CAST({len(C.ANOMALY_NUMERIC_FEATURES)} + {_kinds('silver SEMI JOIN balanced USING (event_id)', 'NO_HTTP')} AS INTEGER)
       AS vector_size, count(*) AS "rows" FROM silver WHERE {_fraction(42)} >= 0.8""", _BALANCED))
def anomaly_feature_vectors(spark, d):
    from pyspark.ml.functions import vector_to_array

    train, test = anomaly_frames(spark, d)
    vectors = prep.feature_pipeline("anomaly").fit(train).transform(test)
    return vectors.groupBy(F.size(vector_to_array("features")).alias("vector_size")).agg(F.count(F.lit(1)).alias("rows"))


@CASES.add("health_feature_vectors", "M6", over_silver(f"""
SELECT CAST({len(C.HEALTH_NUMERIC_FEATURES)} + {_kinds(f"health WHERE service_health <> 'Critical' AND {_fraction(42)} < 0.8", C.HEALTH_MARKER)}
            AS INTEGER) AS vector_size, count(*) AS "rows"
FROM health WHERE service_health <> 'Critical' AND {_fraction(42)} >= 0.8""", _HEALTH))
def health_feature_vectors(spark, d):
    from pyspark.ml.functions import vector_to_array

    train, test = health_frames(spark, d)
    vectors = prep.feature_pipeline("health").fit(train).transform(test)
    return vectors.groupBy(F.size(vector_to_array("features")).alias("vector_size")).agg(F.count(F.lit(1)).alias("rows"))


@CASES.add("anomaly_logistic_regression", "M7 M12")
def anomaly_logistic_regression(spark, d):
    return _fitted(spark, d, T.logistic_regression())


@CASES.add("anomaly_decision_tree", "M8 M12")
def anomaly_decision_tree(spark, d):
    return _fitted(spark, d, T.decision_tree())


@CASES.add("anomaly_random_forest", "M9 M12 M18")
def anomaly_random_forest(spark, d):
    return _fitted(spark, d, T.random_forest())


@CASES.add("anomaly_feature_importance", "M15")
def anomaly_feature_importance(spark, d):
    train, _ = anomaly_frames(spark, d)
    model = T.train(train, prep.anomaly_stages(), T.decision_tree())
    return T.feature_importance(model, model.transform(train))


@CASES.add("health_model_selection", "M10 M11")
def health_model_selection(spark, d):
    train, test = health_frames(spark, d)
    stages = prep.feature_pipeline("health").fit(train)
    # every fold and grid point reads these rows again; lost blocks come from the table, and a plan holds no more than that
    rows = stages.transform(prep.with_fold(train, key="row_key")).select("row_key", "features", "label", "class_weight", "fold")
    train_features = T.bounded(cut_lineage(rows), by="row_key").drop("row_key").cache()
    chosen = {name: T.select_model(name, train_features) for name in T.CLASSIFIERS}
    name, f1, best = T.assemble_best(stages, chosen, stages.transform(test))
    train_features.unpersist()
    # the metrics read these rows several times
    scored = cut_lineage(T.score(best, test).select("label", "prediction", "score"))
    return M.evaluate(scored).select(F.lit(name).alias("model"), *_FIVE)


@CASES.add("stored_model", "M16 M18", over_silver(f"""
SELECT count(*) AS "rows", count(*) AS same FROM silver WHERE {_fraction(42)} >= 0.8"""))
def stored_model(spark, d):
    """A fitted pipeline, saved and loaded again, scores every test row as before."""
    train, test = anomaly_frames(spark, d)
    model = T.train(train, prep.anomaly_stages(), T.decision_tree(depth=4))
    path = f"{checkpoint_dir(spark)}/stored/{uuid.uuid4().hex}"
    T.save_model(model, path)
    first = T.score(model, test).select("row_key", F.struct("prediction", "score").alias("first"))
    second = T.score(T.load_model(path), test).select("row_key", F.struct("prediction", "score").alias("second"))
    return first.join(second, "row_key", "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("first") == F.col("second")).alias("same"))
