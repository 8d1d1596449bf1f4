"""Model evaluation as SQL aggregates: one pass over the predictions per group of metrics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from loglattice.operators.shares import running_totals


def confusion_matrix(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predictions.groupBy(label, prediction).count().orderBy(label, prediction)


def weighted_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by class size, in one row.

    All of it comes from the confusion counts, of which there are at most classes squared.
    """
    actual, predicted = F.col(label).cast("double"), F.col(prediction).cast("double")
    cells = predictions.groupBy(actual.alias("actual"), predicted.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("rows"), F.lit(0).cast("long").alias("claims"),
                         hit.cast("long").alias("hits")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("rows"), F.col("n").alias("claims"),
                         F.lit(0).cast("long").alias("hits")),
            )
        ).alias("side")
    ).select("side.*")
    classes = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("rows", "claims", "hits")])

    precision = F.when(F.col("claims") > 0, F.col("hits") / F.col("claims")).otherwise(F.lit(0.0))
    recall = F.when(F.col("rows") > 0, F.col("hits") / F.col("rows")).otherwise(F.lit(0.0))
    both = F.col("precision") + F.col("recall")
    scored = classes.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0))
    )
    rows = F.sum("rows")
    return scored.agg(
        (F.sum("hits") / rows).alias("accuracy"),
        *[(F.sum(F.col(m) * F.col("rows")) / rows).alias(m) for m in ("precision", "recall", "f1")],
    )


def roc_auc(predictions: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve in one row, with tied scores counted half; NULL with one class only.

    Rows are first counted per score, from one read, and the ranks come from running totals over ranges of scores.
    """
    positive = F.col(label).cast("double") == 1.0
    per_score = predictions.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    ranked = running_totals(per_score, "score", ["negatives"])
    wins = F.sum(
        F.col("positives").cast("double") * (F.col("negatives_before").cast("double") + F.col("negatives") / F.lit(2.0))
    )
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return ranked.agg((wins / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def evaluate(predictions: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
             ) -> DataFrame:
    """All five metrics in one row."""
    return weighted_metrics(predictions, label, prediction).withColumn(
        "roc_auc", roc_auc(predictions, label, score).scalar())


def compare_models(results: dict[str, DataFrame]) -> DataFrame:
    """One row per model from its ``evaluate`` row, best F1 first."""
    out = None
    for name, metrics in results.items():
        one = metrics.select(F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1", "roc_auc")
        out = one if out is None else out.unionByName(one)
    return out.orderBy(F.desc("f1"), "model")


def label_dependencies(df: DataFrame, label: str, features: list[str], most: int = 3) -> DataFrame:
    """Smallest sets of at most ``most`` features that fix the label: rows (features, size, distinct_values).

    Level by level: a set is looked at only if no smaller one inside it fixes the label already. All sets of a
    level are judged from one read and one shuffle; a row becomes a digest of its values for each set, and what is kept
    per distinct digest is whether its rows share one label. NULL counts as a value.
    """
    spark, found, levels = df.sparkSession, [], []
    digests = {c: F.struct(F.xxhash64(F.lit(c), F.col(c), F.col(c).isNull()), F.xxhash64(F.col(c), F.col(c).isNull())) for c in features}
    target = F.xxhash64(F.col(label), F.col(label).isNull())
    for size in range(1, most + 1):
        sets = [s for s in combinations(features, size) if not any(set(f) <= set(s) for f in found)]
        if not sets:
            break
        keys = [F.struct(F.lit(i).alias("i"), *[F.xxhash64(F.lit(seed), *[digests[c] for c in s]).alias(f"h{seed}") for seed in (1, 2)])
                for i, s in enumerate(sets)]
        pairs = df.select(target.alias("label"), F.inline(F.array(*keys)))
        judged = pairs.groupBy("i", "h1", "h2").agg((F.min("label") == F.max("label")).alias("one"))
        told = judged.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.bool_and("one").alias("fixes")).where("fixes").collect()
        found += [sets[r.i] for r in told]
        levels += [(list(sets[r.i]), size, r.n) for r in told]
    return spark.createDataFrame(levels, "features array<string>, size int, distinct_values bigint")


def leakage_report(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """How far each feature alone fixes the label: the share of rows in their value's largest class.

    1.0 means that the label is a function of the feature. ``baseline`` is the largest class overall.
    """
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features])
    long = df.select(F.col(label).alias("_label"), F.explode(values).alias("pair")).select("_label", "pair.*")
    cells = long.groupBy("feature", "value", "_label").agg(F.count(F.lit(1)).alias("n"))
    per_value = cells.groupBy("feature", "value").agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    report = per_value.groupBy("feature").agg(
        F.count(F.lit(1)).alias("distinct_values"), (F.sum("top") / F.sum("n")).alias("purity")
    )
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    baseline = classes.agg((F.max("n") / F.sum("n")).alias("b")).scalar()
    return report.withColumn("baseline", baseline).withColumn("determines_label", F.col("purity") == 1.0)
