"""What a tree or any model rests on, computed from counts: first splits and permutation importance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglattice import constants as C
from loglattice.ml.prep import hash_fraction

# Rows that change values among themselves; groups are as many as the rows ask for.
SHUFFLE_GROUP = 1000


def class_histograms(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Rows (feature, value, ones, zeros): how often each value of a numeric feature goes with either class."""
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    one = F.col("_label").cast("double") == 1.0
    long = df.select(F.col(label).alias("_label"), F.inline(values))
    return long.groupBy("feature", "value").agg(F.count_if(one).alias("ones"), F.count_if(~one).alias("zeros"))


def _gini(ones: Column, zeros: Column) -> Column:
    n = ones + zeros
    return F.when(n > 0, 1 - (ones / n) * (ones / n) - (zeros / n) * (zeros / n)).otherwise(0.0)


def first_splits(histograms: DataFrame) -> DataFrame:
    """Rows (feature, threshold, gain): the best split of each feature by Gini gain, the lowest threshold among ties.

    Rows with a value up to the threshold, which lies halfway to the next value, go left. Works on the histograms of
    features with few values, as trees do on their bins; a feature's values are in one window.
    """
    order = Window.partitionBy("feature").orderBy("value")
    upto, every = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("feature")
    left1, left0 = F.sum("ones").over(upto), F.sum("zeros").over(upto)
    all1, all0 = F.sum("ones").over(every), F.sum("zeros").over(every)
    cells = histograms.select(
        "feature", left1.alias("l1"), left0.alias("l0"), all1.alias("n1"), all0.alias("n0"),
        ((F.col("value") + F.lead("value").over(order)) / 2).alias("threshold"),
    ).where(F.col("threshold").isNotNull())
    l1, l0, n1, n0 = (F.col(c) for c in ("l1", "l0", "n1", "n0"))
    n = n1 + n0
    gain = _gini(n1, n0) - (l1 + l0) / n * _gini(l1, l0) - (n - l1 - l0) / n * _gini(n1 - l1, n0 - l0)
    best = F.max_by(F.col("threshold"), F.struct(F.round("gain", 12), -F.col("threshold")))
    return cells.withColumn("gain", gain).groupBy("feature").agg(best.alias("threshold"), F.max("gain").alias("gain"))


def shuffled(df: DataFrame, column: str, key: str = "event_id", seed: int = C.SEED + 3, groups: int | None = None) -> DataFrame:
    """The rows with one column's values dealt anew among the rows of a hash group: each takes the next row's, by hash.

    The values stay the same as a whole, the choice repeats exactly, and no group grows with the data.
    """
    groups = groups or max(df.count() // SHUFFLE_GROUP, 1)
    draw = hash_fraction(key, seed)
    group = F.floor(draw * groups)
    here = Window.partitionBy(group).orderBy(draw, key)
    first = F.first(column).over(here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.lead(F.lit(True)).over(here).isNull()
    return df.withColumn(column, F.when(last, first).otherwise(F.lead(column).over(here)))


def permutation_importance(
    df: DataFrame, predict: Callable[[DataFrame], DataFrame], features: list[str], label: str = "label",
    prediction: str = "prediction", key: str = "event_id", groups: int | None = None,
) -> DataFrame:
    """Rows (feature, accuracy, shuffled_accuracy, importance): what a model loses when a feature says nothing.

    ``predict`` adds predictions to rows, so any model or rule can be asked. One aggregate per feature.
    """
    def accuracy(rows: DataFrame, name: str) -> DataFrame:
        right = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
        return predict(rows).agg(F.avg(right).alias(name))

    whole, out = accuracy(df, "accuracy"), None
    for feature in features:
        one = accuracy(shuffled(df, feature, key, groups=groups), "shuffled_accuracy").select(
            F.lit(feature).alias("feature"), whole.scalar().alias("accuracy"), "shuffled_accuracy")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("importance", F.col("accuracy") - F.col("shuffled_accuracy"))
