"""Model data: split, sampling, weights, label index and the feature stages."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from loglattice import constants as C
from loglattice.operators.shares import prefix_sums


def hash_fraction(key: str = "event_id", seed: int = C.SEED) -> Column:
    """A number in [0, 1) fixed by the row's key, so reruns and retries pick the same rows."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2**32)


def split(df: DataFrame, key: str = "event_id", percent: int = C.TRAIN_PERCENT, seed: int = C.SEED
          ) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the hash of the key."""
    in_train = hash_fraction(key, seed) < percent / 100
    return df.where(in_train), df.where(~in_train)


def with_fold(df: DataFrame, folds: int = 3, key: str = "event_id", seed: int = C.SEED + 2, name: str = "fold") -> DataFrame:
    """Add the row's fold, fixed by its key; Spark's own folds depend on how the rows are partitioned."""
    return df.withColumn(name, F.floor(hash_fraction(key, seed) * folds).cast("int"))


def random_split(df: DataFrame, percent: int = C.TRAIN_PERCENT, seed: int = C.SEED) -> list[DataFrame]:
    """Spark's own random split; which rows it picks depends on how the input is partitioned."""
    return df.randomSplit([percent / 100, 1 - percent / 100], seed=seed)


def class_counts(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    return df.groupBy(label).count().orderBy(label)


def undersample(
    df: DataFrame,
    label: str = "is_anomaly",
    ratio: float = C.MAJORITY_PER_MINORITY,
    key: str = "event_id",
    seed: int = C.SEED + 1,
) -> DataFrame:
    """Keep label 1 whole and about ``ratio`` times as many rows of label 0.

    The fraction is a scalar subquery and the choice is a filter on the key's hash: one pass, no
    shuffle of the rows. Without any row of label 1 there is nothing to balance, and all rows stay.
    """
    return df.where((F.col(label) == 1) | (hash_fraction(key, seed) < _majority_fraction(df, label, ratio)))


def _majority_fraction(df: DataFrame, label: str, ratio: float) -> Column:
    minority, majority = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(F.when(minority > 0, ratio * minority / majority).otherwise(F.lit(1.0)).alias("f")).scalar()


def undersample_by_union(
    df: DataFrame,
    fraction: float | None = None,
    label: str = "is_anomaly",
    ratio: float = C.MAJORITY_PER_MINORITY,
    key: str = "event_id",
    seed: int = C.SEED + 1,
) -> DataFrame:
    """The same rows by choosing from label 0, at a given fraction or for the ratio, and uniting with label 1."""
    share = _majority_fraction(df, label, ratio) if fraction is None else F.lit(fraction)
    chosen = df.where((F.col(label) == 0) & (hash_fraction(key, seed) < share))
    return chosen.unionByName(df.where(F.col(label) == 1))


def weight_table(df: DataFrame, label: str = "label") -> DataFrame:
    """Inverse-frequency weight per class, for any set of classes: rows / (classes * rows of the class)."""
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()
    weight = F.sum("rows").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("rows"))
    return counted.withColumn("class_weight", weight)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``class_weight``, NULL for a row without a class.

    The weights, one per class of the model, come as a map from a scalar subquery: a join would
    shuffle all rows onto a handful of label values.
    """
    entries = F.collect_list(F.struct(label, "class_weight"))
    weights = weight_table(df, label).agg(F.map_from_entries(entries).alias("weights")).scalar()
    return df.withColumn("class_weight", F.try_element_at(weights, F.col(label)))


def label_indexer(source: str = "service_health", target: str = "label") -> StringIndexer:
    """Index by descending frequency, ties by value; a value not seen before gets an index of its own."""
    return StringIndexer(inputCol=source, outputCol=target, handleInvalid="keep")


def label_ranks(df: DataFrame, column: str) -> DataFrame:
    """The index that ``label_indexer`` gives each value, as a table over the value counts; no task ranks all values."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    ranked = prefix_sums(counted, [F.desc("rows"), F.col(column).asc_nulls_first()], [])
    return ranked.select(column, "rows", (F.col("place") - 1).cast("double").alias("label"))


def feature_stages(
    categorical: list[str], numeric: list[str], output: str = "features", numeric_first: bool = False
) -> list:
    """One indexer and one encoder over all categorical columns, then the assembler."""
    index = [f"{c}_index" for c in categorical]
    vectors = [f"{c}_vec" for c in categorical]
    inputs = [*numeric, *vectors] if numeric_first else [*vectors, *numeric]
    return [
        StringIndexer(inputCols=categorical, outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=vectors),
        VectorAssembler(inputCols=inputs, outputCol=output),
    ]


def anomaly_stages() -> list:
    return feature_stages(C.CATEGORICAL_FEATURES, C.ANOMALY_NUMERIC_FEATURES)


def health_stages() -> list:
    return feature_stages(C.CATEGORICAL_FEATURES, C.HEALTH_NUMERIC_FEATURES, numeric_first=True)


def feature_pipeline(kind: str = "anomaly") -> Pipeline:
    return Pipeline(stages=anomaly_stages() if kind == "anomaly" else health_stages())
