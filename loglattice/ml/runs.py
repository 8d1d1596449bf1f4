"""Run history and model cards."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F


def recent_runs(runs: DataFrame, prefix: str, n: int = 10) -> DataFrame:
    """The n newest runs whose name starts with a prefix, metrics at four places."""
    metrics = F.transform_values("metrics", lambda _, value: F.round(value, 4))
    return (
        runs.where(F.col("run_name").startswith(prefix))
        .orderBy(F.desc("start_time"), "run_name")
        .limit(n)
        .select("run_name", "start_time", metrics.alias("metrics"))
        .withColumn("metrics_json", F.to_json("metrics"))
    )


def runs_json(runs: DataFrame, prefix: str, n: int = 10) -> DataFrame:
    """One JSON text with the metrics of the newest runs, or a status that says there are none."""
    newest = recent_runs(runs, prefix, n)
    by_name = newest.groupBy("run_name").agg(F.max_by("metrics", "start_time").alias("metrics"))
    entries = F.map_from_entries(F.collect_list(F.struct("run_name", "metrics")))
    found = F.to_json(F.struct(F.lit("read_from_runs").alias("status"), entries.alias("runs")))
    missing = F.to_json(F.struct(F.lit("no_matching_runs").alias("status"), F.lit(prefix).alias("prefix")))
    return by_name.agg(F.when(F.count(F.lit(1)) > 0, found).otherwise(missing).alias("metrics_json"))


# A model is not offered on fewer positive rows.
LEAST_POSITIVES = 50
CARD_SEVERITY = {"production_candidate": "healthy", "demo_only": "degraded", "paused": "degraded"}


def _parameters(classifier) -> str:
    """An estimator or fitted model by its class and the parameters that were set on it."""
    if classifier is None:
        return "none"
    given = {p.name: v for p, v in classifier.extractParamMap().items() if classifier.isSet(p)}
    return f"{type(classifier).__name__}({', '.join(f'{k}={given[k]}' for k in sorted(given))})"


class CardRows(NamedTuple):
    """What a card is computed from: labelled rows, the label of 0 and 1, and the feature columns."""

    name: str
    rows: DataFrame
    label: str
    features: list[str]


def card_facts(cards: list[CardRows]) -> DataFrame:
    """Rows (card, n, positives, leaks) for all cards from one aggregate; a leak is a feature that fixes the label alone.

    Each row becomes a digest per feature and one for the row as such; what is kept is how often each digest goes with
    either class. NULL counts as a value, and rows without a label are left out.
    """
    def cells(card: CardRows) -> DataFrame:
        digests = [F.struct(F.lit(c).alias("feature"), F.xxhash64(F.col(c), F.col(c).isNull()).alias("value")) for c in card.features]
        whole = F.struct(F.lit("").alias("feature"), F.lit(0).cast("long").alias("value"))
        one = (F.col(card.label) == 1).alias("one")
        labelled = card.rows.where(F.col(card.label).isNotNull())
        return labelled.select(F.lit(card.name).alias("card"), one, F.inline(F.array(whole, *digests)))

    long = reduce(DataFrame.unionByName, map(cells, cards))
    counted = long.groupBy("card", "feature", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("one").alias("ones"))
    fixed = counted.groupBy("card", "feature").agg(
        F.sum("n").alias("n"), F.sum("ones").alias("ones"), F.bool_and((F.col("ones") == 0) | (F.col("ones") == F.col("n"))).alias("fixes"))
    whole = F.col("feature") == ""
    found = fixed.groupBy("card").agg(
        F.max(F.when(whole, F.col("n"))).alias("n"), F.max(F.when(whole, F.col("ones"))).alias("positives"),
        F.array_sort(F.collect_list(F.when(~whole & F.col("fixes"), F.col("feature")))).alias("leaks"))
    # a card without rows has no cells but is still a card
    names = long.sparkSession.createDataFrame([(c.name,) for c in cards], "card string")
    return names.join(found, "card", "left").select(
        "card", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("positives", F.lit(0)).alias("positives"),
        F.coalesce("leaks", F.array().cast("array<string>")).alias("leaks"))


def model_card(
    name: str,
    rows: DataFrame,
    label: str,
    features: list[str],
    classifier=None,
    job: str = "training",
    runs: DataFrame | None = None,
    prefix: str | None = None,
    least_positives: int = LEAST_POSITIVES,
    facts: DataFrame | None = None,
) -> DataFrame:
    """One card, computed from labelled rows, feature columns, the classifier and the run history.

    ``facts`` is a ``card_facts`` table that several cards share.

    A model without a classifier or with too few positive rows is paused. One with a feature that fixes the
    label by itself is for demonstration only. Labels are 0 and 1; rows without a label are left out.
    """
    if facts is None:
        facts = card_facts([CardRows(name, rows, label, features)])
    facts = facts.where(F.col("card") == name)
    few = F.col("positives") < least_positives
    leaky = F.size("leaks") > 0
    logged = runs_json(runs, prefix).scalar() if runs is not None and prefix else F.lit(None).cast("string")
    limits = F.concat_ws(
        " ",
        F.when(leaky, F.concat(F.lit("The label follows from "), F.array_join("leaks", ", "), F.lit(" alone.")))
        .otherwise("No feature fixes the label alone."),
        F.when(few, F.concat(F.lit("Fewer than "), F.lit(str(least_positives)), F.lit(" positive rows."))),
    )
    status = (
        F.when(F.lit(classifier is None) | few, "paused").when(leaky, "demo_only").otherwise("production_candidate")
    )
    return facts.select(
        F.lit(name).alias("model_name"),
        F.lit(job).alias("notebook"),
        F.concat(F.lit(f"Predict {label} from {len(features)} columns.")).alias("objective"),
        F.concat(F.lit(f"{label}: "), F.col("positives").cast("string"), F.lit(" of "), F.col("n").cast("string"),
                 F.lit(" rows are positive.")).alias("target_definition"),
        F.lit(", ".join(features)).alias("feature_summary"),
        F.lit(_parameters(classifier)).alias("algorithm"),
        F.coalesce(logged, F.lit('{"status":"not_logged"}')).alias("metrics_json"),
        limits.alias("limitations"),
        status.alias("status"),
    )


def model_cards(cards: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, cards)
