"""Bronze to Silver, and the model-ready projections of Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglattice import constants as C
from loglattice.functions import scalars as S
from loglattice.operators.dedupe import dedupe, dedupe_any
from loglattice.operators.joins import attach_labels
from loglattice.sources.decode import split_undecodable


def with_event_timestamp(df: DataFrame, source: str = "timestamp") -> DataFrame:
    """Parse the text timestamp; text that is no timestamp gives NULL."""
    return df.withColumn("event_timestamp", F.try_to_timestamp(source))


def with_time_parts(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return df.withColumns(
        {
            "event_date": F.to_date(ts),
            "event_hour": F.hour(ts),
            "event_month": F.month(ts),
            "event_year": F.year(ts),
            "day_of_week": F.date_format(ts, "EEEE"),
        }
    )


def with_scores(df: DataFrame, compat: bool = False) -> DataFrame:
    null_label = None if compat else C.NOT_MEASURED
    return df.withColumns(
        {
            "severity_score": S.severity_score(F.col("log_level")),
            "response_category": S.response_category(F.col("response_time"), null_label),
        }
    )


def enrich(df: DataFrame, compat: bool = False) -> DataFrame:
    """Every derived Silver column but the label; narrow, so it also runs on streams."""
    return with_scores(with_time_parts(with_event_timestamp(df)), compat)


def build_silver(bronze: DataFrame, labels: DataFrame, compat: bool = False) -> DataFrame:
    """Deduplicate, derive and label. Rows without an id come from ``silver_and_quarantine``. ``compat`` keeps an arbitrary duplicate, lets undecodable
    rows collapse into one, and calls an unmeasured latency Slow."""
    unique = dedupe_any(bronze) if compat else dedupe(bronze)
    return attach_labels(enrich(unique, compat), labels)


def silver_and_quarantine(bronze: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Silver, and the rows it cannot hold because they have no id."""
    good, bad = split_undecodable(bronze)
    return build_silver(good, labels), bad


def feature_time(df: DataFrame, ts: str = "event_timestamp", compat: bool = False) -> DataFrame:
    """Hour, day, month, weekday and weekend flag. ``compat`` copies the hour into all four parts."""
    parts = {
        "event_hour": F.hour(ts),
        "event_day": F.hour(ts) if compat else F.dayofmonth(ts),
        "event_month": F.hour(ts) if compat else F.month(ts),
        "event_weekday": F.hour(ts) if compat else F.dayofweek(ts),
        "is_weekend": S.is_weekend(F.col(ts)),
    }
    return df.withColumns(parts)


def instance_exists(df: DataFrame) -> DataFrame:
    return df.withColumn("instance_exists", F.when(F.col("instance_id").isNull(), 0).otherwise(1))


def fill_sentinels(df: DataFrame) -> DataFrame:
    return df.fillna({k: v for k, v in C.FEATURE_SENTINELS.items() if k in df.columns})


def fill_health(df: DataFrame) -> DataFrame:
    """One marker for the missing identifiers, -1 for the status, and 0.0 for the latency."""
    marked = df.fillna(C.HEALTH_MARKER, subset=[c for c in C.HEALTH_MARKER_COLUMNS if c in df.columns])
    return marked.fillna(C.HEALTH_SENTINELS)


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def http_only(df: DataFrame) -> DataFrame:
    """Request lines with both a status and a latency."""
    return df.where(F.col("status_code").isNotNull() & F.col("response_time").isNotNull())


def feature_dataset(silver: DataFrame, compat: bool = False) -> DataFrame:
    """Event-grain feature table: one narrow projection, no shuffle."""
    return drop_columns(fill_sentinels(instance_exists(feature_time(silver, compat=compat))), C.FEATURE_DROPS)


def anomaly_model_frame(features: DataFrame) -> DataFrame:
    return drop_columns(features, C.ANOMALY_MODEL_DROPS)


def health_time(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Time parts of the health model; here ``day_of_week`` is a number, 1 for Sunday."""
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "month": F.month(ts),
            "is_weekend": S.is_weekend(F.col(ts)),
        }
    )


def service_health_label(df: DataFrame) -> DataFrame:
    return df.withColumn("service_health", S.event_health())


def health_dataset(silver: DataFrame) -> DataFrame:
    """Silver without its raw columns, with fills, time parts and the rule-based health."""
    return service_health_label(health_time(fill_health(drop_columns(silver, C.HEALTH_MODEL_DROPS))))


def health_model_rows(df: DataFrame) -> DataFrame:
    """The two-class problem: Critical events have no model label and are left out."""
    label = F.when(F.col("service_health").isin("Healthy", "Degrading"), F.col("service_health"))
    return df.withColumn("health_model_label", label).where(F.col("health_model_label").isNotNull())
