"""Typed schemas at the edges of the system."""

from pyspark.sql import types as T

EVENT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "event_id", "timestamp", "dataset_source", "log_file", "service", "process_id", "log_level", "request_id",
            "user_id", "project_id", "instance_id", "client_ip", "http_method", "http_path", "message",
        )
    ]
    + [T.StructField("status_code", T.IntegerType()), T.StructField("response_time", T.DoubleType())]
)

KAFKA_COORDINATES = T.StructType(
    [
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
    ]
)

BRONZE = T.StructType(
    EVENT.fields + KAFKA_COORDINATES.fields + [T.StructField("ingestion_timestamp", T.TimestampType())]
)

LABELS = T.StructType([T.StructField("instance_id", T.StringType())])

SERIES = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("value", T.DoubleType())])

NULL_PROFILE = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("total_rows", T.LongType(), False),
        T.StructField("null_count", T.LongType(), False),
        T.StructField("null_pct", T.DoubleType(), True),
        T.StructField("distinct_non_null", T.LongType(), False),
    ]
)

INSIGHT = T.StructType(
    [T.StructField(name, T.StringType(), name not in ("insight_id", "scope", "scope_key")) for name in (
        "insight_id", "scope", "scope_key", "headline", "narrative", "recommended_action", "severity", "evidence",
        "source_views", "generation_mode", "model_endpoint",
    )]
    + [T.StructField("generated_at", T.TimestampType())]
)

CANDIDATE = T.StructType([T.StructField("scope_key", T.StringType()), T.StructField("raw_text", T.StringType())])

MODEL_RUN = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

MODEL_CARD = T.StructType(
    [T.StructField(name, T.StringType()) for name in (
        "model_name", "notebook", "objective", "target_definition", "feature_summary", "algorithm", "metrics_json",
        "limitations", "status",
    )]
)
