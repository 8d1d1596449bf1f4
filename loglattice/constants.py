"""Fixed values of the log model: names, thresholds and patterns that results depend on."""

# --- levels and scores (fixed values) ---
LEVEL_SEVERITY = {"INFO": 1, "WARNING": 2, "ERROR": 3, "CRITICAL": 4}
UNKNOWN_SEVERITY = 0
FAST_BELOW_SECONDS = 0.2
NORMAL_BELOW_SECONDS = 0.5
NOT_MEASURED = "Not Measured"

HEALTHY_BELOW_PERCENT = 1.0
DEGRADED_BELOW_PERCENT = 5.0

RISK_ERROR_WEIGHT = 0.5
RISK_ANOMALY_WEIGHT = 0.3
RISK_LATENCY_WEIGHT = 0.2
RISK_LATENCY_SCALE = 20.0

SCORING_FLOOR_LINES = 100
MIN_DATES_FOR_DAILY_AXIS = 5

EVENT_CRITICAL_LATENCY = 0.6
EVENT_DEGRADING_LATENCY = 0.35

# --- sentinels (fixed values; the marker's spelling is part of the data contract) ---
FEATURE_SENTINELS = {"http_method": "NO_HTTP", "http_path": "NO_PATH", "status_code": -1, "response_time": -1.0}
HEALTH_MARKER = "UNKOWN"
HEALTH_MARKER_COLUMNS = ["instance_id", "request_id", "user_id", "project_id", "client_ip", "http_method", "http_path"]
HEALTH_SENTINELS = {"status_code": -1, "response_time": 0.0}

# --- column sets (fixed values) ---
FEATURE_DROPS = ["event_id", "dataset_source", "timestamp", "event_timestamp", "event_date"]
ANOMALY_MODEL_DROPS = [
    "request_id", "instance_id", "user_id", "project_id", "client_ip", "http_path", "message", "kafka_offset",
    "kafka_timestamp", "ingestion_timestamp", "kafka_partition", "kafka_topic", "process_id",
]
HEALTH_MODEL_DROPS = [
    "event_id", "timestamp", "message", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingestion_timestamp",
]
CATEGORICAL_FEATURES = ["service", "log_file", "log_level", "http_method", "response_category"]
ANOMALY_NUMERIC_FEATURES = [
    "status_code", "response_time", "event_hour", "event_day", "event_month", "event_weekday", "is_weekend",
    "instance_exists",
]
HEALTH_NUMERIC_FEATURES = [
    "status_code", "response_time", "event_hour", "event_month", "event_year", "day_of_week", "hour", "month",
    "is_weekend", "severity_score",
]

# --- raw line patterns (fixed values, Java regex, positional groups) ---
# file (its base name where it has one, else whole), timestamp, pid, level, service, optional [context], rest
HEADER = (
    r"(?s)^(?:([\w\-]+?\.log)\S*|(\S+))\s+(\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}\.\d+)\s+(\d+)\s+([A-Z]+)\s+"
    r"(\S+)\s*(?:\[(?!instance:)([^\]]*)\]\s*)?(.*)$"
)
# the same header, but any bracket after the service counts as the context
HEADER_ANY_BRACKET = HEADER.replace("(?!instance:)", "")
# ip list, method, path, optional status, len and time; what follows is ignored
HTTP_REQUEST = (
    r'(?s)^([\d.,]+)\s+"([A-Z]+)\s+(\S+)\s+HTTP/[\d.]+"\s*(?:status:\s*(\d+))?\s*(?:len:\s*\d+)?\s*'
    r"(?:time:\s*([\d.]+))?.*$"
)
HTTP_LITERAL = "HTTP/"
INSTANCE_LITERAL = "[instance:"
INSTANCE_TAG = r"\[instance:\s*[0-9a-f\-]{36}\]"
INSTANCE_ID = r"\[instance:\s*([0-9a-f\-]{36})\]"
LOG_FILE_BASE = r"^([\w\-]+?\.log)"
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
WHITESPACE = " \t\n\r\f\x0b"

DATASET_SOURCE = "OpenStack"
LABEL_HEADING = "The following"

# --- grounding of written text (fixed values) ---
STRUCTURAL_NUMBERS = ["100", "0", "1", "2", "3", "4", "5", "95", "50", str(SCORING_FLOOR_LINES)]
NUMBER = r"\d[\d,]*\.?\d*"

# --- model settings (fixed values) ---
SEED = 42
TRAIN_PERCENT = 80
MAJORITY_PER_MINORITY = 5

# The parameter grids of the health model search.
SEARCH_GRIDS = {
    "logistic_regression": {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
    "decision_tree": {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 5, 10]},
    "random_forest": {"numTrees": [50, 100], "maxDepth": [5, 10]},
}
# A search of up to SEARCH_ROWS rows has a partition for each SEARCH_SMALL_ROWS_PER_TASK of that number, a larger one
# at least as many and one per SEARCH_ROWS_PER_TASK rows, up to SEARCH_TASKS: a fit runs a task per partition in each of its iterations.
SEARCH_ROWS = 20_000
SEARCH_SMALL_ROWS_PER_TASK = 10_000
SEARCH_ROWS_PER_TASK = 50_000
SEARCH_TASKS = 1000
