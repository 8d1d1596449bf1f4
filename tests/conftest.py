import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loglattice.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.hadoop.javax.jdo.option.ConnectionURL": f"jdbc:derby:;databaseName={base}/metastore;create=true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Make a small Silver-like frame; fields left out are NULL."""
    schema = (
        "event_id string, event_timestamp timestamp_ntz, event_date date, event_hour int, service string, log_level string, "
        "instance_id string, status_code int, response_time double, kafka_topic string, is_anomaly int, "
        "severity_score int, response_category string, http_method string, user_id string"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def make(*rows):
        filled = []
        for i, row in enumerate(rows):
            base = {"event_id": str(i), "service": "a", "log_level": "INFO", "is_anomaly": 0, "kafka_topic": "t"}
            filled.append(tuple({**base, **row}.get(n) for n in names))
        return spark.createDataFrame(filled, schema)

    return make
