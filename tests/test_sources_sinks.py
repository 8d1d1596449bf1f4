import pytest
from pyspark.sql import functions as F

from loglattice.schemas import LABELS
from loglattice.session import checkpoint_dir, cut_lineage
from loglattice.sinks import tables as W
from loglattice.sources import readers as R
from loglattice.sources.decode import encode_series


def test_kafka_options():
    plain = R.kafka_options("h:1", ["a", "b", "c"])
    assert plain == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b,c", "startingOffsets": "earliest"}
    secure = R.kafka_options("h:1", ["a"], "me", "secret", "/x/ca.pem", extra={"failOnDataLoss": "false"})
    assert secure["kafka.security.protocol"] == "SASL_SSL" and secure["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="me" password="secret";' in secure["kafka.sasl.jaas.config"]
    assert secure["kafka.ssl.truststore.type"] == "PEM" and secure["failOnDataLoss"] == "false"


def test_label_file(spark, tmp_path):
    (tmp_path / "labels.txt").write_text("The following are anomalous\n\nid-1\n  \nid-2\n")
    assert [r.instance_id for r in R.read_labels(spark, str(tmp_path / "labels.txt")).collect()] == ["id-1", "id-2"]


def test_series_to_messages(spark, tmp_path):
    (tmp_path / "s.csv").write_text("timestamp,value\n2021-07-08 00:00:00,4.5\n2021-07-08 00:00:01,-3\n")
    rows = encode_series(R.read_series(spark, str(tmp_path / "s.csv")), "k").collect()
    assert [tuple(r) for r in rows] == [("k", '{"2021-07-08 00:00:00":4.5}'), ("k", '{"2021-07-08 00:00:01":-3.0}')]


def test_layer_tables(spark, tmp_path):
    one = W.rows_to_df(spark, [(1, "a")], "n int, s string")
    W.write_layer(one, "layer_x")
    W.append_layer(one, "layer_x")
    assert R.read_layer(spark, "layer_x").count() == 2
    W.write_layer(one.withColumn("extra", F.lit(1)), "layer_x", replace_schema=True)
    assert R.read_layer(spark, "layer_x").columns == ["n", "s", "extra"]
    described = R.describe_table(spark, "layer_x", "default").collect()
    assert [(r.column_name, r.data_type) for r in described] == [("n", "int"), ("s", "string"), ("extra", "int")]
    with pytest.raises(ValueError):
        R.describe_table(spark, "other.layer_x", "default")
    spark.sql("DROP TABLE layer_x")

    path = str(tmp_path / "layer")
    W.write_layer(one, path, partition_by=["s"])
    W.append_layer(one.select("n", "s"), path + "/s=a")
    assert R.read_layer(spark, path).where("s = 'a'").count() == 2


def test_ddl_views_and_missing_tables(spark):
    W.ensure_table(spark, "made_once", LABELS)
    W.ensure_table(spark, "made_once", "other int")
    assert spark.table("made_once").columns == ["instance_id"]
    W.create_view(spark, "made_view", "SELECT count(*) AS n FROM made_once")
    W.create_view(spark, "made_view", "SELECT count(*) AS rows FROM made_once")
    assert spark.table("made_view").columns == ["rows"]
    assert W.register_views({"v_one": spark.range(3)}) == ["v_one"] and spark.table("v_one").count() == 3
    assert R.read_or_empty(spark, "v_one").count() == 3
    empty = R.read_or_empty(spark, "no_such_table", LABELS)
    assert empty.columns == ["instance_id"] and empty.count() == 0
    spark.sql("DROP VIEW made_view")
    spark.sql("DROP TABLE made_once")


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert cut_lineage(spark.range(5)).count() == 5
