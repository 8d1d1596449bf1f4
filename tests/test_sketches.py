"""Stored sketches, digests, label dependencies, first splits, permuted columns and folds."""

import random
import re
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loglattice.ml import explain as X, metrics as M, prep, train as T
from loglattice.operators import audit as A, sketches as K

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def timed(spark, tmp_path_factory):
    """Requests of two services over some hours, and their stored cells."""
    path = str(tmp_path_factory.mktemp("cells") / "cells")
    rows = spark.range(60_000).select(
        F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("service"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 50_000).cast("timestamp_ntz").alias("event_timestamp"),
        F.lit(200).alias("status_code"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000).alias("response_time"),
    )
    K.latency_cells(rows).write.parquet(path)
    return rows.cache(), spark.read.parquet(path), path


def test_merged_quantiles_have_a_small_rank_error(timed):
    rows, cells, _ = timed
    for r in K.latency_quantiles(cells, "service", [0.05, 0.5, 0.95, 0.99]).collect():
        own = sorted(x.response_time for x in rows.where(F.col("service") == r.service).select("response_time").collect())
        for q in (0.05, 0.5, 0.95, 0.99):
            rank = sum(x <= r[f"q{round(100 * q)}"] for x in own) / len(own)
            assert abs(rank - q) < 0.01
    exact = rows.groupBy("service").agg(F.count(F.lit(1)), F.round(F.max("response_time"), 4)).collect()
    view = K.service_latency(cells).select("service", "request_count", "max_response_time").collect()
    assert sorted(map(tuple, exact)) == sorted(map(tuple, view))


def test_latency_views_read_the_cells_only(timed):
    _, cells, path = timed
    for view in (K.service_latency(cells), K.hourly_latency(cells)):
        text = plan(view)
        assert text.count("FileScan") == 1 and path in text and "response_time" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_adding_a_day_touches_that_day_only(spark, tmp_path):
    path = tmp_path / "profiles"
    days = spark.range(900).select(F.expr("date_add(date'2024-01-01', cast(id % 3 as int))").alias("event_date"), "id",
                                   F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("few"))
    days.write.partitionBy("event_date").parquet(str(tmp_path / "layer"))
    layer = spark.read.parquet(str(tmp_path / "layer"))
    K.store_day_profiles(layer.where("event_date < '2024-01-03'"), str(path))
    before = {f: f.stat().st_mtime_ns for f in Path(path).glob("profile_day=*/*.parquet")}
    last = layer.where("event_date = '2024-01-03'")
    assert re.search(r"PartitionFilters: \[.*2024-01-03", plan(K.day_profiles(last)))
    K.store_day_profiles(last, str(path))
    after = {f: f.stat().st_mtime_ns for f in Path(path).glob("profile_day=*/*.parquet")}
    assert before.items() <= after.items() and len(after) > len(before)
    got = {r.column_name: r for r in K.read_profiles(spark, str(path)).collect()}
    assert (got["few"].total_rows, got["few"].null_count, got["few"].distinct_estimate) == (900, 180, 7)
    assert abs(got["id"].distinct_estimate - 900) < 20


def test_profiles_by_digest_tell_values_apart(spark):
    rows = [(0.0, "a", [1, 2], None, b"x"), (-0.0, "A", [1], None, b""), (float("nan"), "a ", None, None, None), (None, None, [1, 2], None, b"x")]
    df = spark.createDataFrame(rows, "d double, s string, l array<int>, n string, b binary")
    got = {r.column_name: r.distinct_values for r in A.cardinality(df).collect()}
    assert got == {"d": 3, "s": 4, "l": 3, "n": 1, "b": 3}
    assert "hashpartitioning(i" in plan(A.cardinality(df))


def brute_dependencies(rows, label, features, most):
    found = []
    for size in range(1, most + 1):
        for s in combinations(features, size):
            if any(set(f) <= set(s) for f, _ in found):
                continue
            seen = {}
            for r in rows:
                seen.setdefault(tuple(r[c] for c in s), set()).add(r[label])
            if all(len(v) == 1 for v in seen.values()):
                found.append((s, len(seen)))
    return sorted(found)


def test_smallest_sets_that_fix_the_label(spark):
    draw = random.Random(1)
    rows = []
    for _ in range(400):
        a, b, c, d = draw.choice([0, 1, None]), draw.randrange(3), draw.randrange(2), draw.randrange(4)
        rows.append({"a": a, "b": b, "c": c, "d": d, "y": None if a is None and b == 1 else (a or 0) + b})
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, y int")
    got = sorted((tuple(r.features), r.distinct_values) for r in M.label_dependencies(df, "y", ["a", "b", "c", "d"]).collect())
    assert got == brute_dependencies(rows, "y", "abcd", 3) == [(("a", "b"), 9)]
    assert M.label_dependencies(df.where("a > 5"), "y", ["a"]).count() == 0


@pytest.fixture(scope="module")
def judged(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("event_id"), (F.col("id") % 24).alias("hour"), F.pmod(F.xxhash64("id"), F.lit(9)).alias("score"))
    return rows.withColumn("label", ((F.col("score") >= 6) | (F.pmod(F.xxhash64("event_id", F.lit(1)), F.lit(40)) == 0)).cast("int")).cache()


def test_first_split_is_the_tree_s(judged):
    features = ["hour", "score"]
    best = max(X.first_splits(X.class_histograms(judged, "label", features)).collect(), key=lambda r: r.gain)
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(judged)
    name, threshold, gain = T.root_split(T.decision_tree("label", depth=1).fit(vectors), vectors)
    assert (best.feature, best.threshold) == (name, threshold) == ("score", 5.5) and abs(best.gain - gain) < 1e-9


def test_shuffled_columns_keep_their_values_and_say_nothing(judged):
    dealt = X.shuffled(judged, "score", groups=3)
    assert sorted(map(tuple, dealt.groupBy("score").count().collect())) == sorted(map(tuple, judged.groupBy("score").count().collect()))
    again = X.shuffled(judged.repartition(7), "score", groups=3)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, again.collect()))
    rule = lambda df: df.withColumn("prediction", (F.col("score") >= 6).cast("int"))
    told = {r.feature: r.importance for r in X.permutation_importance(judged, rule, ["score", "hour"]).collect()}
    assert told["hour"] == 0 and told["score"] > 0.2


def test_folds_do_not_depend_on_partitions(judged):
    vectors = VectorAssembler(inputCols=["hour", "score"], outputCol="features").transform(prep.with_fold(judged))
    picked = []
    for parts in (2, 5):
        rows = vectors.select("features", F.col("label").cast("double").alias("label"), "fold").repartition(parts)
        grid = T.ParamGridBuilder().addGrid(T.decision_tree("label").getParam("maxDepth"), [1, 3]).build()
        picked.append([round(m, 9) for m in T.select_model("decision_tree", rows, weight=None, grid=grid).avgMetrics])
    assert picked[0] == picked[1]
    assert {r.fold for r in vectors.select("fold").distinct().collect()} == {0, 1, 2}
