"""Streaming forms of the batch operators. State is always bounded by a watermark on event time."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from loglattice import constants as C
from loglattice.functions import scalars as S
from loglattice.operators.dedupe import dedupe
from loglattice.operators.joins import attach_labels
from loglattice.plans.silver import enrich
from loglattice.streaming.idindex import BROADCAST_IDS, IdIndex, append_unseen, stored

TIME = "event_timestamp"


def watermarked(stream: DataFrame, delay: str = "10 minutes", ts: str = TIME) -> DataFrame:
    """Set the watermark. Watermarks need a timestamp with a zone, so one without is cast first."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedupe_stream(stream: DataFrame, delay: str = "10 minutes", key: str = "event_id", ts: str = TIME) -> DataFrame:
    """First arrival of each id among events no further apart than the delay; rows without an id are left out."""
    return watermarked(stream.where(F.col(key).isNotNull()), delay, ts).dropDuplicatesWithinWatermark([key])


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("log_lines"),
        S.level_count("ERROR").alias("errors"),
        S.level_count("WARNING").alias("warnings"),
        S.level_count("CRITICAL").alias("critical"),
        F.count("status_code").alias("http_requests"),
    ]


def windowed_trend(
    stream: DataFrame,
    delay: str = "10 minutes",
    width: str = "1 hour",
    slide: str | None = None,
    by: list[str] | None = None,
    ts: str = TIME,
) -> DataFrame:
    """Level counts per tumbling (or sliding) window, written once the watermark has passed its end."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = watermarked(stream, delay, ts).groupBy(window.alias("w"), *(by or [])).agg(*_counts())
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *[c for c in counted.columns if c != "w"])


_COUNTED = ["log_lines", "errors", "warnings", "critical", "http_requests"]


def start_trend(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    slide: str | None = None,
    by: list[str] | None = None,
    ts: str = TIME,
) -> StreamingQuery:
    """Store each micro-batch's counts per window, then stop when the stream is drained.

    Counts add up, so ``read_trend`` has every window at any time: open ones with what has arrived, and late
    rows in the hour they belong to. There is no state and no watermark. A batch that is run again overwrites
    its own counts; another checkpoint writes beside them.
    """
    window = F.window(F.col(ts).cast("timestamp"), width, slide or width)
    run = _run_of(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(window.alias("w"), *(by or [])).agg(*_counts())
        flat = counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                              *(by or []), *_COUNTED)
        flat.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_trend(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    keys = ["window_start", "window_end", *(by or [])]
    return spark.read.parquet(path).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _COUNTED])


def start_windows(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    width: str = "1 hour",
    slide: str | None = None,
    by: list[str] | None = None,
    ts: str = TIME,
) -> StreamingQuery:
    """Watermarked windows in update mode: every micro-batch stores the windows it changed, open ones too.

    ``read_windows`` takes the latest state of each window, so a provisional count is overwritten by its key, and what
    the watermark has closed is final. The watermark bounds the state; a row that comes after its window was
    closed is not counted, and ``late_rows`` says how many those were. Each micro-batch observes how many rows it took in.
    A batch that is run again overwrites its own folder.
    """
    run = _run_of(checkpoint)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    # An event time is needed for a window, so rows without one are neither counted nor late.
    timed = watermarked(stream, delay, ts).where(F.col(ts).isNotNull()).observe(SEEN, F.count(F.lit(1)).alias("rows"))
    counted = timed.groupBy(window.alias("w"), *(by or [])).agg(*_counts())
    flat = counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *(by or []), *_COUNTED)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("version", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")

    return (
        flat.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


SEEN = "windowed_rows"


def read_windows(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """The latest state of every window of one run."""
    keys = ["window_start", "window_end", *(by or [])]
    latest = F.max_by(F.struct(*_COUNTED), "version").alias("latest")
    return spark.read.parquet(path).groupBy(*keys).agg(latest).select(*keys, "latest.*")


def rows_seen(query: StreamingQuery) -> int:
    """How many rows with an event time a drained run of ``start_windows`` took in."""
    metrics = [p.observedMetrics.get(SEEN) for p in query.recentProgress]
    return sum(m["rows"] for m in metrics if m is not None)


def late_rows(query: StreamingQuery, windows: DataFrame, per_row: int = 1) -> DataFrame:
    """One row: rows taken in, rows counted in some window, and the late ones, which are in none.

    ``per_row`` is the number of windows that a row belongs to. For a run from an empty checkpoint.
    """
    seen = F.lit(rows_seen(query)).cast("long")
    counted = F.coalesce(F.sum("log_lines"), F.lit(0)) / per_row
    return windows.agg(seen.alias("rows_seen"), counted.cast("long").alias("rows_counted"), (seen - counted.cast("long")).alias("late_rows"))


def start_sessions(
    stream: DataFrame, path: str, checkpoint: str, by: str = "service", ts: str = TIME
) -> StreamingQuery:
    """Store each micro-batch's level counts per event time and group, of which ``read_sessions`` makes bursts.

    Counts add up, so late rows join, lengthen or unite the bursts they belong to, and open bursts are there.
    """
    run = _run_of(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        at = F.col(ts).cast("timestamp").alias("at")
        batch.where(F.col(ts).isNotNull()).groupBy(at, by).agg(*_counts()).write.mode("overwrite").parquet(
            f"{path}/run={run}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_sessions(spark: SparkSession, path: str, gap: str = "5 minutes", by: str = "service") -> DataFrame:
    cells = spark.read.parquet(path)
    summed = cells.groupBy(F.session_window("at", gap).alias("w"), by).agg(*[F.sum(c).alias(c) for c in _COUNTED])
    return summed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, *_COUNTED)


def session_trend(stream: DataFrame, gap: str = "5 minutes", delay: str = "10 minutes", by: str = "service", ts: str = TIME
                  ) -> DataFrame:
    """Level counts per burst of lines of one service, ended by a gap without lines."""
    counted = watermarked(stream, delay, ts).groupBy(F.session_window(ts, gap).alias("w"), by).agg(*_counts())
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *[c for c in counted.columns if c != "w"])


def label_stream(stream: DataFrame, labels: DataFrame) -> DataFrame:
    """Stream-static join with the label list; stateless."""
    return attach_labels(stream, labels)


def error_alerts(stream: DataFrame, percent: float = C.DEGRADED_BELOW_PERCENT, delay: str = "10 minutes", ts: str = TIME
                 ) -> DataFrame:
    """Service-hours whose error rate reaches a percentage, once the hour is complete."""
    return alerts_of(windowed_trend(stream, delay, by=["service"], ts=ts), percent)


def alerts_of(hourly: DataFrame, percent: float = C.DEGRADED_BELOW_PERCENT) -> DataFrame:
    """Service-hours of a trend whose error rate reaches a percentage."""
    rate = S.percent(F.col("errors"), F.col("log_lines"))
    return (
        hourly.withColumn("error_rate", F.round(rate, 2))
        .where(rate >= percent)
        .select("window_start", "service", "log_lines", "errors", "error_rate", S.health_band(rate).alias("health_status"))
    )


def defect() -> Column:
    """Why a decoded event cannot go to Silver; NULL for one that can. Batch Silver has the same gate."""
    return F.when(F.col("event_id").isNull(), F.lit("undecodable"))


def doubt() -> Column:
    """What is odd about an event that Silver keeps; NULL for a regular one."""
    return (
        F.when(F.try_to_timestamp("timestamp").isNull(), F.lit("no timestamp"))
        .when(F.col("service").isNull(), F.lit("no service"))
        .when(~F.coalesce(F.col("log_level").isin(*C.LEVEL_SEVERITY), F.lit(False)), F.lit("unknown level"))
    )


def quality_gate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events for Silver, and the rest with their reason."""
    checked = df.withColumn("reason", defect())
    return checked.where(F.col("reason").isNull()).drop("reason"), checked.where(F.col("reason").isNotNull())


COORDINATES = ["kafka_topic", "kafka_partition", "kafka_offset"]


def _append_new(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose keys are not stored; NULL-safe, so that no coordinate is lost.

    The rows' keys go to the stored ones; those they meet come back.
    """
    if rows.isEmpty():
        return
    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    held = stored(rows.sparkSession, path, types)
    if held is not None:
        def same(other: str) -> Column:
            return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys])

        asked = rows.select(*[F.col(k).alias(f"_asked_{k}") for k in keys])
        few = asked.count() <= BROADCAST_IDS
        met = held.join(F.broadcast(asked) if few else asked, same("_asked_"), "left_semi")
        rows = rows.join(met.select(*[F.col(k).alias(f"_known_{k}") for k in keys]), same("_known_"), "left_anti")
    rows.write.mode("append").parquet(path)


def index_of(path: str) -> IdIndex:
    """The id index that stands beside a table."""
    return IdIndex(f"{path.rstrip('/')}__ids")


def silver_writer(
    labels: DataFrame, silver_path: str, quarantine_path: str, index: IdIndex | None = None, run: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch function for ``foreachBatch``: gate, deduplicate within and across batches, derive, label, append.

    Only ids that Silver does not hold yet are appended, whatever the batch number and however far apart the repeats.
    So a batch that is run again, or a run with a new checkpoint, neither repeats nor loses a row. Silver itself
    is not read: its ids stand in an index, of which a batch reads the buckets of its own ids.
    """
    index, run = index or index_of(silver_path), run or uuid.uuid4().hex[:16]
    prepared = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not prepared:
            index.prepare(spark, stored(spark, silver_path, "event_id string"))
            prepared.append(True)
        batch.persist()
        try:
            good, bad = quality_gate(batch)
            append_unseen(good, lambda new: attach_labels(enrich(dedupe(new)), labels), index, f"{run}-{batch_id}", silver_path,
                          partition_by="event_date")
            keys = [c for c in COORDINATES if c in bad.columns] or [c for c in bad.columns if c != "ingestion_timestamp"]
            _append_new(bad, quarantine_path, keys)
        finally:
            batch.unpersist()

    return write


def _run_of(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def start_silver(
    bronze: DataFrame, labels: DataFrame, silver_path: str, quarantine_path: str, checkpoint: str, index: IdIndex | None = None
) -> StreamingQuery:
    """Keep Silver up to date from a stream of decoded events, then stop when it is drained."""
    return (
        bronze.writeStream.foreachBatch(silver_writer(labels, silver_path, quarantine_path, index, _run_of(checkpoint)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_distinct(
    stream: DataFrame, path: str, checkpoint: str, key: str = "event_id", index: IdIndex | None = None
) -> StreamingQuery:
    """Store the first arrival of each id, however far apart its repeats are, then stop when the stream is drained.

    There is no watermark and no state: what has been seen stands in the id index beside the table. Rows without
    an id are left out.
    """
    index, run, prepared = index or index_of(path), _run_of(checkpoint), []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not prepared:
            index.prepare(batch.sparkSession, stored(batch.sparkSession, path, f"{key} string"), key)
            prepared.append(True)
        batch.persist()
        try:
            append_unseen(batch, lambda new: dedupe(new, key), index, f"{run}-{batch_id}", path, key)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet until its source has nothing more."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
