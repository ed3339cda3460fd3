"""Structured Streaming jobs (Z1, Z2): the batch operators applied to streams.

The URL feature library and the verdict rules are stateless column
expressions, so a streaming scorer is the batch plan over ``readStream``.
The windowed verdict count has two forms: event-time windows with a watermark, whose state
is bounded by the delay and which refuse rows that come later, and mergeable
counts of every micro-batch, which keep late rows (marked as such) and hold no state.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.url import with_url_features
from ..operators.score import THRESHOLD, verdict, with_verdict
from ..session import ensure_checkpoint_dir

WINDOW = "1 hour"


class LateRowsError(RuntimeError):
    """A bounded replay met rows later than the watermark delay, and Spark dropped them."""


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema=None, max_files: int | None = None):
    """``readStream`` over one driver table, a file or a folder of part files.

    ``max_files`` bounds the files of one micro-batch (default: Spark's, no bound).
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a pattern that only this path matches: Spark takes a pattern for a file as well as for a folder
    return reader.parquet(f"{path[:-1]}[t]")


def score_stream(urls: DataFrame, fitted, keep: list[str]) -> DataFrame:
    """Stream of URLs -> features -> model -> verdict columns (stateless)."""
    feats = with_url_features(urls, "url")
    return with_verdict(fitted.score(feats, keep)).select(*keep, "verdict", "probability", "risk_score", "risk_band", "p_phishing")


def run_available_now(stream_df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> int:
    """Drain everything available into a parquet sink, exactly once (checkpointed).
    Returns how many (partially aggregated) rows the watermark dropped."""
    return _drain(stream_df.writeStream.format("parquet").option("path", sink)
                  .option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True), stream_df.sparkSession)


def run_update_available_now(stream_df: DataFrame, sink: str, checkpoint: str) -> int:
    """Drain a stateful aggregation in update mode: every micro-batch appends
    its changed rows tagged with the batch id (a retried batch rewrites the
    same rows with the same id, so reading the latest row per key is exact).
    Returns how many (partially aggregated) rows the watermark dropped."""
    def write(batch_df, batch_id):
        batch_df.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(sink)

    return _drain(stream_df.writeStream.outputMode("update").foreachBatch(write)
                  .option("checkpointLocation", checkpoint).trigger(availableNow=True), stream_df.sparkSession)


def _drain(writer, spark: SparkSession) -> int:
    """Run a query over all that is available; the rows dropped by its watermark."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    kept = spark.conf.get(key)
    spark.conf.set(key, "1000000")  # the progress of every micro-batch, not only of the last hundred
    try:
        q = writer.start()
        q.awaitTermination()
        return sum(int(s["numRowsDroppedByWatermark"]) for p in q.recentProgress for s in p["stateOperators"])
    finally:
        spark.conf.set(key, kept)


def latest_per_key(df: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """Final state of an update-mode sink: the row of the highest batch per key."""
    return df.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in value_cols])


def event_scores(events: DataFrame) -> DataFrame:
    """Score of an event for the windowed-verdict demo: value / 100 capped at 1."""
    return events.select("ts", F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).alias("p"))


def windowed_verdicts(events: DataFrame, window: str = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """Z2 (batch twin): verdict counts per tumbling event-time window."""
    s = event_scores(events)
    agg = s.groupBy(F.window("ts", window).alias("w"), verdict(F.col("p"), threshold).alias("verdict")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "verdict", "n")


def keep_late_available_now(events: DataFrame, delay: str, sink: str, checkpoint: str, window: str = WINDOW) -> None:
    """Drain ``events`` into window counts of each micro-batch, late rows included.

    A batch writes its own folder, so a repeated batch replaces itself. Rows whose
    window had ended more than ``delay`` before the latest event of the earlier
    batches are ``late``; they are counted like others and merged by key.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        latest = batch.agg(F.max("ts").alias("latest"))
        written_latest(latest, number)
        seen = spark.read.schema("latest timestamp, batch long").parquet(f"{sink}-latest").where(F.col("batch") < number).agg(F.max("latest")).first()[0]
        counts = windowed_verdicts(batch, window)
        behind = F.lit(False) if seen is None else F.col("window_end") <= F.lit(seen) - F.expr(f"INTERVAL {delay}")
        counts.withColumn("late", behind).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    def written_latest(latest: DataFrame, number: int) -> None:
        latest.select(F.col("latest").cast("timestamp")).write.mode("overwrite").parquet(f"{sink}-latest/batch={number}")

    _drain(events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True), spark)


def folded(partials: DataFrame) -> DataFrame:
    """Counts of micro-batches -> one row a window and verdict; ``n_late`` of its rows came late."""
    return partials.groupBy("window_start", "window_end", "verdict").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("n_late"))


def windowed_verdicts_keeping_late(spark: SparkSession, sf_dir: str, delay: str, window: str = WINDOW, max_files: int | None = None) -> DataFrame:
    """Z2 for input of any disorder: equal to the batch twin, with the number of late rows of each window."""
    ev = stream_table(spark, sf_dir, "events", max_files=max_files)
    sink, ckpt = _scratch(spark, "windows"), _scratch(spark, "windows-ckpt")
    keep_late_available_now(ev, delay, sink, ckpt, window)
    kind = dict(ev.dtypes)["ts"]
    schema = f"window_start {kind}, window_end {kind}, verdict string, n long, late boolean, batch long"
    return folded(spark.read.schema(schema).parquet(sink))


def windowed_verdicts_stream(spark: SparkSession, sf_dir: str, delay: str, window: str = WINDOW,
                             mode: str = "update", max_files: int | None = None) -> DataFrame:
    """The same counts computed by a watermarked streaming aggregation.

    ``delay`` is how late an event may come: at least the disorder of the
    input. The result equals the batch twin only if no row is later than that;
    a later row raises :class:`LateRowsError` instead of going missing.
    ``mode='update'`` (default) writes every changed window per micro-batch
    and returns the final count per window, so windows still open when the
    input ends are included. ``mode='append'`` emits a window only once the
    watermark passes its end. State is bounded by the delay in both modes.
    """
    ev = stream_table(spark, sf_dir, "events", max_files=max_files)
    ntz = dict(ev.dtypes)["ts"] == "timestamp_ntz"
    if ntz:
        # Watermarks need an instant: read the wall-clock time as UTC so the
        # hour windows line up with the batch twin whatever the session zone.
        ev = ev.withColumn("ts", F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))
    counts = windowed_verdicts(ev.withWatermark("ts", delay), window)
    if ntz:
        back = {c: F.from_utc_timestamp(F.col(c), F.current_timezone()).cast("timestamp_ntz")
                for c in ("window_start", "window_end")}
        counts = counts.withColumns(back)
    sink, ckpt = _scratch(spark, "windowed_verdicts"), _scratch(spark, "windowed_verdicts-ckpt")
    run = run_available_now if mode == "append" else run_update_available_now
    dropped = run(counts, sink, ckpt)
    if dropped:
        raise LateRowsError(f"{dropped} aggregated row(s) came more than {delay} late; use a longer delay")
    if mode == "append":
        return spark.read.parquet(sink)
    return latest_per_key(spark.read.parquet(sink), ["window_start", "window_end", "verdict"], ["n"])
