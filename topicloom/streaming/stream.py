"""Structured Streaming variants of the daily batch (STR-01..04).

* STR-01 incremental preprocess: ``readStream`` over landed raw files with an
  explicit schema, the same row-level column functions as the batch job.
* STR-02 stateful dedup on a key within an event-time horizon: ``horizon.dedup_horizon``,
  decided in event-time order; ``dedup_within`` is Spark's own, in order of arrival.
* STR-03 sliding-window counts with a watermark (late rows beyond it drop and are
  counted), emitted in update mode and upserted by ``foreachBatch`` (latest batch wins).
* STR-04 stateless scoring of a stream against a fitted topic model.

Sinks written by ``foreachBatch`` put each micro-batch into the folder of its batch id
and replace it: a batch that is replayed after a failure changes nothing.

Every query runs with ``trigger(availableNow=True)``; sinks and checkpoints live
under the session's shared checkpoint folder (``spark.checkpoint.dir``), never
on a machine-local path and never in a driver-side memory sink.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from topicloom.session import checkpoint_dir
from topicloom.sources.sinks import write_partitioned


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:10]}"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, file_glob: str | None = None, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Landed parquet files as a stream (explicit schema, no inference).  A micro-batch takes
    ``max_files`` files at most, or -- as many small files as it takes -- about ``max_bytes``."""
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(path)


def event_time(col: str) -> F.Column:
    """Watermarks need TIMESTAMP; benchmark tables carry TIMESTAMP_NTZ holding a
    UTC wall clock.  Shift it to the session zone's wall clock first, so the cast
    yields the right instant whatever ``spark.sql.session.timeZone`` is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(col)).cast("timestamp")


def dedup_within(df: DataFrame, keys: list[str], ts_col: str, horizon: str = "3 days") -> DataFrame:
    """STR-02: drop repeats of ``keys`` seen within ``horizon`` of event time."""
    return df.withWatermark(ts_col, horizon).dropDuplicatesWithinWatermark(keys)


def window_counts(df: DataFrame, ts_col: str, key: str, size: str = "3 days", slide: str = "1 day", lateness: str = "3 days") -> DataFrame:
    """STR-03: rows per (sliding window, key); rows later than ``lateness`` are dropped."""
    rows = df.observe("input", F.count(F.lit(1)).alias("rows"), F.sum(window_rows(ts_col, size, slide)).alias("window_rows"))
    w = rows.withWatermark(ts_col, lateness).groupBy(F.window(ts_col, size, slide).alias("w"), F.col(key))
    return w.agg(F.count(F.lit(1)).alias("count")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "count"
    )


def _run(df: DataFrame, checkpoint: str, mode: str, write) -> list:
    """Run a stream to the end of the available input; the progress of its micro-batches."""
    q = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return list(q.recentProgress)


def batch_writer(out_path: str):
    """A ``foreachBatch`` function: batch n becomes the folder ``_batch=n``, written anew
    whenever the batch is run.  An empty batch writes nothing, and clears what a run
    of the same batch may have left."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/_batch={batch_id}")

    return write


def run_append(df: DataFrame, out_path: str, checkpoint: str) -> list:
    """Append-mode stream to a parquet table, each row once; its progress."""
    return _run(df, checkpoint, "append", batch_writer(out_path))


def run_upsert(df: DataFrame, out_path: str, checkpoint: str) -> list:
    """Update-mode stream; a micro-batch's changed rows are kept with their batch id."""
    return _run(df, checkpoint, "update", batch_writer(out_path))


def day_writer(out_path: str):
    """A ``foreachBatch`` function for a table partitioned by day: a day's rows of batch n
    go to ``ds=<day>/_batch=n`` and replace what an earlier run of the batch wrote there."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_partitioned(batch.withColumn("_batch", F.lit(batch_id)), out_path, ["ds", "_batch"], skip_empty=False)

    return write


def run_days(df: DataFrame, out_path: str, checkpoint: str) -> list:
    """STR-01 / SNK-01: append-mode stream into a table partitioned by ``ds``."""
    return _run(df, checkpoint, "append", day_writer(out_path))


def read_rows(spark: SparkSession, out_path: str, schema: T.StructType) -> DataFrame:
    """The rows of a stream's table, without the batch ids; none if no batch wrote any."""
    try:
        return spark.read.schema(schema).parquet(out_path).select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def window_rows(ts_col: str, size: str, slide: str) -> F.Column:
    """How many sliding windows a row falls into (slide divides size); none without a time."""
    n = F.expr(f"cast(round((unix_micros(timestamp_micros(0) + interval {size})) / (unix_micros(timestamp_micros(0) + interval {slide}))) as long)")
    return F.when(F.col(ts_col).isNotNull(), n).otherwise(F.lit(0))


def late_window_counts(spark: SparkSession, out_path: str, keys: list[str], progress: list) -> DataFrame:
    """(batch, rows_in, window_rows_in, window_rows_counted, window_rows_dropped) of the
    micro-batches with input: what the observed input amounts to in windows, how much
    the counts of the upserted table grew, and the difference -- dropped as late.

    ``progress`` holds one small entry a micro-batch."""
    seen = [(p.batchId, int(m["rows"]), int(m["window_rows"] or 0)) for p in progress if (m := (p.observedMetrics or {}).get("input")) and m["rows"]]
    batches = spark.createDataFrame(seen, "batch long, rows_in long, window_rows_in long")
    by = Window.partitionBy(*keys).orderBy("_batch")
    t = spark.read.parquet(out_path)
    grown = t.withColumn("more", F.col("count") - F.coalesce(F.lag("count").over(by), F.lit(0)))
    counted = grown.groupBy(F.col("_batch").cast("long").alias("batch")).agg(F.sum("more").alias("counted"))
    out = batches.join(counted, "batch", "left").withColumn("window_rows_counted", F.coalesce("counted", F.lit(0)).cast("long"))
    out = out.withColumn("window_rows_dropped", F.col("window_rows_in") - F.col("window_rows_counted"))
    return out.select("batch", "rows_in", "window_rows_in", "window_rows_counted", "window_rows_dropped")


def latest(spark: SparkSession, out_path: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """Current state of an upserted table: per key, the row of the latest batch."""
    try:
        t = spark.read.parquet(out_path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)  # no batch produced output
    cols = [c for c in t.columns if c != "_batch" and c not in keys]
    g = t.groupBy(*keys).agg(F.max_by(F.struct(*cols), "_batch").alias("_r"))
    return g.select(*keys, "_r.*")
