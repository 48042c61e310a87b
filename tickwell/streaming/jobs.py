"""Structured Streaming jobs over tick and load streams.

Each ``*_stream`` function turns a streaming frame into a streaming frame;
``run`` starts it with a checkpoint in the shared folder.  Event times must be
``timestamp`` (a watermark on a zone-less column is rejected), so sources cast
with ``event_time``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickwell.functions.scalar import count_where, null_safe_join, percent, ratio, seconds_between
from tickwell.operators.bars import order_key
from tickwell.operators.filters import priced_trades
from tickwell.plans import ingest
from tickwell.session import remove_path, scratch_path
from tickwell.sinks import control_log, lake
from tickwell.sources import files


# --- sources -----------------------------------------------------------------------


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, timers: bool = False) -> SparkSession:
    """A session whose state is spread over the cluster's cores, with UTC clocks.

    Stateful streams fix their partition count at the first start and adaptive
    execution does not change it, so it is set here and not on the caller.
    Zone-less event times become UTC instants, whatever the caller's zone.
    Processors with ``timers`` need the state store that can list them.
    """
    own = spark.newSession()
    if timers:
        own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(max(spark.sparkContext.defaultParallelism, 1)))
    return own


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files as they arrive, from a folder or a single file.

    The source takes a lone file only through a pattern, so the last letter
    of the path becomes one.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def read_vendor_stream(spark: SparkSession, path: str, header: str, max_files: int | None = None) -> DataFrame:
    """Vendor CSV files as they arrive: text columns, broken lines flagged."""
    names = [h.strip() for h in header.split(",")]
    schema = ", ".join(f"`{n}` string" for n in [*names, files.CORRUPT])
    reader = (
        spark.readStream.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", files.CORRUPT).option("columnPruning", "false")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path).select("*", files.file_uri("_metadata.file_path").alias("source_file"))


def read_vendor_lines(spark: SparkSession, path: str, glob: str = "*.csv.gz", max_files: int | None = None) -> DataFrame:
    """Lines of vendor files as they arrive below ``path``, whatever their headers, for ``vendor_batches``."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def event_time(df: DataFrame, *columns: str) -> DataFrame:
    """Zone-less times as instants, as watermarks need them."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    """Instants back to zone-less times, inside the job and so in its zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- running -----------------------------------------------------------------------


def run(df: DataFrame, checkpoint: str, path: str | None = None, mode: str = "append",
        each_batch: Callable[[DataFrame, int], None] | None = None, every: str | None = None,
        name: str | None = None) -> StreamingQuery:
    """Start a job: to Parquet at ``path`` or through ``each_batch``.

    Without ``every`` it takes all files that are there and stops; with it
    (for instance ``"30 seconds"``) it keeps running.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    if each_batch:
        return writer.foreachBatch(each_batch).start()
    return writer.format("parquet").option("path", path).start()


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now job; a failed job raises."""
    query.awaitTermination()


# --- ingest ------------------------------------------------------------------------


def write_batch(table: str, audit: str | None = None) -> Callable[[DataFrame, int], None]:
    """A batch writer that may run twice for the same batch.

    Rows carry their batch number as a partition; a repeated batch replaces
    exactly its own partitions, whatever else shares the day.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("ingest_batch", F.lit(batch_id).cast("bigint"))
        lake.write_partitions(stamped, table, ("data_date", "exchange", "ingest_batch"))
        if audit:
            stored = batch.sparkSession.read.parquet(table).where(F.col("ingest_batch") == batch_id)
            row = control_log.audit_rows(stored, "stream_ingest", table, f"batch {batch_id}")
            lake.write_partitions(row.withColumn("ingest_batch", F.lit(batch_id).cast("bigint")), audit, ("ingest_batch",), ())
    return write


def vendor_batches(table: str, audit: str | None = None, counts: str | None = None, lateness: str = "10 minutes") -> Callable[[DataFrame, int], None]:
    """Parse each batch of vendor lines by the headers of its files and write it as ``write_batch`` does.

    ``counts`` gets one row per batch: processed, loaded, rejected and late
    rows, and the newest time of the batch.  A row is late when its time is
    ``lateness`` or more before the newest time of earlier batches.  Late rows
    are stored like others; ``late.repair`` mends what was derived before they came.
    """
    write_rows = write_batch(table, audit)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_rows(ingest.bronze_rows(files.parse_lines(batch)), batch_id)
        if not counts or not lake.exists(spark, table):
            return
        stored = spark.read.parquet(table).where(F.col("ingest_batch") == batch_id)
        before = F.lit(None).cast("timestamp_ntz")
        if lake.exists(spark, counts):
            earlier = spark.read.parquet(counts).where(F.col("ingest_batch") < batch_id)
            before = F.lit(earlier.agg(F.max("newest")).first()[0]).cast("timestamp_ntz")
        limit = before - F.expr(f"INTERVAL {lateness}")
        row = stored.agg(
            F.count("*").alias("processed"), count_where(~F.col("is_rejected")).alias("loaded"), count_where(F.col("is_rejected")).alias("rejected"),
            count_where(F.col("ts") <= limit).alias("late"), F.max("ts").alias("newest"), F.lit(batch_id).cast("bigint").alias("ingest_batch"))
        lake.write_partitions(row, counts, ("ingest_batch",), ())
    return write


def upsert_batch(table: str, keys: list[str], partitions: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    """Keep the newest aggregate per key of an update-mode stream."""
    def write(batch: DataFrame, batch_id: int) -> None:
        lake.upsert(batch, table, keys, partitions)
    return write


def upsert_windows(table: str, keys: list[str], start: str = "window_start") -> Callable[[DataFrame, int], None]:
    """Keep the newest aggregate per window of an update-mode stream, in folders by day: a batch rewrites the days it changed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        lake.upsert(batch.withColumn("window_day", F.to_date(start)), table, ["window_day", *keys], ("window_day",))
    return write


def upsert_newest(table: str, keys: list[str], order: list[str], partitions: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    """Keep the row of the highest ``order`` per key, whichever batch brought it."""
    def newest(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row")).select(*keys, "row.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, staging = batch.sparkSession, scratch_path(batch.sparkSession, "newest")
        newest(batch).write.parquet(staging)  # each further action on the batch would run the stream's state again
        found = spark.read.schema(batch.schema).parquet(staging).select(*batch.columns)
        if lake.exists(spark, table):
            old = spark.read.parquet(table).select(*batch.columns)
            found = newest(found.unionByName(null_safe_join(old, found.select(*keys), keys, "left_semi")))
        lake.upsert(found, table, keys, partitions)
        remove_path(spark, staging)
    return write


# --- transformations -----------------------------------------------------------------


def minute_bars_stream(ticks: DataFrame, lateness: str = "1 minute", width: str = "1 minute") -> DataFrame:
    """Closed trade bars; rows later than the watermark are dropped and counted by Spark."""
    trades = priced_trades(ticks).withWatermark("ts", lateness)
    order = order_key(trades, ("ts", "event_id"))
    bars = trades.groupBy(F.window("ts", width).alias("w"), "exchange", "symbol").agg(
        F.min_by("price", order).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", order).alias("close_price"),
        F.sum("volume").alias("volume"),
        F.count("*").alias("trade_count"),
    )
    return bars.select(
        "exchange", "symbol", F.col("w")["start"].alias("bar_time"), F.col("w")["end"].alias("bar_end"),
        "open_price", "high_price", "low_price", "close_price", "volume", "trade_count")


def load_stats_stream(loads: DataFrame, width: str = "1 hour", slide: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """Load statistics per window and exchange: tumbling, or sliding with ``slide``."""
    span = F.window("start_time", width, slide) if slide else F.window("start_time", width)
    seconds = seconds_between("start_time", "end_time")
    failed = count_where(F.col("status") == "failed")
    out = loads.withWatermark("start_time", lateness).groupBy(span.alias("w"), "exchange").agg(
        F.count("*").alias("files"),
        F.sum("records_loaded").alias("records"),
        failed.alias("errors"),
        F.avg(seconds).alias("avg_processing_time_seconds"),
        ratio(F.sum("records_loaded"), F.sum(seconds)).alias("records_per_second"),
        percent(failed, F.count("*")).alias("error_rate"),
    )
    return out.select(
        F.col("w")["start"].alias("window_start"), F.col("w")["end"].alias("window_end"),
        *[c for c in out.columns if c != "w"])


def latest_price_stream(ticks: DataFrame, keep: str = "7 days") -> DataFrame:
    """Newest price per exchange, symbol and day, for update mode and a sink that keeps the newest per symbol.

    State is one row per symbol and day and goes when the day is older than
    ``keep`` before the newest tick; partial aggregation keeps a hot symbol's
    rows on the map side.  Ticks later than that do not change the sink.
    """
    newest = F.max_by(F.struct("ts", "event_id", "price", "volume"), F.struct("ts", "event_id"))
    priced = ticks.where(F.col("price").isNotNull()).withWatermark("ts", keep)
    return priced.groupBy(F.window("ts", "1 day").alias("w"), "exchange", "symbol").agg(newest.alias("row")).select(
        "exchange", "symbol", "row.*")


def unique_ticks_stream(ticks: DataFrame, keys: list[str], lateness: str = "10 minutes") -> DataFrame:
    """First copy of each key; state is dropped after the watermark."""
    return ticks.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def observed(df: DataFrame, rejected, name: str = "batch_counts") -> DataFrame:
    """Attach processed, loaded and rejected row counts to every batch."""
    return df.observe(
        name, F.count(F.lit(1)).alias("processed"),
        count_where(~rejected).alias("loaded"), count_where(rejected).alias("rejected"))


def progress_counts(progress, name: str = "batch_counts") -> dict:
    """Observed counts and late rows of one batch."""
    seen = progress.observedMetrics.get(name)
    counts = seen.asDict() if seen is not None else {"processed": 0, "loaded": 0, "rejected": 0}
    late = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
    return {"batch_id": progress.batchId, **counts, "late": late}


def batch_counts(query: StreamingQuery, name: str = "batch_counts") -> list[dict]:
    """Counts of the batches a query still remembers (the last hundred)."""
    return [progress_counts(p, name) for p in query.recentProgress]


class BatchCountListener(StreamingQueryListener):
    """Hands the counts of every batch to ``report(run_id, counts)``, for long-running jobs."""

    def __init__(self, report: Callable[[str, dict], None], name: str = "batch_counts"):
        self.report = report
        self.name = name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.report(str(event.progress.runId), progress_counts(event.progress, self.name))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
