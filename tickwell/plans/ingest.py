"""Load vendor files into the bronze table, idempotently and all at once.

One job covers every pending file: list, drop what is already loaded, read,
write partitions, record progress.  There is no loop over days.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.functions.scalar import count_where, first_date
from tickwell.operators import control
from tickwell.operators.filters import rename_vendor_columns
from tickwell.sinks import control_log, lake
from tickwell.sinks.versioned import VersionedTable
from tickwell.session import remove_path, scratch_path
from tickwell.sources import files


@dataclass(frozen=True)
class Lake:
    """Paths of the tables a load touches."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/market_data_raw"

    @property
    def progress(self) -> str:
        return f"{self.root}/control/load_progress"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit/ingestion_log"

    @property
    def feed_state(self) -> str:
        return f"{self.root}/control/feed_state"

    @property
    def daily_stats(self) -> str:
        return f"{self.root}/gold/daily_load_stats"

    @property
    def weekly_stats(self) -> str:
        return f"{self.root}/gold/weekly_load_stats"

    @property
    def reports(self) -> str:
        return f"{self.root}/bronze/daily_reports"

    def loaded(self, spark: SparkSession) -> bool:
        return lake.exists(spark, self.bronze)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All bronze rows, rejected lines included."""
        return spark.read.parquet(self.bronze)

    def store(self, spark: SparkSession, rows: DataFrame, todo: DataFrame, force: bool) -> None:
        """Write the rows of the files ``todo``; other files of the same partitions stay unless forced.

        The new partition is the old rows of other files and the new rows, so a
        repeated load does not add a row twice.  A forced reload clears the
        partitions of its files, also of those that have no rows any more.
        """
        keys = list(lake.PARTITIONS)
        if not self.loaded(spark):
            lake.write_partitions(rows, self.bronze)
            return
        touched = todo.select(*keys).distinct()
        if force:
            lake.write_partitions(rows, self.bronze)
            emptied = touched.join(rows.select(*keys).distinct(), keys, "left_anti")
            lake.remove_partitions(spark, self.bronze, lake.PARTITIONS, emptied)
            return
        shared = other_files(self.rows(spark), todo)
        if shared.isEmpty():
            lake.write_partitions(rows, self.bronze)
            return
        staging = scratch_path(spark, "load")
        rows.unionByName(shared, allowMissingColumns=True).write.parquet(staging)
        lake.write_partitions(spark.read.parquet(staging), self.bronze)
        remove_path(spark, staging)


@dataclass(frozen=True)
class AtomicLake(Lake):
    """A lake whose bronze table changes all at once and can be rolled back."""

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.bronze)

    def loaded(self, spark: SparkSession) -> bool:
        return self.table.exists(spark)

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark)

    def store(self, spark: SparkSession, rows: DataFrame, todo: DataFrame, force: bool) -> None:
        """Write the rows of ``todo`` as one commit; the old folders stay for readers and for a rollback."""
        if self.loaded(spark) and not force:
            rows = rows.unionByName(other_files(self.rows(spark), todo), allowMissingColumns=True)
        self.table.replace(rows, clear=todo if force else None, note="load")


def other_files(stored: DataFrame, todo: DataFrame) -> DataFrame:
    """Stored rows of other files in the partitions of ``todo``."""
    keys = list(lake.PARTITIONS)
    return stored.join(todo.select(*keys).distinct(), keys, "left_semi").join(todo.select("source_file"), "source_file", "left_anti")


LOAD_KEY = ["exchange", "data_date", "processing_stage"]


def loaded_files(spark: SparkSession, tables: Lake) -> DataFrame | None:
    """Completed files with their row counts; ``None`` before the first load."""
    if not lake.exists(spark, tables.progress):
        return None
    state = control_log.current_state(spark.read.parquet(tables.progress))
    return state.where(F.col("status") == "completed").select(*LOAD_KEY, "source_file", "records_loaded")


def pending(listed: DataFrame, done: DataFrame | None) -> DataFrame:
    """Listed files without a completed load; a further file of a loaded key is pending."""
    return listed if done is None else listed.join(done.select("source_file"), "source_file", "left_anti")


def bronze_rows(raw: DataFrame) -> DataFrame:
    """Typed tick rows with the load columns, which the path of their file names."""
    typed = rename_vendor_columns(files.to_vendor_types(raw))
    path = F.col("source_file")
    return lake.with_lineage(typed.withColumns({
        "data_date": first_date(path), "exchange": files.exchange_of(path), "processing_stage": files.stage_of(path),
    }))


NO_HEADER = "no header line"
RETRIES_USED = "failed too often, not tried again"


def load(spark: SparkSession, source_root: str, tables: Lake, exchange: str | None = None, stage: str | None = None,
         start: str | None = None, end: str | None = None, force: bool = False, on_existing: str = "skip",
         glob: str = "*.csv.gz", max_retries: int | None = None, retry_only: bool = False) -> DataFrame:
    """Load all pending files of a selection; returns one result row per file.

    Files that are already loaded are reported as skipped with their row
    count (a further file of a loaded key is loaded), or as failed with ``on_existing="fail"``; either way nothing is
    written for them.  ``force`` replaces the partitions of the selected
    files, it never adds rows twice.

    A file that cannot be read, or has no header line, fails alone; the others
    are loaded.  ``retry_only`` takes up only files whose last load failed.
    With ``max_retries`` a file that failed after as many retries is reported
    as failed and left alone.  Report files of the selection replace those of
    their days in ``tables.reports``.
    """
    if on_existing not in ("skip", "fail"):
        raise ValueError(f"on_existing must be 'skip' or 'fail', not {on_existing!r}")
    where = {"exchange": exchange, "stage": stage, "start": start, "end": end, "glob": glob}
    listing = scratch_path(spark, "listing")
    files.list_files(spark, source_root, file_type=None, **where).write.parquet(listing)  # the store is listed once
    everything = spark.read.schema(files.LISTED).parquet(listing)
    listed = everything.where(files.is_kind("Data"))
    done = None if force else loaded_files(spark, tables)
    todo = pending(listed, done)
    present = None if done is None else already_loaded(listed, done, on_existing)
    if (retry_only or max_retries is not None) and lake.exists(spark, tables.progress):
        states = load_states(spark, tables)
        if max_retries is not None:
            spent = todo.join(states.where((F.col("status") == "failed") & (F.col("retry_count") >= max_retries)).select("source_file"), "source_file")
            todo = todo.join(spent.select("source_file"), "source_file", "left_anti")
            refused = failures(spent, RETRIES_USED)
            present = refused if present is None else present.select(*RESULT).unionByName(refused.select(*RESULT))
        if retry_only:
            todo = todo.join(states.where(F.col("status") == "failed").select("source_file"), "source_file", "left_semi")
    if todo.isEmpty():
        return results(present, None)
    control_log.append_progress(todo, tables.progress, "started")
    headers = files.header_groups(todo)
    blank = files.without_header(headers)
    bad = dict.fromkeys(blank, NO_HEADER) | (files.unreadable(spark, blank) if blank else {})
    try:
        good = store_readable(spark, tables, headers, todo, bad, force)
    except Exception:
        broken = files.unreadable(spark, [name for names in headers.values() for name in names])
        try:
            if not broken:
                raise
            bad |= broken
            good = store_readable(spark, tables, headers, todo, bad, force)
        except Exception as e:
            control_log.append_progress(failures(todo, str(e)), tables.progress, "failed")
            raise
    if bad:
        reasons = spark.createDataFrame(sorted(bad.items()), "source_file string, error_message string")
        control_log.append_progress(todo.join(F.broadcast(reasons), "source_file"), tables.progress, "failed")
    if tables.loaded(spark):
        lake.append(control_log.progress_events(with_counts(spark, tables, good), "completed"), tables.progress)
    written = spark.read.parquet(tables.progress).where(F.col("status").isin("completed", "failed") if bad else F.col("status") == "completed")
    newest = control_log.current_state(written.join(todo.select("source_file"), "source_file", "left_semi"))
    together(
        lambda: lake.append(control_log.audit_rows(newest.where("status = 'completed'"), "ingest", "bronze.market_data_raw"), tables.audit),
        lambda: refresh(spark, tables, todo),
        lambda: store_reports(spark, tables, everything.where(files.is_kind("Report"))))
    return results(present, newest)


def store_readable(spark: SparkSession, tables: Lake, headers: dict[str, list[str]], todo: DataFrame, bad: dict[str, str], force: bool) -> DataFrame:
    """Store the rows of the files that are not ``bad``; returns those files."""
    good = todo.where(~F.col("source_file").isin(list(bad))) if bad else todo
    kept = {header: left for header, names in headers.items() if (left := [n for n in names if n not in bad])}
    if kept:
        tables.store(spark, bronze_rows(files.read_grouped(spark, kept)), good, force)
    return good


def failures(listed: DataFrame, message: str) -> DataFrame:
    """Result rows of files that were not loaded."""
    zero = F.lit(0).cast("bigint")
    return listed.withColumns({"status": F.lit("failed"), "error_message": F.lit(message), "records_loaded": zero, "records_rejected": zero})


def store_reports(spark: SparkSession, tables: Lake, listed: DataFrame) -> None:
    """Report rows of the listed files, in place of those of the same exchange, stage and day."""
    reports = files.read_report_files(spark, listed)
    if reports is not None:
        lake.write_partitions(reports, tables.reports, lake.PARTITIONS, ("source_file",))


def together(*steps) -> None:
    """Steps that write different small tables, side by side; all are waited for, and the first error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for step in [pool.submit(step) for step in steps]:
            step.result()


def load_states(spark: SparkSession, tables: Lake) -> DataFrame:
    """One row per file: its newest state, times, retries and kind of error."""
    state = control_log.current_state(spark.read.parquet(tables.progress))
    return state.withColumn("error_type", F.when(F.col("status") == "failed", F.lit("load")))


def refresh(spark: SparkSession, tables: Lake, touched: DataFrame) -> None:
    """High-water marks, and load statistics of the days and weeks of ``touched``; only the progress log is read."""
    states = load_states(spark, tables)
    days = states.join(touched.select("exchange", "data_date").distinct(), ["exchange", "data_date"], "left_semi")
    week = control.week_end("data_date")
    weeks = touched.select("exchange", week.alias("week")).distinct()
    whole_weeks = states.withColumn("week", week).join(weeks, ["exchange", "week"], "left_semi").drop("week")
    together(
        lambda: control_log.update_feed_state(states, tables.feed_state),
        lambda: lake.upsert(control.weeks_load_stats(control.daily_load_stats(whole_weeks)), tables.weekly_stats, ["week_ending", "exchange"], ("exchange",)),
        lambda: lake.upsert(control.daily_stats(days), tables.daily_stats, ["stats_date", "exchange"], ("exchange",)))


def with_counts(spark: SparkSession, tables: Lake, todo: DataFrame) -> DataFrame:
    """Loaded and rejected rows per file, counted in the written table.

    Two columns of the touched partitions are read, so the CSV text is parsed
    only once, by the load itself.
    """
    keys = ["data_date", "exchange", "processing_stage", "source_file"]
    stored = tables.rows(spark).join(todo.select(*keys), keys, "left_semi")
    per_file = stored.groupBy("source_file").agg(
        count_where(~F.col("is_rejected")).alias("records_loaded"), count_where(F.col("is_rejected")).alias("records_rejected"))
    return todo.join(per_file, "source_file", "left").fillna(0, ["records_loaded", "records_rejected"])


def accepted(spark: SparkSession, tables: Lake) -> DataFrame:
    """Bronze ticks without the lines that could not be read."""
    return tables.rows(spark).where(~F.col("is_rejected")).drop("is_rejected", "raw_line")


def rejects(spark: SparkSession, tables: Lake) -> DataFrame:
    """Rejected lines as they came."""
    return tables.rows(spark).where(F.col("is_rejected")).select(
        "source_file", "exchange", "data_date", "processing_stage", "raw_line")


def already_loaded(listed: DataFrame, done: DataFrame, on_existing: str) -> DataFrame:
    """Result rows of files that are loaded."""
    found = listed.join(done.select("source_file", "records_loaded"), "source_file")
    message = F.concat_ws(" ", F.lit("data already exists for"), *LOAD_KEY)
    return found.withColumns({
        "status": F.lit("skipped" if on_existing == "skip" else "failed"),
        "error_message": F.lit(None).cast("string") if on_existing == "skip" else message,
        "records_loaded": F.coalesce("records_loaded", F.lit(0).cast("bigint")) if on_existing == "skip" else F.lit(0).cast("bigint"),
        "records_rejected": F.lit(0).cast("bigint"),
    })


RESULT = [
    "source_file", "exchange", "data_date", "processing_stage", "status", "records_loaded", "records_rejected", "error_message",
]


def results(present: DataFrame | None, loaded: DataFrame | None) -> DataFrame:
    parts = [df.select(*RESULT) for df in (present, loaded) if df is not None]
    if not parts:
        raise FileNotFoundError("no files match the selection")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
