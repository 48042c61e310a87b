"""Loading vendor files and maintaining lake tables in a temporary folder."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from tickwell.binding import Tables
from tickwell.operators import sketches
from tickwell.plans import ingest
from tickwell.session import clear_scratch, scratch_mark, scratch_path, shared_dir
from tickwell.sinks import control_log, export, lake
from tickwell.sinks.versioned import ConcurrentCommit, VersionedTable
from tickwell.sources import files

HEADER = "#RIC,Date-Time,Type,Price,Volume,Exch Time,Qualifiers"


def vendor_file(root, exchange, day, lines, header=HEADER, kind="Data", stage="ingestion"):
    path = f"{root}/LSEG/TRTH/{exchange}/{stage}/{day}/data/merged/{exchange}-{day}-NORMALIZEDMP-{kind}-1-of-1.csv.gz"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def tick(symbol, time, price="1.5", volume="3", kind="Trade"):
    return f"{symbol},{time},{kind},{price},{volume},{time},q"


@pytest.fixture()
def landing(folder):
    root = f"{folder}/landing"
    vendor_file(root, "LSE", "2025-01-01", [tick("A", "2025-01-01 09:00:00"), tick("B", "2025-01-01 09:00:01")])
    vendor_file(root, "LSE", "2025-01-02", [tick("A", "2025-01-02 09:00:00"), "broken", "too,many,fields,1,2,3,4,5,6", tick("A", "2025-01-02 09:01:00")])
    vendor_file(root, "CME", "2025-01-01", ["BTCF25,2025-01-01 10:00:00,Trade,100.5,7,2025-01-01 10:00:00"], HEADER.rsplit(",", 1)[0])
    vendor_file(root, "NYQ", "2025-01-01", [tick("C", "2025-01-01 15:00:00", volume="n/a")])
    vendor_file(root, "LSE", "2025-01-01", [tick("A", "2025-01-01 09:00:00")], stage="normalization")
    vendor_file(root, "LSE", "2025-01-01", ["7,9"], "total_trades,total_volume", kind="Report")
    return root


def states(df):
    out = {}
    for r in df.collect():
        out[r["status"]] = out.get(r["status"], 0) + 1
    return out


def test_load_twice_equals_load_once(spark, landing, folder):
    tables = ingest.Lake(f"{folder}/lake")
    assert states(ingest.load(spark, landing, tables)) == {"completed": 5}
    first = sorted(map(str, ingest.accepted(spark, tables).drop("ingestion_timestamp").collect()))
    assert states(ingest.load(spark, landing, tables)) == {"skipped": 5}
    refused = ingest.load(spark, landing, tables, exchange="CME", on_existing="fail").first()
    assert refused["status"] == "failed" and refused["error_message"] == "data already exists for CME 2025-01-01 ingestion"
    assert sorted(map(str, ingest.accepted(spark, tables).drop("ingestion_timestamp").collect())) == first
    assert len(first) == 7


def test_rejected_lines_are_kept_and_counted(spark, landing, folder):
    tables = ingest.Lake(f"{folder}/lake")
    result = ingest.load(spark, landing, tables, exchange="lse", start="2025-01-02").collect()
    assert [(r["records_loaded"], r["records_rejected"]) for r in result] == [(2, 2)]
    assert {r["raw_line"] for r in ingest.rejects(spark, tables).collect()} == {"broken", "too,many,fields,1,2,3,4,5,6"}


def test_columns_are_matched_by_name_and_text_volume_is_null(spark, landing, folder):
    tables = ingest.Lake(f"{folder}/lake")
    ingest.load(spark, landing, tables, stage="ingestion")
    rows = {r["symbol"]: r for r in ingest.accepted(spark, tables).where("data_date = date'2025-01-01'").collect()}
    assert rows["BTCF25"]["volume"] == 7 and rows["BTCF25"]["qualifiers"] is None and rows["BTCF25"]["exchange"] == "CME"
    assert rows["C"]["volume"] is None and rows["C"]["price"] == 1.5
    assert rows["A"]["ts"] == dt.datetime(2025, 1, 1, 9)


def test_forced_reload_replaces_only_its_partitions(spark, landing, folder):
    tables = ingest.Lake(f"{folder}/lake")
    ingest.load(spark, landing, tables)
    vendor_file(landing, "LSE", "2025-01-01", [tick("Z", "2025-01-01 12:00:00")])
    ingest.load(spark, landing, tables, exchange="LSE", stage="ingestion", start="2025-01-01", end="2025-01-01", force=True)
    rows = ingest.accepted(spark, tables)
    key = "exchange = 'LSE' AND data_date = date'2025-01-01' AND processing_stage = "
    assert [r["symbol"] for r in rows.where(key + "'ingestion'").collect()] == ["Z"]
    assert rows.where(key + "'normalization'").count() == 1
    assert rows.count() == 6
    assert lake.partition_exists(spark, tables.bronze, "NYQ", "2025-01-01", "ingestion")
    assert not lake.partition_exists(spark, tables.bronze, "NYQ", "2025-01-02", "ingestion")


def test_listing_sizes_and_reports(spark, landing):
    listed = files.list_files(spark, landing, "LSE", "ingestion", "2025-01-01", "2025-01-01").collect()
    assert len(listed) == 1 and listed[0]["file_size_bytes"] == os.path.getsize(listed[0]["source_file"].removeprefix("file://"))
    assert files.list_files(spark, landing, file_type="Data").count() == 5
    report = files.read_reports(spark, landing).collect()
    assert [(r["exchange"], r["total_trades"]) for r in report] == [("LSE", "7")]
    assert files.read_reports(spark, landing, exchange="NYQ") is None


def test_failed_load_is_logged_and_can_be_repeated(spark, landing, folder, monkeypatch):
    tables = ingest.Lake(f"{folder}/lake")

    def boom(*a, **k):
        raise RuntimeError("disk " * 400)
    monkeypatch.setattr(ingest.lake, "write_partitions", boom)
    with pytest.raises(RuntimeError):
        ingest.load(spark, landing, tables, exchange="NYQ")
    monkeypatch.undo()
    state = control_log.current_state(spark.read.parquet(tables.progress)).first()
    assert state["status"] == "failed" and len(state["error_message"]) == 1000
    assert state["retry_count"] == 0
    assert states(ingest.load(spark, landing, tables, exchange="NYQ")) == {"completed": 1}
    assert [r["retry_count"] for r in ingest.load_states(spark, tables).collect()] == [1]
    mark = spark.read.parquet(tables.feed_state).first()
    stats = spark.read.parquet(tables.daily_stats).first()
    assert mark["last_processed_date"] == stats["stats_date"] and mark["records_processed"] == stats["total_records_loaded"]


def test_long_header_line_is_read_whole(spark, folder):
    names = [f"column_{i}" for i in range(8000)]
    with open(f"{folder}/wide.csv", "w") as out:
        out.write(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    paths = spark.createDataFrame([(f"file://{folder}/wide.csv",)], "source_file string")
    assert files.file_headers(paths).first()["header"].split(",") == names


def test_headers_of_many_files_with_odd_names(spark, folder):
    """Blanks, percent signs, patterns, marks and packed files; empty ones have no header."""
    want = {}
    for i, name in enumerate(["a b.csv", "100%41.csv", "p+q.csv", "set[1].csv", "star*.csv", "é.csv", "many.csv"]):
        with open(f"{folder}/{name}", "w", encoding="utf-8-sig" if i % 2 else "utf-8", newline="") as out:
            out.write(f"h{i},x\r\n" + "1,2\r\n" * (300_000 if name == "many.csv" else 3))
        want[f"file://{folder}/{name}"] = f"h{i},x"
    open(f"{folder}/empty.csv", "w").close()
    names = [*want, f"file://{folder}/empty.csv"]
    for small in (names, [], names[:4]):
        assert files.headers_of(spark, small, [n for n in names if n not in small]) == want


def test_whole_exchange_codes_and_odd_folders(spark, folder):
    root = f"{folder}/to load/50% [x]+y"
    for exchange, header in (("B3", HEADER), ("L2", HEADER.rsplit(",", 1)[0]), ("LSE", HEADER)):
        place = f"{root}/exchange={exchange}/processing_stage=ingestion/data_date=2025-01-01"
        os.makedirs(place)
        with gzip.open(f"{place}/part 1.csv.gz", "wt") as out:
            out.write(header + "\n" + ",".join(tick(exchange, "2025-01-01 09:00:00").split(",")[:header.count(",") + 1]) + "\n")
    assert {r["exchange"] for r in files.list_files(spark, f"{folder}/to load").collect()} == {"B3", "L2", "LSE"}
    tables = ingest.Lake(f"{folder}/lake")
    assert states(ingest.load(spark, f"{folder}/to load", tables)) == {"completed": 3}
    rows = {r["exchange"]: r for r in ingest.accepted(spark, tables).collect()}
    assert {ex: r["symbol"] for ex, r in rows.items()} == {"B3": "B3", "L2": "L2", "LSE": "LSE"}
    assert rows["L2"]["qualifiers"] is None and rows["B3"]["qualifiers"] == "q" and rows["B3"]["source_file"].endswith("/to load/50% [x]+y/exchange=B3/processing_stage=ingestion/data_date=2025-01-01/part 1.csv.gz")
    assert states(ingest.load(spark, f"{folder}/to load", tables)) == {"skipped": 3}


def test_the_package_opens_no_file_beside_spark():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tickwell")
    for at, _, names in os.walk(root):
        if not at.startswith(os.path.join(root, "llm")):
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(at, name)) as code:
                        text = code.read()
                    assert "pyarrow.fs" not in text and "import fs" not in text and "FileSystem.from_uri" not in text


def test_schema_over_files_with_different_headers(spark, folder):
    for name, text in (("a.csv", "k,v\n1,2\n"), ("b.csv", "v,k,w\n2.5,7,x\n"), ("c.csv", "k,t\nn/a,2025-01-01\n")):
        with open(f"{folder}/{name}", "w") as out:
            out.write(text)
    listed = spark.createDataFrame([(f"file://{folder}/{n}.csv",) for n in "abc"], "source_file string")
    assert {r["column_name"]: r["data_type"] for r in files.discover_union_schema(spark, listed, 1.0).collect()} == {"k": "string", "v": "double", "w": "string", "t": "date"}


def test_manifest_refuses_unknown_stages(spark):
    requests = spark.createDataFrame([("CME", "normalization"), ("LSE", "normalization")], "exchange string, processing_stage string")
    rows = {r["exchange"]: r for r in files.manifest(requests.withColumn("data_date", F.lit("2025-01-17").cast("date")), "s3a://lake").collect()}
    assert rows["CME"]["source_file"] is None and "not available" in rows["CME"]["error"]
    assert rows["LSE"]["source_file"] == "s3a://lake/LSEG/TRTH/LSE/normalization/2025-01-17/data/merged/LSE-2025-01-17-NORMALIZEDMP-Data-1-of-1.csv.gz"


def test_life_cycle_keeps_the_newest_event(spark, folder):
    one = spark.createDataFrame([("TEST", dt.date(2025, 1, 1), "ingestion", "f", 1000)], "exchange string, data_date date, processing_stage string, source_file string, records_loaded bigint")
    path = f"{folder}/progress"
    control_log.append_progress(one, path, "started", "2025-01-01 00:00:00")
    control_log.append_progress(one, path, "completed", "2025-01-01 00:00:30")
    state = control_log.current_state(spark.read.parquet(path)).collect()
    assert len(state) == 1 and state[0]["status"] == "completed" and state[0]["records_loaded"] == 1000
    assert state[0]["end_time"] - state[0]["start_time"] == dt.timedelta(seconds=30)


def test_upsert_retention_and_evolution(spark, folder):
    path = f"{folder}/t"
    old = spark.createDataFrame([("a", 1, "2025-01-01"), ("b", 2, "2024-01-01")], "k string, v int, data_date string").withColumn("data_date", F.to_date("data_date"))
    lake.upsert(old, path, ["k"], ("data_date",))
    lake.upsert(old.where("k = 'a'").withColumn("v", F.lit(9)), path, ["k"], ("data_date",))
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 9), ("b", 2)}
    lake.drop_older(spark, path, 90, "2025-01-10", partitions=("data_date",))
    assert [r["k"] for r in spark.read.parquet(path).collect()] == ["a"]
    lake.append(old.where("k = 'b'").withColumn("extra", F.lit("x")), path, ("data_date",))
    rows = {r["k"]: r["extra"] for r in lake.read_table(spark, path, {"extra": ("string", "none")}).collect()}
    assert rows == {"a": "none", "b": "x"}


def test_hot_partition_is_split_into_files(spark, folder):
    """One exchange-day holds nearly all rows; rebalancing must not leave one file."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        ids = spark.range(200_000, numPartitions=8)
        df = ids.select(
            F.when(F.col("id") % 50 == 0, "CME").otherwise("LSE").alias("exchange"), F.lit("2025-01-01").cast("date").alias("data_date"),
            F.concat(F.lit("S"), F.col("id") % 100).alias("symbol"), F.rand(1).alias("price"), F.col("id").alias("ts"))
        lake.write_partitions(df, f"{folder}/hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    parts = [f for f in os.listdir(f"{folder}/hot/data_date=2025-01-01/exchange=LSE") if f.endswith(".parquet")]
    assert len(parts) > 1 and spark.read.parquet(f"{folder}/hot").count() == 200_000


def test_exports(spark, folder):
    ticks = Tables(spark, "/root/testdata/sf0.001").ticks
    path, summary = export.export_category(ticks.drop("yield_value"), folder, "crypto_futures", "CME", fmt="json")
    assert path.endswith(".json") and spark.read.json(path).count() == summary.first()["total_records"]
    with pytest.raises(ValueError):
        export.export_category(ticks, folder, "crypto_futures", "CME", fmt="xml")


class FakeSession:
    """Only what ``shared_dir`` reads, since Spark fixes this setting at start."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_shared_folder_comes_from_the_session():
    named = FakeSession("spark://host:7077", **{"spark.checkpoint.dir": "s3a://bucket/shared/"})
    assert shared_dir(named) == "s3a://bucket/shared" and scratch_path(named, "x").startswith("s3a://bucket/shared/tickwell/x-")
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession("spark://host:7077"))
    local = FakeSession("local[8]")
    assert shared_dir(local) == shared_dir(local) and os.path.isdir(shared_dir(local))


def test_scratch_tables_can_be_cleared(spark):
    before = scratch_mark(spark)
    first, second = scratch_path(spark, "a"), scratch_path(spark, "b")
    for path in (first, second):
        spark.range(3).write.parquet(path)
    assert clear_scratch(spark, before, keep=(second,)) == 1
    assert not os.path.exists(first) and spark.read.parquet(second).count() == 3
    assert clear_scratch(spark, before) == 1 and not os.path.exists(second) and clear_scratch(spark, before) == 0


def test_total_size_of_files(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    assert files.total_size(spark.read.parquet(path)) == os.path.getsize(path)


def test_second_file_of_a_loaded_key_is_added(spark, landing, folder):
    tables = ingest.Lake(f"{folder}/lake")
    ingest.load(spark, landing, tables, exchange="LSE", stage="ingestion", start="2025-01-01", end="2025-01-01")
    first = vendor_file(landing, "LSE", "2025-01-01", [tick("A", "2025-01-01 09:00:00"), tick("B", "2025-01-01 09:00:01")])
    second = first.replace("1-of-1", "2-of-2")
    with gzip.open(second, "wt") as f:
        f.write("\n".join([HEADER, tick("C", "2025-01-01 10:00:00")]) + "\n")
    where = {"exchange": "LSE", "stage": "ingestion", "start": "2025-01-01", "end": "2025-01-01"}
    assert states(ingest.load(spark, landing, tables, **where)) == {"skipped": 1, "completed": 1}
    assert sorted(r["symbol"] for r in ingest.accepted(spark, tables).collect()) == ["A", "B", "C"]
    assert states(ingest.load(spark, landing, tables, **where)) == {"skipped": 2}


def test_forced_reload_of_an_empty_file_clears_its_partition(spark, landing, folder):
    tables = ingest.Lake(f"{folder}/lake")
    ingest.load(spark, landing, tables)
    vendor_file(landing, "NYQ", "2025-01-01", [])
    result = ingest.load(spark, landing, tables, exchange="NYQ", force=True).collect()
    assert [(r["status"], r["records_loaded"]) for r in result] == [("completed", 0)]
    assert spark.read.parquet(tables.bronze).where("exchange = 'NYQ'").count() == 0
    assert ingest.accepted(spark, tables).count() == 6


def test_upsert_moves_keys_and_matches_nulls(spark, folder):
    path = f"{folder}/moved"
    schema = "k int, p string, v int"
    lake.upsert(spark.createDataFrame([(1, "a", 1), (None, "a", 2), (3, "c", 3)], schema), path, ["k"], ("p",))
    lake.upsert(spark.createDataFrame([(1, "b", 10), (None, "a", 20), (3, "d/e", 30)], schema), path, ["k"], ("p",))
    assert {(r["k"], r["p"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "b", 10), (None, "a", 20), (3, "d/e", 30)}


def test_retention_keeps_undated_rows_and_reads_no_rows(spark, folder):
    rows = spark.createDataFrame([("a", "2025-01-01"), ("b", "2024-01-01"), ("c", None)], "k string, d string").withColumn("data_date", F.to_date("d")).drop("d")
    for name, partitions in (("folders", ("data_date",)), ("rows", ())):
        path = f"{folder}/{name}"
        lake.write_partitions(rows, path, partitions, ())
        lake.drop_older(spark, path, 90, "2025-01-10", partitions=partitions)
        assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == ["a", "c"]


def rows_of(df):
    return sorted(map(str, df.drop("ingestion_timestamp").collect()))


def test_a_load_killed_between_folders_leaves_the_old_table(spark, landing, folder, monkeypatch):
    tables = ingest.AtomicLake(f"{folder}/lake")
    assert states(ingest.load(spark, landing, tables)) == {"completed": 5}
    before = rows_of(ingest.accepted(spark, tables))
    vendor_file(landing, "LSE", "2025-01-01", [tick("Z", "2025-01-01 12:00:00")])
    vendor_file(landing, "CME", "2025-01-01", [tick("Y", "2025-01-01 12:00:00")])
    whole = ingest.lake.write_partitions

    def killed(df, path, *rest, **named):
        if "version=" not in path:
            return whole(df, path, *rest, **named)
        whole(df.where("exchange = 'LSE'"), path, *rest, **named)
        raise KeyboardInterrupt
    monkeypatch.setattr(ingest.lake, "write_partitions", killed)
    with pytest.raises(KeyboardInterrupt):
        ingest.load(spark, landing, tables, force=True)
    monkeypatch.undo()
    assert rows_of(ingest.accepted(spark, tables)) == before
    held = ingest.accepted(spark, tables)  # a reader that began before the next commit
    ingest.load(spark, landing, tables, force=True)
    assert {r["symbol"] for r in ingest.accepted(spark, tables).where("data_date = date'2025-01-01' AND processing_stage = 'ingestion'").collect()} == {"Z", "Y", "C"}
    assert rows_of(held) == before
    assert tables.table.rollback(spark) == 1 and rows_of(ingest.accepted(spark, tables)) == before
    assert [r["note"] for r in tables.table.history(spark).collect()] == ["load", "load", "rollback to 1"]
    assert tables.table.vacuum(spark) > 0 and rows_of(ingest.accepted(spark, tables)) == before
    assert tables.table.vacuum(spark) == 0


def test_versions_clear_evolve_and_refuse_a_second_writer(spark, folder, monkeypatch):
    table = VersionedTable(f"{folder}/t", ("p",), ("k",))
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    first = spark.createDataFrame([("a b", 1), ("c/d%", 2), (None, 3), ("7", 4)], "p string, k int")
    table.replace(first)
    assert {tuple(r) for r in table.read(spark).select("p", "k").collect()} == {tuple(r) for r in first.collect()}
    table.replace(spark.createDataFrame([("a b", 10, "x"), (None, 30, "y")], "p string, k int, extra string"), clear=first.where("p = '7'"))
    want = {("a b", 10, "x"), ("c/d%", 2, None), (None, 30, "y")}
    assert {tuple(r) for r in table.read(spark).select("p", "k", "extra").collect()} == want
    assert {tuple(r) for r in table.read(spark, 1).select("p", "k").collect()} == {tuple(r) for r in first.collect()}
    open(f"{folder}/t/commits/{3:012d}", "w").close()  # a writer that died in its commit
    assert table.read(spark).count() == 3
    table.replace(spark.createDataFrame([("7", 5)], "p string, k int"))
    assert table.read(spark).count() == 4 and [r["number"] for r in table.history(spark).collect()] == [1, 2, 4]
    state = table._state
    monkeypatch.setattr(table, "_state", lambda s: (3, state(s)[1]))
    with pytest.raises(ConcurrentCommit):
        table.replace(spark.createDataFrame([("7", 6)], "p string, k int"))
    assert VersionedTable(f"{folder}/t", ("p",)).read(spark).count() == 4


@pytest.mark.parametrize("kind", [ingest.Lake, ingest.AtomicLake])
def test_bad_files_fail_alone_and_are_retried(spark, landing, folder, kind):
    tables = kind(f"{folder}/lake")
    cut = vendor_file(landing, "NYQ", "2025-01-02", [tick(f"S{i}", "2025-01-02 15:00:00") for i in range(3000)])
    with open(cut, "rb") as f:
        data = f.read()
    with open(cut, "wb") as f:
        f.write(data[:len(data) // 2])
    with gzip.open(vendor_file(landing, "NYQ", "2025-01-03", []), "wt") as f:
        f.write("")
    result = {(r["exchange"], str(r["data_date"]), r["processing_stage"]): r for r in ingest.load(spark, landing, tables).collect()}
    assert len(result) == 7 and {k[:2] for k, r in result.items() if r["status"] == "failed"} == {("NYQ", "2025-01-02"), ("NYQ", "2025-01-03")}
    assert result["NYQ", "2025-01-03", "ingestion"]["error_message"] == ingest.NO_HEADER
    assert "cannot be read" in result["NYQ", "2025-01-02", "ingestion"]["error_message"]
    assert ingest.accepted(spark, tables).count() == 7
    with open(cut, "wb") as f:
        f.write(data)
    again = ingest.load(spark, landing, tables, retry_only=True, max_retries=1).collect()
    assert {str(r["data_date"]): r["status"] for r in again if r["status"] != "skipped"} == {"2025-01-02": "completed", "2025-01-03": "failed"}
    assert ingest.accepted(spark, tables).count() == 3007
    last = ingest.load(spark, landing, tables, max_retries=1).collect()
    assert [(str(r["data_date"]), r["error_message"]) for r in last if r["status"] == "failed"] == [("2025-01-03", ingest.RETRIES_USED)]
    assert spark.read.parquet(tables.reports).select("exchange", "total_trades").first() == ("LSE", "7")


def test_sketches_merge_and_take_nulls(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("day"), F.when(F.col("id") % 5 != 0, F.col("id") % 2000).alias("v"), F.lit(None).cast("double").alias("none"))
    known = sketches.distinct_sketches(rows, ["day"], ["v", "none"])
    got = {r["column_name"]: r for r in sketches.merged_distinct(known, ["column_name"]).collect()}
    assert (got["v"]["row_count"], got["v"]["non_null_count"]) == (30_000, 24_000) and abs(got["v"]["unique_values"] - 1600) < 50
    assert got["none"]["unique_values"] == 0
    spread = sketches.quantile_sketches(rows, ["day"], ["v", "none"])
    quart = {r["column_name"]: r for r in sketches.merged_quantiles(spread, ["column_name"], {"q": 0.5}).collect()}
    assert set(quart) == {"v"} and abs(quart["v"]["q"] - 1000) < 40


def scanned_rows(df):
    """Rows that the scan of a query handed on, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found = []

    def walk(node):
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(plan)
    return sum(found)


def test_lookup_of_symbols_skips_row_groups(spark, folder):
    """Symbols spread over all row groups: only the filters can tell that a value is not in one."""
    rows = spark.range(400_000, numPartitions=1).select(
        F.concat(F.lit("S"), F.hex(F.xxhash64("id"))).alias("symbol"), F.col("id").alias("v"), F.lit("2025-01-01").cast("date").alias("data_date"))
    wanted = [r["symbol"] for r in rows.where("v IN (7, 250000)").collect()]
    read = {}
    for name, lookup in (("plain", ()), ("filtered", lake.LOOKUP)):
        spark.conf.set("parquet.block.size", str(1 << 20))
        try:
            lake.write_partitions(rows, f"{folder}/{name}", ("data_date",), ("v",), lookup=lookup)
        finally:
            spark.conf.unset("parquet.block.size")
        picked = spark.read.parquet(f"{folder}/{name}").where(F.col("symbol").isin(wanted))
        read[name] = scanned_rows(picked)
        assert {r["v"] for r in picked.collect()} == {7, 250_000}
    assert read["plain"] == 400_000 and read["filtered"] < 200_000, read


def test_sorted_files_skip_row_groups(spark, folder):
    rows = spark.range(400_000, numPartitions=1).select(F.concat(F.lit("S"), F.lpad((F.col("id") * 7919 % 20_000).cast("string"), 5, "0")).alias("symbol"), F.col("id").alias("ts"))
    read = {}
    for name, sort in (("plain", ()), ("sorted", lake.SORT)):
        spark.conf.set("parquet.block.size", str(1 << 19))
        try:
            lake.write_partitions(rows, f"{folder}/{name}", (), sort)
        finally:
            spark.conf.unset("parquet.block.size")
        read[name] = scanned_rows(spark.read.parquet(f"{folder}/{name}").where("symbol IN ('S00007', 'S00009')"))
    assert read["sorted"] < read["plain"] / 2, read
