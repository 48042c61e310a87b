"""Streams against batch results: late rows, replays, state across runs."""

import datetime as dt
import gzip
import os
import time

from pyspark.sql import functions as F

from tickwell.operators import bars
from tickwell.streaming import alerts, jobs, late

TICK = "event_id bigint, exchange string, symbol string, ts timestamp, data_date date, type string, price double, volume bigint"


def ticks(spark, rows):
    """(minute offset, price, volume[, symbol]) rows as trades."""
    base = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    data = [
        (i, "X", r[3] if len(r) > 3 else "A", base + dt.timedelta(minutes=r[0]), dt.date(2025, 1, 1), "Trade", float(r[1]), r[2])
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, TICK)


def bar_run(spark, folder):
    stream = jobs.read_stream(jobs.stream_session(spark), f"{folder}/in", TICK, max_files=1)
    query = jobs.run(jobs.minute_bars_stream(stream), f"{folder}/cp", f"{folder}/out")
    jobs.finish(query)
    return query


def test_late_rows_are_dropped_and_counted(spark, folder):
    ticks(spark, [(0, 10, 1), (1, 11, 1), (30, 12, 1)]).coalesce(1).write.parquet(f"{folder}/in")
    bar_run(spark, folder)
    ticks(spark, [(0.5, 99, 9), (31, 13, 1), (60, 14, 1)]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    query = bar_run(spark, folder)
    assert sum(r["late"] for r in jobs.batch_counts(query)) == 1
    rows = spark.read.parquet(f"{folder}/out").orderBy("bar_time").collect()
    assert [r["close_price"] for r in rows] == [10.0, 11.0, 12.0, 13.0]  # the last window stays open
    assert rows[0]["volume"] == 1


def test_late_rows_are_counted_and_their_days_reloaded(spark, folder):
    """Two days late for one symbol; only the day that lacks rows is replaced."""
    day = 24 * 60
    arrivals = [[(m, 10 + m % 5, 1) for m in range(0, 3 * day, 30)], [(45.5, 99, 7), (46.5, 98, 7), (3 * day, 12, 1)]]
    dropped, seen = 0, []
    for rows in arrivals:
        df = ticks(spark, rows).withColumn("event_id", F.col("event_id") + len(seen) * 1000).withColumn("data_date", F.to_date("ts"))
        seen.append(df)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = jobs.read_stream(jobs.stream_session(spark), f"{folder}/in", TICK)
        query = jobs.run(late.on_time_bars_stream(stream), f"{folder}/cp", each_batch=late.append_bars(f"{folder}/bars"))
        jobs.finish(query)
        dropped += late.late_rows(query)
    assert dropped == 2

    def files_of():
        return {at: sorted(names) for at, _, names in os.walk(f"{folder}/bars") if names}
    stored = jobs.plain_time(seen[0].unionByName(seen[1]), "ts")
    before = files_of()
    touched = late.repair(stored, f"{folder}/bars", late.closed_until(query))
    assert [(str(r["data_date"]), r["missing"]) for r in touched.collect()] == [("2025-01-01", 2)]
    assert {at for at in before if "data_date=2025-01-01" not in at} <= {at for at, names in files_of().items() if names == before.get(at)}
    want = bars.minute_bars(stored, session_start="00:00:00", session_end="24:00:00").where(F.col("bar_time") < F.lit("2025-01-03 23:49:00").cast("timestamp_ntz"))
    columns = ["exchange", "symbol", "bar_time", "open_price", "high_price", "low_price", "close_price", "volume", "trade_count"]
    got = spark.read.parquet(f"{folder}/bars").select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*columns).collect())) and got.count() == 146
    assert late.repair(stored, f"{folder}/bars", late.closed_until(query)).count() == 0


def test_files_with_new_headers_go_into_one_stream(spark, folder):
    def arrive(exchange, header, lines):
        place = f"{folder}/in/exchange={exchange}/processing_stage=ingestion/data_date=2025-01-01"
        os.makedirs(place, exist_ok=True)
        with gzip.open(f"{place}/{len(os.listdir(place))} x.csv.gz", "wt") as out:
            out.write("\n".join([header, *lines]) + "\n")

    def run():
        lines = jobs.read_vendor_lines(jobs.stream_session(spark), f"{folder}/in")
        jobs.finish(jobs.run(lines, f"{folder}/cp", each_batch=jobs.vendor_batches(f"{folder}/out", counts=f"{folder}/counts")))
    arrive("LSE", "#RIC,Date-Time,Type,Price,Volume,Exch Time", ["A,2025-01-01 09:00:00,Trade,1.5,3,x", "broken"])
    arrive("L2", '"#RIC","Date-Time",Type,Price,Volume,Exch Time,Qualifiers', ["B,2025-01-01 12:00:00,Trade,2.5,n/a,x,q", '"C, D",2025-01-01 12:00:00,Trade,1,2,x,'])
    run()
    arrive("B3", "Price,#RIC,Extra,Date-Time", ["7.5,E,?,2025-01-01 08:00:00", "8.5,F,?,2025-01-01 11:55:00", "1,2,3,4,5"])
    run()
    run()
    rows = {r["symbol"]: (r["exchange"], r["price"], r["volume"], r["qualifiers"]) for r in spark.read.parquet(f"{folder}/out").where("NOT is_rejected").collect()}
    assert rows == {"A": ("LSE", 1.5, 3, None), "B": ("L2", 2.5, None, "q"), "C, D": ("L2", 1.0, 2, None), "E": ("B3", 7.5, None, None), "F": ("B3", 8.5, None, None)}
    counts = spark.read.parquet(f"{folder}/counts").orderBy("ingest_batch").collect()
    assert [(r["processed"], r["loaded"], r["rejected"], r["late"]) for r in counts] == [(4, 3, 1, 0), (3, 2, 1, 1)]
    assert {r["raw_line"] for r in spark.read.parquet(f"{folder}/out").where("is_rejected").collect()} == {"broken", "1,2,3,4,5"}


def test_replayed_batch_writes_once(spark, folder):
    batch = ticks(spark, [(0, 10, 1), (1, 11, 1)])
    write = jobs.write_batch(f"{folder}/t", f"{folder}/audit")
    write(batch, 7)
    write(batch, 8)
    write(batch, 7)
    stored = spark.read.parquet(f"{folder}/t")
    assert stored.count() == 4 and stored.where("ingest_batch = 7").count() == 2
    assert spark.read.parquet(f"{folder}/audit").count() == 2


def test_alert_state_survives_a_restart(spark, folder):
    def run():
        stream = jobs.read_stream(jobs.stream_session(spark, timers=True), f"{folder}/bars", BAR)
        jobs.finish(jobs.run(alerts.alerts_stream(stream), f"{folder}/cp", f"{folder}/out"))
    first = [(m, 100.0, 10) for m in range(6)]
    second = [(6, 110.0, 10), (7, 111.0, 500)]
    BAR = "exchange string, symbol string, bar_time timestamp, close_price double, volume bigint"
    def to_bars(rows):
        base = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
        return spark.createDataFrame([("X", "A", base + dt.timedelta(minutes=m), c, v) for m, c, v in rows], BAR).coalesce(1)
    to_bars(first).write.parquet(f"{folder}/bars")
    run()
    to_bars(second).write.mode("append").parquet(f"{folder}/bars")
    run()
    got = {(r["alert"], r["value"]) for r in spark.read.schema(alerts.ALERT).parquet(f"{folder}/out").collect()}
    assert {a for a, _ in got} == {"price_move", "volume_spike"} and ("volume_spike", 500.0) in got
    batch = alerts.alerts_batch(to_bars(first + second))
    assert {(r["alert"], r["value"]) for r in batch.collect()} == got


BAR = "exchange string, symbol string, bar_time timestamp, close_price double, volume bigint"


def bar_rows(spark, rows):
    """(day offset, symbol, close, volume) rows."""
    base = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    return spark.createDataFrame([("X", s, base + dt.timedelta(days=d), float(c), v) for d, s, c, v in rows], BAR).coalesce(1)


def state_rows(query):
    return [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress][-1]


def test_state_of_an_idle_symbol_expires(spark, folder):
    def run():
        stream = jobs.read_stream(jobs.stream_session(spark, timers=True), f"{folder}/bars", BAR)
        query = jobs.run(alerts.alerts_stream(stream), f"{folder}/cp", f"{folder}/out")
        jobs.finish(query)

    def known():
        state = spark.read.format("statestore").option("stateVarName", "seen").load(f"{folder}/cp")
        return {r["key"]["symbol"] for r in state.collect()}
    first = [(0, "A", 100, 10), (0, "B", 100, 10)]
    bar_rows(spark, first).write.parquet(f"{folder}/bars")
    run()
    assert known() == {"A", "B"}
    second = [(d, "B", 100, 10) for d in range(1, 9)]
    bar_rows(spark, second).write.mode("append").parquet(f"{folder}/bars")
    run()
    assert known() == {"B"}
    third = [(9, "A", 150, 10), (9, "B", 150, 10)]  # a move for B, a new start for A
    bar_rows(spark, third).write.mode("append").parquet(f"{folder}/bars")
    run()
    got = {(r["symbol"], r["alert"]) for r in spark.read.schema(alerts.ALERT).parquet(f"{folder}/out").collect()}
    assert got == {("B", "price_move")}
    assert {(r["symbol"], r["alert"]) for r in alerts.alerts_batch(bar_rows(spark, first + second + third)).collect()} == got


def test_alerts_of_one_batch_start_anew_after_a_gap(spark, folder):
    rows = [(d / 24, "A", 100 + (d % 5) * 3, 10 + 50 * (d % 7 == 6)) for d in range(30)]
    rows += [(20 + d / 24, "A", 140 + (d % 3) * 9, 10 + 80 * (d % 8 == 7)) for d in range(30)] + [(1, "C", 0, 5), (2, "C", 7, 5)]
    bar_rows(spark, rows).write.parquet(f"{folder}/bars")
    stream = jobs.read_stream(jobs.stream_session(spark, timers=True), f"{folder}/bars", BAR)
    jobs.finish(jobs.run(alerts.alerts_stream(stream), f"{folder}/cp", f"{folder}/out"))
    got = {tuple(r) for r in spark.read.schema(alerts.ALERT).parquet(f"{folder}/out").collect()}
    assert got == {tuple(r) for r in alerts.alerts_batch(bar_rows(spark, rows)).collect()} and len(got) > 10


def test_latest_price_state_falls_after_seven_days(spark, folder):
    counts = []
    days = [[(0, s) for s in "ABCD"], [(1, "A"), (6, "A")], [(9, "A")], [(18, "A")]]
    for batch in days:
        ticks(spark, [(24 * 60 * d, 10 + d, 1, s) for d, s in batch]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = jobs.read_stream(jobs.stream_session(spark), f"{folder}/in", TICK)
        query = jobs.run(jobs.latest_price_stream(stream), f"{folder}/cp", mode="update",
                         each_batch=jobs.upsert_newest(f"{folder}/latest", ["exchange", "symbol"], ["ts", "event_id"], ("exchange",)))
        jobs.finish(query)
        counts.append(state_rows(query))
    assert counts[1] == 6 and counts[2] < counts[1] and counts[3] == 1
    assert {r["symbol"]: r["price"] for r in spark.read.parquet(f"{folder}/latest").collect()} == {"A": 28.0, "B": 10.0, "C": 10.0, "D": 10.0}


def test_older_tick_does_not_replace_a_newer_one(spark, folder):
    write = jobs.upsert_newest(f"{folder}/t", ["symbol"], ["ts"], ("exchange",))
    for batch_id, minute in enumerate((5, 9, 2)):
        write(ticks(spark, [(minute, minute, 1)]).select("exchange", "symbol", "ts", "price"), batch_id)
    assert [r["price"] for r in spark.read.parquet(f"{folder}/t").collect()] == [9.0]


def test_a_batch_rewrites_the_days_it_changed(spark, folder):
    def stats(hours, n):
        base = dt.datetime(2025, 1, 1)
        return spark.createDataFrame([(base + dt.timedelta(hours=h), "X", n) for h in hours], "window_start timestamp_ntz, exchange string, files bigint")

    def folders():
        return {d: sorted(os.listdir(f"{folder}/t/{d}")) for d in os.listdir(f"{folder}/t") if d.startswith("window_day")}
    write = jobs.upsert_windows(f"{folder}/t", ["window_start", "exchange"])
    write(stats(range(24 * 30), 1), 0)
    before = folders()
    write(stats([24 * 3 + 5, 24 * 3 + 6], 7), 1)
    after = folders()
    assert len(before) == 30 and [d for d in after if after[d] != before[d]] == ["window_day=2025-01-04"]
    rows = spark.read.parquet(f"{folder}/t")
    assert rows.count() == 24 * 30 and rows.where("files = 7").count() == 2


def test_stream_bars_equal_batch_bars(spark, folder):
    df = ticks(spark, [(i * 0.4, 10 + i % 7, i % 5, "HOT" if i % 3 else f"S{i % 4}") for i in range(600)])
    df.repartition(1).write.parquet(f"{folder}/in")
    bar_run(spark, folder)
    names = ["exchange", "symbol", "bar_time", "open_price", "high_price", "low_price", "close_price", "volume", "trade_count"]
    got = {tuple(r) for r in spark.read.parquet(f"{folder}/out").select(*names).collect()}
    batch = bars.minute_bars(df, session_start="00:00:00", session_end="24:00:00").select(*names)
    last = df.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=1)
    want = {tuple(r) for r in batch.collect() if r["bar_time"] + dt.timedelta(minutes=1) <= last}
    assert got == want and len(got) > 100


def test_continuous_trigger_can_be_stopped(spark, folder):
    ticks(spark, [(0, 10, 1), (5, 11, 1)]).write.parquet(f"{folder}/in")
    stream = jobs.read_stream(spark, f"{folder}/in", TICK)
    query = jobs.run(jobs.latest_price_stream(stream), f"{folder}/cp", mode="update", every="30 seconds",
                     each_batch=jobs.upsert_batch(f"{folder}/latest", ["exchange", "symbol"], ("exchange",)))
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{folder}/latest").first()["price"] == 11.0


def test_listener_reports_every_batch(spark, folder):
    for i in range(3):
        ticks(spark, [(i, 10, 1), (i, -1, 1)]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    own = jobs.stream_session(spark)
    reports = []
    listener = jobs.BatchCountListener(lambda run, counts: reports.append(counts))
    own.streams.addListener(listener)
    try:
        stream = jobs.observed(jobs.read_stream(own, f"{folder}/in", TICK, max_files=1), F.col("price") < 0)
        jobs.finish(jobs.run(stream, f"{folder}/cp", f"{folder}/out"))
        for _ in range(50):
            if sum(r["processed"] for r in reports) == 6:
                break
            time.sleep(0.2)
    finally:
        own.streams.removeListener(listener)
    assert [sum(r[c] for r in reports) for c in ("processed", "loaded", "rejected")] == [6, 3, 3]
    assert len({r["batch_id"] for r in reports}) == 3
