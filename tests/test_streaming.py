"""Streams give what the batch forms give."""

import datetime

from pyspark.sql import functions as F

from shelfline.session import scratch_path
from shelfline.streaming import silence
from shelfline.streaming import velocity as v


def sales(spark):
    t0 = datetime.datetime(2024, 1, 1, 8)
    rows = [(t0 + datetime.timedelta(minutes=7 * i), 1 + i % 2, 1, i if i % 5 else None, float(i)) for i in range(60)]
    return spark.createDataFrame(rows, "timestamp timestamp, store_id int, product_id int, transaction_id bigint, units_sold double")


def key(df):
    return sorted(tuple(r[c] for c in ("window_start", "window_end", "store_id", "product_id", "transaction_count")) for r in df.collect())


def test_each_row_is_in_twelve_windows(spark):
    df = sales(spark).limit(1).withColumn("transaction_id", F.lit(1).cast("bigint"))
    assert v.velocity(df).count() == 12


def test_bucketed_batch_equals_window_batch(spark):
    assert key(v.velocity(sales(spark))) == key(v.velocity_batch(sales(spark)))


def test_replayed_stream_equals_batch(spark):
    history = sales(spark)  # several files per slice
    emitted = v.replay(history, scratch_path(spark, "replay"), ["2024-01-01 10:00:00", "2024-01-01 12:00:00"],
                       lambda raw: v.velocity(v.with_event_time(raw)))
    assert emitted.select("batch_id").distinct().count() >= 3
    assert key(v.last_update(emitted)) == key(v.velocity(history))


def test_late_rows_are_dropped(spark):
    base = scratch_path(spark, "late")
    history = sales(spark)
    for part in ("timestamp >= '2024-01-01 10:00:00'", "timestamp < '2024-01-01 10:00:00'"):
        history.filter(part).write.mode("append").parquet(base + "/in")
        stream = v.velocity(v.with_event_time(v.read_pos_stream(spark, base + "/in", history.schema, max_files=100)))
        emitted = v.run_update(stream, base + "/out", base + "/ckpt")
    total = v.last_update(emitted).agg(F.sum("transaction_count")).first()[0]
    assert total < v.velocity(history).agg(F.sum("transaction_count")).first()[0]


def test_silent_windows_fire(spark):
    t = datetime.datetime(2024, 1, 1, 8)
    rows = [(t, 1, 1, 1, 1.0), (t + datetime.timedelta(hours=6), 1, 1, 2, 1.0), (t + datetime.timedelta(hours=3), 2, 1, 3, 1.0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, store_id int, product_id int, transaction_id bigint, units_sold double")
    silent = v.zero_velocity(df)
    busy = v.velocity_batch(df)
    grid = 1 + (6 * 60 + 110) // 10  # windows from 110 minutes before the first to the last interval
    for store in (1, 2):
        s = {r.window_start for r in silent.filter(F.col("store_id") == store).collect()}
        b = {r.window_start for r in busy.filter(F.col("store_id") == store).collect()}
        assert not s & b and len(s | b) == grid
    assert set(r.anomaly_flag for r in silent.collect()) == {"CRITICAL_STOCKOUT"}


def test_a_missing_folder_fails(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        v.read_pos_stream(spark, "/tmp/no-such-folder-here").writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "c")).start()


def test_silent_series_are_open_until_they_sell(spark):
    t = datetime.datetime(2024, 1, 1, 8)
    rows = [(t, 1, 1, 1, 1.0), (t, 2, 1, 2, 1.0), (t + datetime.timedelta(hours=5), 1, 1, 3, 1.0), (t + datetime.timedelta(hours=9), 2, 1, 4, 1.0)]
    history = spark.createDataFrame(rows, "timestamp timestamp, store_id int, product_id int, transaction_id bigint, units_sold double")
    base, seen = scratch_path(spark, "silent"), []
    for _ in v.released(history, base + "/in", ["2024-01-01 09:00:00", "2024-01-01 14:00:00"]):
        found = v.run_silent(v.read_pos_stream(spark, base + "/in", history.schema, max_files=None), base, base + "/ckpt")
        last = found.agg(F.max("batch_id")).first()[0]
        seen.append(sorted((r.store_id, r.open) for r in found.filter(F.col("batch_id") == last).collect()) if last is not None else [])
    # the second slice closes the gap of store 1 while store 2 is silent; the third closes that of store 2 and leaves store 1 silent
    assert seen[1] == [(1, False), (2, True)] and seen[2] == [(1, True), (2, False)]
    closed = {(r.store_id, r.first_start, r.last_start) for r in found.filter("NOT open").collect()}
    batch = {(r.store_id, r.first_start, r.last_start) for r in v.silent_intervals(history.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))).collect()}
    assert closed <= batch


SALE = "timestamp timestamp, store_id int, product_id int, transaction_id bigint, units_sold double"


def at(hours):
    return datetime.datetime(2024, 1, 1, 8) + datetime.timedelta(hours=hours)


def feed(spark, base, rows, **settings):
    """One slice of sales as one run; all rows found so far and the most state rows that a batch of the run changed."""
    spark.createDataFrame([(t, store, 1, 1, 1.0) for t, store in rows], SALE).coalesce(1).write.mode("append").parquet(base + "/in")
    query = silence.start_silence(v.read_pos_stream(spark, base + "/in", max_files=None), base, **settings)
    query.awaitTermination()
    changed = [op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"] if op["operatorName"].startswith("transformWithState")]
    found = spark.read.schema(silence.FOUND).parquet(base + "/silence").collect()
    return sorted(((r.store_id or 0, r.first_start, r.last_start, r.open) for r in found), key=str), max(changed, default=0)


def test_silence_is_reported_by_its_timer(spark):
    base, minutes = scratch_path(spark, "timers"), datetime.timedelta(minutes=1)
    found, _ = feed(spark, base, [(at(0), 1), (at(0), 1), (at(0), 2), (at(1), 2)])
    assert found == []
    # store 1 does not sell again: the watermark of the sales of store 2 wakes it; its own gap is closed later
    found, _ = feed(spark, base, [(at(2.5), 2)])
    assert found == [(1, at(0) + 10 * minutes, None, True)]
    found, _ = feed(spark, base, [(at(6), 1), (at(6.5), 2), (at(8), 2)])
    closed = {(r.store_id, r.first_start, r.last_start) for r in v.silent_intervals(
        spark.createDataFrame([(at(0), 1), (at(6), 1)], "timestamp timestamp_ntz, store_id int").withColumn("product_id", F.lit(1))).collect()}
    assert {f[:3] for f in found if f[0] == 1 and not f[3]} <= closed
    assert (1, at(0) + 10 * minutes, at(4), False) in found
    assert (2, at(2.5) + 10 * minutes, at(4.5), False) in found


def test_late_sales_split_no_settled_silence(spark):
    """A sale that is late within the delay moves the end of the gap, whatever batch it comes in; a later one is dropped."""
    base = scratch_path(spark, "timers")
    feed(spark, base, [(at(0), 1), (at(4), 1)])
    feed(spark, base, [(at(3.8), 1), (at(1), 1)])
    found, _ = feed(spark, base, [(at(5), 1), (None, 1)])
    assert [f[1:] for f in found if not f[3]] == [(at(0) + datetime.timedelta(minutes=10), at(3.8).replace(minute=40) - datetime.timedelta(hours=2), False)]


def test_state_changes_with_active_series_only(spark):
    base = scratch_path(spark, "timers")
    _, first = feed(spark, base, [(at(0), s) for s in range(1, 41)] + [(at(0.5), 1)])
    _, second = feed(spark, base, [(at(1), 1)])
    assert first >= 40 > 8 >= second


def test_series_share_state_rows(spark, monkeypatch):
    """However many series sell, a batch changes no more state rows than there are buckets, and the events stay those of each series."""
    monkeypatch.setattr(silence, "BUCKETS", 4, raising=False)
    base, ten = scratch_path(spark, "timers"), datetime.timedelta(minutes=10)
    _, first = feed(spark, base, [(at(s / 60), s) for s in range(1, 41)])
    found, second = feed(spark, base, [(at(4 + s / 60), s) for s in range(1, 39)] + [(at(6), 41)])
    assert first <= 4 and second <= 4
    busy = lambda hours: at(hours).replace(minute=at(hours).minute // 10 * 10)
    # 38 gaps are closed by a sale, and the two series that sold once are reported by their timers
    closed = {(s, busy(s / 60) + ten, busy(4 + s / 60) - 12 * ten) for s in range(1, 39)}
    assert {f[:3] for f in found if not f[3]} == closed
    assert {f[:2] for f in found if f[3]} == {(s, busy(s / 60) + ten) for s in (39, 40)}


def test_state_has_as_many_parts_as_sales_ask_for(spark, monkeypatch):
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    assert silence.parts(sales(spark)) == min(cores, int(before))
    monkeypatch.setattr(silence, "PART_ROWS", 1)
    assert silence.parts(sales(spark)) == 60
    base = scratch_path(spark, "timers")
    sales(spark).write.parquet(base + "/in")
    query = silence.start_silence(v.read_pos_stream(spark, base + "/in", max_files=None), base, width=3)
    query.awaitTermination()
    assert {op["numShufflePartitions"] for p in query.recentProgress for op in p["stateOperators"]} == {3}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_forgotten_series_starts_anew(spark):
    base, day = scratch_path(spark, "timers"), datetime.timedelta(hours=24)
    feed(spark, base, [(at(0), 1), (at(0), None)], lifetime=day)
    feed(spark, base, [(at(30), 2)], lifetime=day)
    found, _ = feed(spark, base, [(at(40), 1), (at(42), 2), (at(43), 2)], lifetime=day)
    ten = datetime.timedelta(minutes=10)
    assert [f[1:] for f in found if f[0] == 1] == [(at(0) + ten, None, True), (at(40) + ten, None, True)]
    assert [f[1:] for f in found if f[0] == 0] == [(at(0) + ten, None, True)]  # a null store is a series too


def test_a_replay_holds_the_state_of_one_slice(spark, sf, monkeypatch):
    """Slices of few sales: the state never holds the windows of the whole history, and alerts that a later slice takes back are gone."""
    from shelfline.plans import load_all
    from tests.compare import connect, difference

    queries, oracle = load_all()
    held = []
    write = v.write_alerts

    def watched(*args):
        query = write(*args)
        query.awaitTermination()
        held.append(max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]))
        return query

    monkeypatch.setattr(v, "write_alerts", watched)
    monkeypatch.setattr(v, "SLICE_ROWS", 300)
    for name in ("st1_watermark_append", "st6_update_stream", "io9_alert_sink"):
        held.clear()
        assert difference(queries[name](spark, sf), connect(sf), oracle[name]) is None, name
        assert len(held) > 2 and max(held) < 1.5 * 300 * 12, name


def test_slices_hold_few_sales_and_lie_in_order(spark):
    history = sales(spark)
    parts = [(lo, hi, [r.timestamp for r in df.collect()]) for lo, hi, df in v.sliced(history, scratch_path(spark, "s"), ["2024-01-01 10:05:00"], rows=9)]
    assert sorted(t for _, _, part in parts for t in part) == sorted(r.timestamp for r in history.collect())
    assert max(len(part) for _, _, part in parts) <= 9 and any(hi == "2024-01-01 10:05:00" for _, hi, _ in parts)
    for lo, hi, part in parts:
        assert (lo is None or str(min(part)) >= lo) and (hi is None or str(max(part)) < hi)
