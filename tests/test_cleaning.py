"""Cleaning, reshape and incident rules on small frames."""

import datetime

from pyspark.sql import functions as F

from shelfline.operators import clean, features, islands, joins, reshape, rules
from shelfline.sources import files, jdbc, runlog, tables
from shelfline.session import scratch_path


def daily_row(spark, rows):
    return spark.createDataFrame(rows, "store_id int, product_id int, dt string, sale_amount double, hours_sale array<double>, "
                                       "hours_stock_status array<int>, discount double, holiday_flag int, activity_flag int")


def day(store, dt, out, amount=1.0, slots=24):
    return (store, 1, dt, amount, [1.0] * slots, [1 if h in out else 0 for h in range(24)], 0.9, 0, 1)


def test_null_rows_are_quarantined_and_nothing_is_lost(spark):
    df = daily_row(spark, [day(1, "2024-01-01", ()), day(2, "2024-01-01", (), None), day(3, "2024-01-01", (), -1.0),
                           day(4, "2024-01-01", (), 1.0, 23), (5, 1, "2024-01-01", 1.0, None, None, 1.0, 0, 0)])
    good, bad = clean.split_valid(clean.flag_valid(df))
    assert [r.store_id for r in good.collect()] == [1]
    assert sorted(r.store_id for r in bad.collect()) == [2, 3, 4, 5]


def test_dedup_keeps_latest_then_hash_and_limits_before_the_shuffle(spark):
    rows = [(1, 1, "d", "t1", "a"), (1, 1, "d", "t2", "a"), (1, 1, "d", "t2", "b"), (2, 1, "d", "t1", "z")]
    df = spark.createDataFrame(rows * 50, "store_id int, product_id int, dt string, ingested_at string, source_file_hash string")
    out = clean.dedup_latest(df)
    assert sorted((r.store_id, r.ingested_at, r.source_file_hash) for r in out.collect()) == [(1, "t2", "b"), (2, "t1", "z")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial and final


def test_operational_hours_are_sixteen(spark):
    h = reshape.explode_hourly(daily_row(spark, [day(1, "2024-01-06", ())]))
    assert h.count() == 24
    assert h.filter("is_operational_hour").agg(F.min("hour_of_day"), F.max("hour_of_day"), F.count("*")).first() == (6, 21, 16)
    first = h.orderBy("hour_of_day").first()
    assert first.day_of_week == 7 and first.iso_dow0 == 5 and first.is_weekend
    assert first.event_timestamp == datetime.datetime(2024, 1, 6)


def test_incidents_merge_over_midnight_only_when_asked(spark):
    d = daily_row(spark, [day(1, "2024-01-01", (20, 21)), day(1, "2024-01-02", (6, 7, 9))])
    for span, want in ((True, [2, 2 + 2 - 0]), (False, None)):
        a = sorted((r.incident_start, r.duration_hours) for r in islands.incidents_from_daily(d, span).collect())
        b = sorted((r.incident_start, r.duration_hours) for r in islands.stockout_incidents(reshape.explode_hourly(d), span).collect())
        assert a == b
        hours = sorted(x[1] for x in a)
        assert hours == ([1, 4] if span else [1, 2, 2])


def test_per_day_incidents_need_no_shuffle(spark, sf):
    d = tables.daily(spark, sf)
    plan = islands.incidents_from_daily(d, False)._jdf.queryExecution().executedPlan().toString()
    base = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == base.count("Exchange")


def test_incident_ids_do_not_change(spark, sf):
    d = tables.daily(spark, sf)
    one, two = (sorted(r.incident_id for r in islands.incidents_from_daily(d).select("incident_id").collect()) for _ in range(2))
    assert one == two and len(set(one)) == len(one)


def test_incident_hours_add_up(spark, sf):
    d = tables.daily(spark, sf)
    total = reshape.explode_hourly(d, True).agg(F.sum("stockout_flag")).first()[0]
    assert islands.incidents_from_daily(d).agg(F.sum("duration_hours")).first()[0] == total


def test_json_text_and_arrays_give_the_same(spark):
    d = daily_row(spark, [day(1, "2024-01-01", (8,))])
    text = files.arrays_to_json(d, ["hours_sale", "hours_stock_status"])
    assert clean.flag_valid(text).first().is_valid
    cols = ["hour_of_day", "observed_sales", "stockout_flag"]
    assert reshape.explode_slots(text).select(*cols).collect() == reshape.explode_slots(d).select(*cols).collect()
    rule = rules.array_length("hours_stock_status", elem="int")
    wrong = text.withColumn("hours_stock_status", F.lit('["x"]'))
    assert rules.validate(text, [rule]).first().violations == 0 and rules.validate(wrong, [rule]).first().violations == 1


def test_new_members_survive_a_null(spark):
    src = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    old = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in joins.new_members(src, old, "k").collect()] == [2]


def test_watermark_on_empty_target_takes_all(spark):
    src = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS ts")
    assert joins.after_watermark(src, src.filter("false"), "ts").count() == 1
    assert joins.after_watermark(src, src, "ts").count() == 0


def test_lags_skip_missing_days(spark):
    df = spark.createDataFrame([(1, 1, "2024-01-01", 5.0), (1, 1, "2024-01-03", 7.0), (1, 1, "2024-01-04", 9.0)],
                               "store_id int, product_id int, dt string, sale_amount double")
    rows = {r.dt: r for r in features.rolling_features(features.lag_features(df)).collect()}
    assert rows["2024-01-03"].lag_1 is None and rows["2024-01-03"].lag_2 == 5.0
    assert rows["2024-01-04"].lag_1 == 7.0 and rows["2024-01-04"].roll_mean_3 == 6.0
    assert rows["2024-01-01"].roll_mean_3 is None


def test_write_split_holds_the_whole_input(spark, sf):
    flagged = clean.flag_valid(clean.dedup_latest(tables.bronze(spark, sf)))
    good, bad = clean.write_split(flagged, scratch_path(spark, "split"))
    assert good.count() + bad.count() == flagged.count() and bad.count() > 0


def test_bronze_write_is_idempotent_and_prunes(spark, sf):
    path = scratch_path(spark, "bronze")
    rows = tables.bronze(spark, sf)
    for _ in range(2):
        files.write_bronze(rows, path, "b1", "2024-02-01")
    out = files.read_bronze(spark, path)
    assert out.count() == rows.count()
    files.write_bronze(rows, path, "b2", "2024-02-02")
    one_day = files.read_bronze(spark, path, "2024-02-02", "eval")
    assert one_day.count() == rows.filter("source_split = 'eval'").count()
    assert "PartitionFilters: [isnotnull" in one_day._jdf.queryExecution().executedPlan().toString()


def test_manifest_states(spark):
    schema = "filename string, relative_path string, size_bytes long, sha256 string, source_split string, ingested boolean"
    listed = spark.createDataFrame([("a.parquet", "a.parquet", 1, "x", "train", False), ("b.csv", "b.csv", 1, "y", "eval", True), ("c.parquet", "c.parquet", 1, "z", "eval", False)], schema)
    found = spark.createDataFrame([("a.parquet", "x"), ("b.csv", "other")], "relative_path string, sha256 string")
    states = {r.filename: r.status for r in files.verify_manifest(listed, found).collect()}
    assert states == {"a.parquet": "OK", "b.csv": "CORRUPTED", "c.parquet": "MISSING"}
    assert sorted(r.filename for r in files.pending_files(listed).collect()) == ["a.parquet", "c.parquet"]
    assert sorted(r.filename for r in files.parquet_files(listed).collect()) == ["a.parquet", "c.parquet"]
    assert files.pending_files(files.mark_ingested(listed, "a.parquet")).count() == 1


def test_manifest_hashes_whole_files(spark, sf):
    import hashlib

    row = files.build_manifest(spark, sf, "events.parquet").first()
    with open(f"{sf}/events.parquet", "rb") as f:
        data = f.read()
    assert (row.size_bytes, row.sha256, row.relative_path) == (len(data), hashlib.sha256(data).hexdigest(), "events.parquet")


def test_run_log_counts_come_from_the_write(spark):
    df, seen = runlog.observed(spark.range(10), "x", F.col("id") < 7)
    df.write.format("noop").mode("overwrite").save()
    t = datetime.datetime(2024, 1, 1)
    row = runlog.run_row(spark, "r", "p", t, t + datetime.timedelta(seconds=5), seen.get).first()
    assert (row.source_rows, row.accepted_rows, row.rejected_rows, row.status) == (10, 7, 3, "SUCCESS")


def test_jdbc_filter_reaches_the_source():
    """No database is started: the reader is a stand-in that records its arguments."""
    class Reader:
        def jdbc(self, *args, **kw):
            self.seen = (args, kw)

    class Session:
        read = Reader()

    s = Session()
    jdbc.read_table_jdbc(s, "jdbc:x", "silver.daily", "dt = DATE '2024-01-01'", user="u")
    assert s.read.seen == (("jdbc:x", "(SELECT * FROM silver.daily WHERE dt = DATE '2024-01-01') AS src"), {"properties": {"user": "u"}})
    jdbc.read_table_jdbc(s, "jdbc:x", "silver.daily", partition=("store_id", 1, 900, 64))
    assert s.read.seen[1]["numPartitions"] == 64 and s.read.seen[1]["column"] == "store_id"
