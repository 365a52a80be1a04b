"""Velocity queries: batch forms, streams over the event file, and replay."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from shelfline.plans.catalog import POS, query, rounded
from shelfline.session import scratch_path
from shelfline.sources import tables
from shelfline.streaming import silence
from shelfline.streaming import velocity as v

VEL = POS + """, spread AS (SELECT store_id, product_id, transaction_id, units_sold, time_bucket(INTERVAL 10 MINUTE, timestamp) - INTERVAL 10 MINUTE * i AS window_start
  FROM pos CROSS JOIN (SELECT unnest(range(12)) AS i)
), vel AS (SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, store_id, product_id, count(transaction_id) AS transaction_count, round(avg(units_sold), 6) AS avg_units_per_tx FROM spread GROUP BY ALL
), flags AS (SELECT *, CASE WHEN transaction_count = 0 THEN 'CRITICAL_STOCKOUT' WHEN transaction_count < 3 THEN 'WARNING_LOW_VELOCITY' ELSE 'NORMAL' END AS anomaly_flag FROM vel)"""


def pos_stream(spark, sf):
    """The event file as a stream of sales."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = v.read_pos_stream(spark, sf, schema, pattern="events.parquet")
    return raw.selectExpr(*tables.POS_COLUMNS)


def sales(spark, sf):
    """The sales as a history to replay."""
    return tables.pos(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def last_alerts(spark, sf, name):
    """The alerts that stand after the last slice; normal windows are stored too, as a later slice can take an alert back."""
    emitted = v.replay(sales(spark, sf), scratch_path(spark, name), [], lambda raw: v.flagged(v.velocity(v.with_event_time(raw))))
    return v.last_update(emitted).filter("anomaly_flag <> 'NORMAL'")


@query("st1_watermark_append", ctes=VEL, sql="SELECT * EXCLUDE (anomaly_flag) FROM flags WHERE window_end <= (SELECT time_bucket(INTERVAL 1 MICROSECOND, max(timestamp)) - INTERVAL 15 MINUTE FROM pos)")
def _(spark, sf):
    """Append mode emits the windows that the watermark has closed."""
    emitted = v.replay(sales(spark, sf), scratch_path(spark, "append"), [], lambda raw: v.velocity(v.with_event_time(raw)), "append")
    return rounded(emitted.drop("batch_id", "alone"))


@query("st2_sliding_windows", ctes=VEL, sql="SELECT window_start, window_end, store_id, product_id, transaction_count FROM vel")
def _(spark, sf):
    return v.velocity(tables.pos(spark, sf)).drop("avg_units_per_tx")


@query("st3_velocity", ctes=VEL, sql="SELECT * FROM vel")
def _(spark, sf):
    return rounded(v.velocity_batch(tables.pos(spark, sf)))


@query("st4_anomaly_flag", ctes=VEL, sql="SELECT anomaly_flag, store_id, count(*) AS n FROM flags GROUP BY ALL")
def _(spark, sf):
    return v.flagged(v.velocity_batch(tables.pos(spark, sf))).groupBy("anomaly_flag", "store_id").agg(F.count("*").alias("n"))


@query("st5_alerts", ctes=VEL, sql="SELECT * FROM flags WHERE anomaly_flag <> 'NORMAL'")
def _(spark, sf):
    return rounded(v.alerts(v.velocity_batch(tables.pos(spark, sf))))


@query("st6_update_stream", ctes=VEL, sql="SELECT * FROM flags WHERE anomaly_flag <> 'NORMAL'")
def _(spark, sf):
    """Source, watermark, windows, flag, filter and sink as a running stream in update mode."""
    return rounded(last_alerts(spark, sf, "update"))


@query("io8_pos_stream", ctes=POS, sql="SELECT store_id, product_id, count(*) AS n, round(sum(units_sold), 4) AS units FROM pos GROUP BY ALL")
def _(spark, sf):
    """The streaming source, one file per trigger, summed per series after the run."""
    base = scratch_path(spark, "source")
    emitted = v.run_update(pos_stream(spark, sf), base + "/out", base + "/ckpt", "append")
    return rounded(emitted.groupBy("store_id", "product_id").agg(F.count("*").alias("n"), F.sum("units_sold").alias("units")), 4)


@query("io9_alert_sink", ctes=VEL, sql="SELECT anomaly_flag, count(*) AS n FROM flags WHERE anomaly_flag <> 'NORMAL' GROUP BY ALL")
def _(spark, sf):
    return last_alerts(spark, sf, "sink").groupBy("anomaly_flag").agg(F.count("*").alias("n"))


@query("st7_zero_velocity", ctes=VEL, sql="""SELECT s.store_id, s.product_id, g.window_start, g.window_start + INTERVAL 2 HOUR AS window_end, CAST(0 AS BIGINT) AS transaction_count, 'CRITICAL_STOCKOUT' AS anomaly_flag
FROM (SELECT DISTINCT store_id, product_id FROM pos) s CROSS JOIN (SELECT unnest(range(min(window_start), max(window_start) + INTERVAL 10 MINUTE, INTERVAL 10 MINUTE)) AS window_start FROM vel) g
ANTI JOIN vel ON vel.store_id = s.store_id AND vel.product_id = s.product_id AND vel.window_start = g.window_start""")
def _(spark, sf):
    return v.zero_velocity(tables.pos(spark, sf))


BUSY = POS + """, busy AS (SELECT DISTINCT store_id, product_id, time_bucket(INTERVAL 10 MINUTE, timestamp) AS b FROM pos
), span AS (SELECT min(b) - INTERVAL 110 MINUTE AS lo, max(b) AS hi FROM busy
), steps AS (SELECT *, lead(b) OVER (PARTITION BY store_id, product_id ORDER BY b) AS nxt, lag(b) OVER (PARTITION BY store_id, product_id ORDER BY b) AS prv FROM busy)"""


@query("st7_silent_intervals", ctes=BUSY, sql="""SELECT store_id, product_id, first_start, last_start FROM (
SELECT store_id, product_id, lo AS first_start, b - INTERVAL 2 HOUR AS last_start FROM steps CROSS JOIN span WHERE prv IS NULL
UNION ALL SELECT store_id, product_id, b + INTERVAL 10 MINUTE, coalesce(nxt - INTERVAL 2 HOUR, hi) FROM steps CROSS JOIN span) WHERE first_start <= last_start""")
def _(spark, sf):
    """Runs of empty windows, one row for each."""
    return v.silent_intervals(tables.pos(spark, sf))


@query("st7_silent_stream", ctes=BUSY, sql="""SELECT store_id, product_id, b + INTERVAL 10 MINUTE AS first_start, nxt - INTERVAL 2 HOUR AS last_start FROM steps
WHERE b + INTERVAL 10 MINUTE <= nxt - INTERVAL 2 HOUR""")
def _(spark, sf):
    """The closed gaps of a stream that gets the history in three slices."""
    base = scratch_path(spark, "silent")
    history = tables.pos(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for _ in v.released(history, base + "/in", ["2024-01-10", "2024-01-20"]):
        found = v.run_silent(v.read_pos_stream(spark, base + "/in", history.schema, max_files=None), base, base + "/ckpt")
    return found.filter("NOT open").select("store_id", "product_id", "first_start", "last_start")


@query("st7_silence_timers", ctes=BUSY + """, marks AS (SELECT max(timestamp) - INTERVAL 15 MINUTE AS mark FROM pos
  UNION ALL SELECT max(timestamp) - INTERVAL 15 MINUTE FROM pos WHERE timestamp < TIMESTAMP '2024-01-10'
  UNION ALL SELECT max(timestamp) - INTERVAL 15 MINUTE FROM pos WHERE timestamp < TIMESTAMP '2024-01-20'
), settled AS (SELECT mark, store_id, product_id, max(b) AS b FROM busy JOIN marks ON b + INTERVAL 10 MINUTE <= mark GROUP BY ALL)""",
       sql="""SELECT store_id, product_id, b + INTERVAL 10 MINUTE AS first_start, nxt - INTERVAL 2 HOUR AS last_start, false AS open FROM steps
WHERE b + INTERVAL 130 MINUTE <= nxt AND nxt + INTERVAL 10 MINUTE <= (SELECT max(mark) FROM marks)
UNION ALL SELECT DISTINCT store_id, product_id, b + INTERVAL 10 MINUTE, CAST(NULL AS TIMESTAMP), true FROM settled WHERE b + INTERVAL 130 MINUTE <= mark""")
def _(spark, sf):
    """Alerts of silent series at their timers, and the closed gaps, of a history that comes in three slices."""
    base, history = scratch_path(spark, "timers"), sales(spark, sf)
    width = silence.parts(history)
    for _ in v.released(history, base + "/in", ["2024-01-10", "2024-01-20"]):
        found = silence.run_silence(v.read_pos_stream(spark, base + "/in", history.schema, max_files=None), base, width=width, lifetime=timedelta(days=366))
    return found


@query("st8_replay", ctes=VEL, sql="SELECT * EXCLUDE (anomaly_flag) FROM flags")
def _(spark, sf):
    """History replayed in event-time slices gives the batch result."""
    emitted = v.replay(sales(spark, sf), scratch_path(spark, "replay"), ["2024-01-10", "2024-01-20"], lambda raw: v.velocity(v.with_event_time(raw)))
    return rounded(v.last_update(emitted))
