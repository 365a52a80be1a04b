"""Silence of a series as streaming state with event-time timers.

Series are dealt by hash to buckets, and each bucket keeps one state row: for each of its series the last settled busy interval,
whether its silence was reported, and the intervals that the watermark has not closed yet. A timer wakes the bucket when the next
of them closes, when the next window of a series is wholly empty, and again when a lifetime ends; other buckets are neither read nor
written. A call of the state costs about a millisecond whatever it holds, so calls are made by bucket and their number is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from shelfline.session import shuffle_width
from shelfline.streaming.velocity import DELAY, SERIES, SIZE_MIN, SLIDE_MIN

MINUTE = 60_000
#: state rows that the series share; a checkpoint is bound to it
BUCKETS = 4096
#: sales of a history for each part of the state
PART_ROWS = 1_000_000
#: sales that a task packs at a time, and packs that it hands on in one Arrow batch
PACK_ROWS, PACK_OUT = 500_000, 10_000
_KEYS = [StructField(c, IntegerType()) for c in SERIES]
_STARTS = ArrayType(LongType())
STATE = StructType([StructField("timer", LongType()), StructField("series", ArrayType(StructType([
    *_KEYS, StructField("last", LongType()), StructField("reported", BooleanType()), StructField("pending", _STARTS)])))])
SETTLED = StructType([*_KEYS, StructField("starts", _STARTS), StructField("silent", LongType())])
_SERIES_DDL = ", ".join(f"{c} int" for c in SERIES)
FOUND = f"{_SERIES_DDL}, first_start timestamp_ntz, last_start timestamp_ntz, open boolean"
# The settings that state with timers needs, and that let it upload changes only.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


class SilenceProcessor(StatefulProcessor):
    """Settles the busy intervals of each series of a bucket (start in milliseconds) in order of time, and reports their silence."""

    def __init__(self, size_ms: int, slide_ms: int, lifetime_ms: int) -> None:
        self.size, self.slide, self.lifetime = size_ms, slide_ms, lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("silence", STATE)

    def known(self) -> tuple[int | None, dict]:
        """The timer of the bucket and (last, reported, pending) of each of its series."""
        timer, series = self.state.get() or (None, [])
        return timer, {tuple(s[:len(SERIES)]): tuple(s[len(SERIES):]) for s in series}

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark, fresh = timerValues.getCurrentWatermarkInMs(), {}
        for row in rows:
            starts = [b for b in row.starts if b + self.slide > watermark]
            if starts:
                fresh.setdefault(tuple(row[c] for c in SERIES), set()).update(starts)
        if fresh:
            timer, series = self.known()
            for one, starts in fresh.items():
                last, reported, pending = series.get(one, (None, False, []))
                series[one] = last, reported, sorted(starts.union(pending))
            yield from self.settle(timer, series, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        timer, series = self.known()
        # a timer that fires is gone; one that was replaced in this batch is not
        timer = None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer
        yield from self.settle(timer, series, timerValues.getCurrentWatermarkInMs())

    def settle(self, timer, series, watermark) -> Iterator[Row]:
        """Settles what the watermark has closed, reports silences that are due, moves the timer and stores the state."""
        kept, dues = [], []
        for one, (last, reported, pending) in series.items():
            closed = [b for b in pending if b + self.slide <= watermark]
            pending, starts, silent = list(pending[len(closed):]), [*([] if last is None else [last]), *closed], None
            if closed:
                last, reported = closed[-1], False
            if last is not None and not reported and last + self.slide + self.size <= watermark:
                silent, reported = last + self.slide, True
            if closed and len(starts) > 1 or silent is not None:
                yield Row(**dict(zip(SERIES, one)), starts=starts, silent=silent)
            if last is not None and last + self.lifetime <= watermark:
                last, reported = None, False
            if last is not None:
                dues.append(last + (self.lifetime if reported else self.slide + self.size))
            if pending:
                dues.append(pending[0] + self.slide)
            if last is not None or pending:
                kept.append((*one, last, reported, pending))
        due = min(dues, default=None)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.state.clear()
        else:
            if timer != due:
                self.handle.registerTimer(due)
            self.state.update((due, kept))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Arrow batches gathered to tables of PACK_ROWS rows or little more."""
    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= PACK_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each busy interval of a series once for each table."""
    for table in _tables(batches):
        yield from table.group_by(["bucket", *SERIES, "b"], use_threads=False).aggregate([]).select(["bucket", *SERIES, "b"]).to_batches(PACK_OUT)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each series of a table, with its busy intervals."""
    for table in _tables(batches):
        packs = table.group_by(["bucket", *SERIES], use_threads=False).aggregate([("b", "distinct")])
        yield from packs.select(["bucket", *SERIES, "b_distinct"]).rename_columns(["bucket", *SERIES, "starts"]).to_batches(PACK_OUT)


def silence(stream: DataFrame, size_min: int = SIZE_MIN, slide_min: int = SLIDE_MIN, lifetime: timedelta = timedelta(days=7)) -> DataFrame:
    """(series, first_start, last_start, open) of a stream of sales with a watermark on ``timestamp``.

    A row with ``open`` true says that all windows from ``first_start`` on are empty; it comes from a timer, when the watermark
    has passed the first of them, without a new sale. A row with ``open`` false closes the run with its last empty window.
    A silence that begins and ends between two micro-batches gives the closed row only. A series that is silent for ``lifetime``
    after its last busy interval is forgotten: its next sale starts it anew and closes nothing.

    Sales become slide intervals, which the map tasks hand on once for each PACK_ROWS sales, so a hot series does not send each sale,
    and reach the state as one row for each series and PACK_ROWS intervals. The state holds those that the watermark
    has not closed and puts late rows in order. Intervals that the watermark has closed and rows without a time are dropped;
    a null store or product is a series of its own; repeated rows change nothing.
    """
    if lifetime < timedelta(minutes=size_min + slide_min):
        raise ValueError("a series must live until its first empty window ends")
    size, slide, ms = size_min * MINUTE, slide_min * MINUTE, F.unix_millis("timestamp")
    bucket = F.pmod(F.hash(*SERIES), F.lit(BUCKETS)).alias("bucket")
    rows = stream.filter("timestamp IS NOT NULL").select(bucket, *[F.col(c).cast("int") for c in SERIES], (ms - F.pmod(ms, F.lit(slide))).alias("b"))
    sent = rows.mapInArrow(_distinct, f"bucket int, {_SERIES_DDL}, b bigint").repartition("bucket")
    settled = sent.mapInArrow(_packed, f"bucket int, {_SERIES_DDL}, starts array<bigint>").groupBy("bucket").transformWithState(
        SilenceProcessor(size, slide, lifetime // timedelta(milliseconds=1)), outputStructType=SETTLED, outputMode="Append", timeMode="EventTime")
    run = lambda first, last, is_open: F.struct(first.alias("first"), last.cast("bigint").alias("last"), F.lit(is_open).alias("open"))
    steps = F.zip_with("starts", F.slice("starts", 2, F.size("starts")), lambda b, after: F.struct(b.alias("b"), after.alias("after")))
    gaps = F.transform(F.filter(steps, lambda s: s["b"] + slide <= s["after"] - size), lambda s: run(s["b"] + slide, s["after"] - size, False))
    alert = F.filter(F.array(run(F.col("silent"), F.lit(None), True)), lambda r: r["first"].isNotNull())
    found = settled.select(*SERIES, F.inline(F.concat(gaps, alert)))
    at = lambda c: F.timestamp_millis(F.col(c)).cast("timestamp_ntz").alias(f"{c}_start")
    return found.select(*SERIES, at("first"), at("last"), "open")


def parts(history: DataFrame) -> int:
    """Parts of the state for a history of sales: opening and committing one costs some tenths of a second in each batch, so
    there are no more of them than its rows or the cores ask for."""
    spark = history.sparkSession
    return max(-(-history.count() // PART_ROWS), min(shuffle_width(spark), spark.sparkContext.defaultParallelism))


@contextmanager
def state_store(spark: SparkSession, width: int | None = None):
    """The state settings, with ``width`` parts where given, for streams started inside; the session's own come back afterwards."""
    settings = {**STORE, **({} if width is None else {"spark.sql.shuffle.partitions": str(width)})}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        yield
    finally:
        for k, value in before.items():
            if value is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, value)


def start_silence(stream: DataFrame, base: str, delay: str = DELAY, width: int | None = None, **settings) -> StreamingQuery:
    """Starts ``silence`` over what is available, going on from the checkpoint below ``base``, and appends its rows to ``base/silence``.

    ``width`` is the number of parts of the state, by default the session's; a checkpoint keeps the first one.
    The file sink keeps a log of its finished batches, so a batch that is repeated after a failure is read once.
    """
    found = silence(stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay), **settings)
    with state_store(stream.sparkSession, width):
        return (found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/ckpt")
                .trigger(availableNow=True).start(f"{base}/silence"))


def run_silence(stream: DataFrame, base: str, delay: str = DELAY, width: int | None = None, **settings) -> DataFrame:
    """All rows of ``silence`` that are written once the available sales are read."""
    start_silence(stream, base, delay, width, **settings).awaitTermination()
    return stream.sparkSession.read.schema(FOUND).parquet(f"{base}/silence")
