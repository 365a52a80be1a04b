"""Sales velocity in sliding windows, as a stream and in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.session import shuffle_width

SERIES = ["store_id", "product_id"]
# Window, slide, watermark delay, warning threshold.
SIZE, SLIDE, DELAY, LOW = "2 hours", "10 minutes", "15 minutes", 3
SIZE_MIN, SLIDE_MIN = 120, 10
#: sales that one micro-batch of a replay may hold; each puts up to twelve windows into the state store
SLICE_ROWS = 1_000_000
POS_SCHEMA = "timestamp timestamp, store_id int, product_id int, transaction_id bigint, units_sold double"


def read_pos_stream(spark: SparkSession, path: str, schema=POS_SCHEMA, max_files: int | None = 1, pattern: str = "*.parquet") -> DataFrame:
    """A Parquet folder as a stream; ``max_files`` None takes all new files in one micro-batch. The schema is explicit:
    a folder that is missing or differs fails at the start instead of giving an empty stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).parquet(path)


def with_event_time(stream: DataFrame, delay: str = DELAY, col: str = "timestamp") -> DataFrame:
    """Event-time watermark; a zone-free column becomes a timestamp, which watermarks need."""
    return stream.withColumn(col, F.col(col).cast("timestamp")).withWatermark(col, delay)


def _flat(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *SERIES, "transaction_count", "avg_units_per_tx")


def velocity(df: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """Transactions and mean units per sliding window and series; works on streams."""
    return _flat(
        df.groupBy(F.window("timestamp", size, slide), *SERIES).agg(
            F.count("transaction_id").alias("transaction_count"), F.avg("units_sold").alias("avg_units_per_tx")))


def velocity_batch(df: DataFrame, size_min: int = SIZE_MIN, slide_min: int = SLIDE_MIN) -> DataFrame:
    """The same result for a batch: rows are first summed per slide interval, so a busy
    series sends one row per interval into the twelve windows that hold it instead of
    twelve copies of each sale."""
    start = F.window("timestamp", f"{slide_min} minutes")["start"].cast("timestamp_ntz")
    buckets = df.groupBy(start.alias("b"), *SERIES).agg(
        F.count("transaction_id").alias("n"), F.sum("units_sold").alias("units"), F.count("units_sold").alias("m"))
    back = F.explode(F.sequence(F.lit(0), F.lit(size_min - slide_min), F.lit(slide_min))).alias("back")
    spread = buckets.select("*", back).withColumn("window_start", F.col("b") - F.make_dt_interval(F.lit(0), F.lit(0), F.col("back")))
    return spread.groupBy("window_start", *SERIES).agg(
        F.sum("n").alias("transaction_count"), (F.sum("units") / F.nullif(F.sum("m"), F.lit(0))).alias("avg_units_per_tx")
    ).withColumn("window_end", F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(size_min)))


def anomaly_flag(n: Column, low: int = LOW) -> Column:
    return F.when(n == 0, "CRITICAL_STOCKOUT").when(n < low, "WARNING_LOW_VELOCITY").otherwise("NORMAL")


def flagged(windows: DataFrame) -> DataFrame:
    return windows.withColumn("anomaly_flag", anomaly_flag(F.col("transaction_count")))


def alerts(windows: DataFrame) -> DataFrame:
    return flagged(windows).filter("anomaly_flag <> 'NORMAL'")


def write_alerts(stream: DataFrame, path: str, checkpoint: str, mode: str = "update"):
    """Start the alert sink: each micro-batch is appended with its number.

    The batch number is a partition, and a batch that is repeated after a failure
    replaces its own partition, so restarts do not double rows.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(store).start()
    )


def run_update(windows: DataFrame, path: str, checkpoint: str, mode: str = "update") -> DataFrame:
    """Run a windowed stream over everything available; returns all emitted rows."""
    write_alerts(windows, path, checkpoint, mode).awaitTermination()
    return windows.sparkSession.read.option("basePath", path).parquet(f"{path}/batch_id=*")


def last_update(emitted: DataFrame, keys=("window_start", "window_end", *SERIES)) -> DataFrame:
    """The newest emitted row per window and series; rows of ``replay`` that only one slice can emit are not grouped."""
    values = [c for c in emitted.columns if c not in (*keys, "batch_id", "alone")]
    once, again = (emitted.filter("alone"), emitted.filter("NOT alone")) if "alone" in emitted.columns else (None, emitted)
    best = again.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v")).select(*keys, "v.*")
    return best if once is None else once.select(*keys, *values).unionByName(best)


def _minutes(m: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m))


def busy_intervals(df: DataFrame, slide_min: int = SLIDE_MIN) -> DataFrame:
    """(series, b): the slide intervals in which a series sold something."""
    start = F.window("timestamp", f"{slide_min} minutes")["start"].cast("timestamp_ntz")
    return df.select(*SERIES, start.alias("b")).distinct()


def _gap(before: Column, after: Column, size_min: int, slide_min: int) -> Column:
    """Starts of the first and last window that lie wholly between two busy intervals."""
    return F.struct((before + _minutes(slide_min)).alias("first_start"), (after - _minutes(size_min)).alias("last_start"))


def silent_intervals(df: DataFrame, size_min: int = SIZE_MIN, slide_min: int = SLIDE_MIN) -> DataFrame:
    """(series, first_start, last_start): runs of windows without a sale, between the first and last window of the data.

    Empty windows lie in the gaps between the busy intervals of a series; no grid of all windows and
    series is joined. There is a row for each gap, however long. A window
    partition holds the distinct intervals of a series and is bounded by the calendar.
    """
    busy = busy_intervals(df, slide_min)
    span = busy.agg((F.min("b") - _minutes(size_min - slide_min)).alias("lo"), F.max("b").alias("hi"))
    w = Window.partitionBy(*SERIES).orderBy("b")
    gaps = busy.join(F.broadcast(span)).select(  # one row
        *SERIES, "lo", "hi", "b", F.lag("b").over(w).alias("prev"), F.lead("b").over(w).alias("next"))
    # the first row of a series also opens the gap before it
    before = F.when(F.col("prev").isNull(), _gap(F.col("lo") - _minutes(slide_min), F.col("b"), size_min, slide_min))
    after = _gap(F.col("b"), F.coalesce(F.col("next"), F.col("hi") + _minutes(size_min)), size_min, slide_min)
    found = gaps.select(*SERIES, F.explode(F.array(before, after)).alias("g"))
    return found.filter("g IS NOT NULL AND g.first_start <= g.last_start").select(*SERIES, "g.first_start", "g.last_start")


def zero_velocity(df: DataFrame, size_min: int = SIZE_MIN, slide_min: int = SLIDE_MIN) -> DataFrame:
    """The windows of ``silent_intervals`` one by one."""
    found = silent_intervals(df, size_min, slide_min)
    return found.select(*SERIES, F.explode(F.sequence("first_start", "last_start", _minutes(slide_min))).alias("window_start")).withColumns({
        "window_end": F.col("window_start") + _minutes(size_min), "transaction_count": F.lit(0).cast("bigint"),
        "anomaly_flag": F.lit("CRITICAL_STOCKOUT")})


def run_silent(stream: DataFrame, base: str, checkpoint: str, size_min: int = SIZE_MIN, slide_min: int = SLIDE_MIN) -> DataFrame:
    """Runs a stream of sales over what is available and returns all silent intervals so far.

    Each micro-batch keeps the last busy interval of every known series, reports the gaps that its sales close
    (``open`` false), and the series whose latest window is empty (``open`` true, up to the newest interval).
    A repeated batch replaces its own files. Sales are expected slice by slice in event-time order.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = spark.createDataFrame([], f"{', '.join(f'{c} int' for c in SERIES)}, b timestamp_ntz")
        if batch_id:
            states = spark.read.schema(states.schema).parquet(f"{base}/last/batch_id={batch_id - 1}")
        busy = busy_intervals(batch, slide_min).unionByName(states).distinct()
        busy.groupBy(*SERIES).agg(F.max("b").alias("b")).write.mode("overwrite").parquet(f"{base}/last/batch_id={batch_id}")
        newest = busy.agg((F.max("b") + _minutes(size_min)).alias("hi"))
        following = F.lead("b").over(Window.partitionBy(*SERIES).orderBy("b"))
        gaps = busy.withColumn("next", following).join(F.broadcast(newest)).select(  # one row
            *SERIES, _gap(F.col("b"), F.coalesce("next", "hi"), size_min, slide_min).alias("g"), F.col("next").isNull().alias("open"))
        gaps.filter("g.first_start <= g.last_start").select(*SERIES, "g.first_start", "g.last_start", "open").write.mode("overwrite").parquet(f"{base}/gaps/batch_id={batch_id}")

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start().awaitTermination()
    return stream.sparkSession.read.option("basePath", f"{base}/gaps").parquet(f"{base}/gaps/batch_id=*")


def sliced(history: DataFrame, path: str, bounds=(), rows: int | None = None, every: str = SLIDE):
    """(lo, hi, sales) of consecutive slices of time, cut at ``bounds`` and so that none holds more than ``rows`` (SLICE_ROWS) sales.

    Cuts lie between intervals of ``every``; one with more sales is a slice of its own. The sales are counted by interval, which
    the calendar bounds, and written once by slice, so the work does not grow with the number of slices. ``lo`` and ``hi`` are
    None at the ends. Rows without a time are in no window and, where there is more than one slice, in none.
    """
    spark, rows = history.sparkSession, rows or SLICE_ROWS
    passed = sum((F.when(F.col("timestamp") >= F.lit(b).cast("timestamp"), 1).otherwise(0) for b in bounds), F.lit(0))
    tagged = history.withColumns({"_start": F.window("timestamp", every)["start"], "_passed": passed})
    counts = tagged.groupBy("_start", "_passed").agg(F.count("*").alias("n")).withColumn("_cut", F.col("_start").cast("string"))
    slices, edges, held = [], [], 0
    for r in counts.orderBy("_passed", "_start").select("_cut", "_passed", "n").collect():  # a row for each interval
        if slices and r["_passed"] != slices[-1][1]:
            edges, held = [*edges, bounds[r["_passed"] - 1]], 0
        elif held and held + r["n"] > rows:
            edges, held = [*edges, r["_cut"]], 0
        held += r["n"]
        slices.append((r["_cut"], r["_passed"], len(edges)))
    spread = lambda df: df.repartition(shuffle_width(spark))  # noqa: E731  # a file may come as one task's work
    if not edges:
        yield None, None, spread(history)
        return
    known = spark.createDataFrame(slices, "_cut string, _passed int, _slice int")
    numbered = spread(tagged).withColumn("_cut", F.col("_start").cast("string")).join(F.broadcast(known), ["_cut", "_passed"])  # a row for each interval
    numbered.drop("_cut", "_passed", "_start").write.partitionBy("_slice").parquet(path)
    for i, (lo, hi) in enumerate(zip([None, *edges], [*edges, None])):
        yield lo, hi, spark.read.schema(history.schema).parquet(f"{path}/_slice={i}")


def replay(history: DataFrame, base: str, bounds, build, mode: str = "update", rows: int | None = None) -> DataFrame:
    """Release history to a stream slice by slice in event-time order; returns all emitted rows.

    Each slice is written, whatever number of files that gives, and then processed as one
    micro-batch by a run that goes on from the checkpoint, so no row of a slice can make
    another one late. ``bounds`` are the few cut times; ``build`` turns the raw stream
    into the windowed one. Further cuts keep a slice below ``rows`` sales (SLICE_ROWS), so that the state
    of a run holds the windows of one slice and not those of the whole history.
    ``alone`` tells the windows that lie in one slice; in update mode only the others can be emitted more than once.
    """
    spark = history.sparkSession
    for lo, hi, part in sliced(history, f"{base}/slices", bounds, rows):
        part.write.mode("append").parquet(f"{base}/in")
        raw = read_pos_stream(spark, f"{base}/in", history.schema, max_files=None)
        after = F.lit(True) if lo is None else F.col("window_start") >= F.lit(lo).cast("timestamp_ntz")
        before = F.lit(True) if hi is None else F.col("window_end") <= F.lit(hi).cast("timestamp_ntz")
        write_alerts(build(raw).withColumn("alone", after & before), f"{base}/out", f"{base}/ckpt", mode).awaitTermination()
    return spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out/batch_id=*")


def released(history: DataFrame, path: str, bounds):
    """Appends one slice of the history after the other to a folder, and yields after each."""
    edges = [None, *bounds, None]
    for lo, hi in zip(edges, edges[1:]):
        part = history
        if lo is not None:
            part = part.filter(F.col("timestamp") >= F.lit(lo).cast("timestamp"))
        if hi is not None:
            part = part.filter(F.col("timestamp") < F.lit(hi).cast("timestamp"))
        part.write.mode("append").parquet(path)
        yield
