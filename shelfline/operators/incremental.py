"""Incremental loads that survive late rows and missing days.

Nothing here compares with one global newest row. Each series has its own high-water mark, rows at or below it are
looked up by key, and only the partitions that get a row are written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.operators import islands
from shelfline.session import materialize

SERIES = ["store_id", "product_id"]


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before the first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def high_water(df: DataFrame, ts: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """The newest row of each series, as ``mark``."""
    return df.groupBy(*keys).agg(F.max(ts).alias("mark"))


def arrivals(src: DataFrame, target: DataFrame | None, marks: DataFrame | None, ts: str, part: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """Rows of ``src`` that ``target`` lacks: those past the mark of their series, and late ones.

    A row past the mark, or of a series without one, is new and is compared with nothing. Older rows are looked up by key,
    but only in partitions where the number and the checksum of the keys differ between source and target. The marks have a row for
    each series, the sums one for each partition, so neither join moves more than the rows in question.
    """
    if target is None or marks is None:
        return src
    marked = src.join(marks.hint("merge"), list(keys), "left")
    newer = marked.where(F.col("mark").isNull() | (F.col(ts) > F.col("mark")))
    late = marked.where(F.col(ts) <= F.col("mark")).drop("mark")
    held = [F.count("*").alias("n"), F.sum(F.xxhash64(*keys, ts).cast("decimal(38,0)")).alias("keys")]
    # rows past the marks are in the source alone and are left out of the comparison
    uneven = late.groupBy(part).agg(*held).join(target.groupBy(part).agg(*held), [part, "n", "keys"], "left_anti").select(part)
    # the stored keys are small as files and large as rows: no size check may send them to the driver for a broadcast
    late = late.join(uneven, part, "left_semi").join(target.select(*keys, ts).hint("merge"), [*keys, ts], "left_anti")
    return newer.drop("mark").unionByName(late)


def overwrite_touched(new: DataFrame, path: str, part: str) -> DataFrame:
    """Write the rows of ``new`` beside those that their partitions hold already; other partitions keep their files.

    ``new`` must be stored. Dynamic partition overwrite replaces exactly the partitions that get rows, so a load that is
    run again after a failure gives the same table. Returns the touched partitions.
    """
    spark = new.sparkSession
    touched = materialize(new.select(part).distinct(), "touched")
    held = stored(spark, path)
    if held is not None:
        # the merged partitions are stored first: a path cannot be read and written in one step
        kept = held.join(touched, part, "left_semi").select(*new.columns)
        new = materialize(kept.unionByName(new), "merged")
    new.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    return touched


def load(src: DataFrame, path: str, ts: str, part: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """Bring the table at ``path`` up to ``src`` and return the rows that were added, stored.

    The marks are stored beside the table, one folder for each load, and replaced after it; a load that failed in
    between finds old marks, and then looks the rows up by key.
    """
    spark = src.sparkSession
    target, marks = stored(spark, path), stored(spark, f"{path}-marks")
    new = materialize(arrivals(src, target, marks, ts, part, keys), "arrivals")
    overwrite_touched(new, path, part)
    fresh = high_water(new, ts, keys)
    if marks is not None:
        fresh = fresh.unionByName(marks).groupBy(*keys).agg(F.max("mark").alias("mark"))
    materialize(fresh, "marks").write.mode("overwrite").parquet(f"{path}-marks")
    return new


def reload_incidents(existing: DataFrame, days: DataFrame, new_days: DataFrame) -> DataFrame:
    """The incidents after ``new_days`` were added to give ``days``, both daily rows with arrays; late days and gaps may be anywhere.

    For a series that got days, an incident is final if it ended before the last hour of the last day in front of the first new one.
    One that reaches that hour may go on, so all from its start, or else from the first new day on, are found
    again from the days they touch. Series without new days keep theirs.
    """
    day = F.to_date("dt")
    first = new_days.groupBy(*SERIES).agg(F.min(day).alias("_first"))
    before = days.select(*SERIES, day.alias("_d")).join(first, SERIES).where(F.col("_d") < F.col("_first"))
    last_hour = F.max("_d").cast("timestamp_ntz") + F.expr(f"INTERVAL {cal.CLOSE_HOUR - 1} HOURS")
    bounds = first.join(before.groupBy(*SERIES).agg(last_hour.alias("_seen")), SERIES, "left")
    marked = existing.join(bounds, SERIES, "left")
    open_from = marked.where("_first IS NOT NULL AND incident_end >= _seen").groupBy(*SERIES).agg(F.min("incident_start").alias("_open"))
    start = F.least(F.coalesce("_open", F.col("_first").cast("timestamp_ntz")), F.col("_first").cast("timestamp_ntz"))
    again = materialize(first.join(open_from, SERIES, "left").select(*SERIES, start.alias("_from")), "reload-from")
    final = existing.join(again, SERIES, "left").where("_from IS NULL OR incident_start < _from").drop("_from")
    touched = days.join(again, SERIES).where(day >= F.to_date("_from")).drop("_from")
    found = islands.incidents_from_daily(touched).join(again, SERIES).where("incident_start >= _from")
    return final.unionByName(found.select(*existing.columns))
