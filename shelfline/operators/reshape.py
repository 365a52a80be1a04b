"""Daily arrays to hourly rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import calendar as cal
from shelfline.functions.arrays import as_array, open_slots
from shelfline.functions.scores import discount_depth


def explode_slots(daily: DataFrame, operational: bool = False) -> DataFrame:
    """One row per slot with ``hour_of_day``, ``observed_sales``, ``stockout_flag``.

    Both arrays go through one generator, aligned by position. With ``operational``
    the arrays are cut to the trading hours first: a third fewer rows are generated,
    which a filter on the hour afterwards would not achieve.
    """
    sales, status = as_array(daily, "hours_sale"), as_array(daily, "hours_stock_status", "int")
    first = 0
    if operational:
        sales, status, first = open_slots(sales), open_slots(status), cal.OPEN_HOUR
    keep = [c for c in daily.columns if c not in ("hours_sale", "hours_stock_status")]
    pairs = F.arrays_zip(sales.alias("s"), status.alias("o"))
    return daily.select(*keep, F.posexplode(pairs).alias("_pos", "_slot")).select(
        *keep,
        (F.col("_pos") + first).alias("hour_of_day"),
        F.col("_slot.s").alias("observed_sales"),
        F.col("_slot.o").alias("stockout_flag"),
    )


def explode_hourly(daily: DataFrame, operational: bool = False) -> DataFrame:
    """The hourly time series with calendar columns; grain store, product, hour."""
    dt = F.col("event_date")
    hour = F.col("hour_of_day")
    slots = explode_slots(daily, operational).withColumn("event_date", F.to_date("dt")).drop("dt")
    return slots.withColumns(
        {
            "event_timestamp": cal.event_ts(dt, hour),
            "is_operational_hour": cal.is_operational(hour),
            **cal.calendar_cols(dt),
            "part_of_day": cal.part_of_day(hour),
            "discount_depth": discount_depth(F.col("discount")),
        }
    )


def daily_stockout(daily: DataFrame) -> DataFrame:
    """Stockout hours within trading hours and the any-stockout flag, without exploding."""
    status = open_slots(as_array(daily, "hours_stock_status", "int"))
    hours = F.aggregate(status, F.lit(0), lambda acc, x: acc + x)
    return daily.withColumn("daily_stockout_hours", hours).withColumn(
        "has_any_stockout", F.col("daily_stockout_hours") > 0
    )
