"""Joins. None forces a broadcast of a side that grows: the planner checks the size
and falls back to a sort-merge join, whose hot keys adaptive execution splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.scores import band


def star_join(fact: DataFrame, **dims: DataFrame) -> DataFrame:
    """Inner join of a fact with each dimension on the named key."""
    return reduce(lambda df, kv: df.join(kv[1], kv[0]), dims.items(), fact)


def attach_city(stores: DataFrame, cities: DataFrame) -> DataFrame:
    return stores.join(cities, "city_id", "left")


def new_members(src: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key is set and not in ``existing``; NULLs there do not hide new members."""
    known = src.filter(F.col(key).isNotNull())
    return known if existing is None else known.join(existing.select(key).distinct(), key, "left_anti")


def after_watermark(src: DataFrame, target: DataFrame | None, ts: str, target_ts: str | None = None) -> DataFrame:
    """Rows later than the newest loaded one; everything when nothing is loaded."""
    if target is None:
        return src
    newest = target.agg(F.coalesce(F.max(target_ts or ts), F.lit("1900-01-01").cast("timestamp_ntz")).alias("m"))
    return src.where(F.col(ts) > newest.scalar())


def keep_series(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys, keys.columns, "left_semi")


def feature_extract(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    return (
        fact.filter("observed_sales IS NOT NULL")
        .join(dim_store.select("store_id", "store_cluster", "volume_band"), "store_id")
        .select("date_key", "time_key", "store_id", "product_id", "observed_sales", "discount_factor", "store_cluster", "volume_band")
    )


def asof_dim(fact: DataFrame, dim: DataFrame, key: str, ts: Column) -> DataFrame:
    """The dimension version valid at ``ts``: from <= ts < to."""
    d = dim.withColumnRenamed(key, "_key")
    on = (fact[key] == d["_key"]) & (ts >= d["effective_from"]) & (ts < d["effective_to"])
    return fact.join(d, on, "left").drop("_key")


def asof_window(fact: DataFrame, dim: DataFrame, key: str, ts: Column, days: int = 92) -> DataFrame:
    """The rows of ``asof_dim`` for versions that do not overlap, without a range join: the latest version is carried forward.

    Versions and facts are put together and sorted by key and time once, so a fact is not paired with all versions of its
    key. Time is cut into ranges of ``days``, which split a hot key over tasks; a version is there once for each range that it
    reaches into, within the time that facts cover. Where versions overlap the one that began last counts. Facts
    without key or time, or in no version, have NULL columns.
    """
    span = lambda c: F.floor(F.unix_date(F.to_date(c)) / days).cast("int")
    time = lambda c: c.cast("timestamp_ntz")
    payload = [c for c in dim.columns if c != key]
    rows = fact.select(F.struct(*[fact[c] for c in fact.columns]).alias("_fact"), F.col(key).alias("_key"), time(ts).alias("_at"))
    rows = rows.withColumns({"_range": span(F.col("_at")), "_side": F.lit(1)})
    lone = F.col("_key").isNull() | F.col("_at").isNull()
    covered = rows.where(~lone).agg(F.min("_range").alias("_lo"), F.max("_range").alias("_hi"))
    reach = [F.greatest(span(F.col("effective_from")), F.col("_lo")), F.least(F.coalesce(span(F.col("effective_to")), F.col("_hi")), F.col("_hi"))]
    versions = dim.where(F.col(key).isNotNull()).join(F.broadcast(covered)).where(reach[0] <= reach[1]).select(  # one row
        F.col(key).alias("_key"), time(F.col("effective_from")).alias("_at"), F.explode(F.sequence(*reach)).alias("_range"), F.lit(0).alias("_side"),
        F.struct(*payload).alias("_version"))
    w = Window.partitionBy("_key", "_range").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.where(~lone).unionByName(versions, allowMissingColumns=True).withColumn("_version", F.last("_version", ignorenulls=True).over(w)).where("_side = 1")
    found = carried.unionByName(rows.where(lone), allowMissingColumns=True)
    valid = F.col("_at") < time(F.col("_version.effective_to"))
    return found.select("_fact.*", *[F.when(valid, F.col(f"_version.{c}")).alias(c) for c in payload])


def cross_grid(df: DataFrame, **axes) -> DataFrame:
    """Each row with every combination of a few literal values per axis; no join is needed."""
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def band_join(df: DataFrame, col: str, cuts, labels, name: str = "band") -> DataFrame:
    return df.withColumn(name, band(F.col(col), cuts, labels))


def band_table_join(df: DataFrame, col: str, bands: DataFrame, width: float, low: str = "lo", high: str = "hi") -> DataFrame:
    """Each row with the bands of a table that hold its value: low <= value < high; NULL columns where none does.

    Bands are cut into cells of ``width``, values fall into one cell each, and the range is checked after the
    join on the cell. So the join has a key and neither side is broadcast or compared in full.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(width)).cast("bigint")
    cells = bands.withColumn("_band_cell", F.explode(F.sequence(cell(low), cell(high))))
    rows = df.withColumn("_cell", cell(col))
    inside = (rows[col] >= cells[low]) & (rows[col] < cells[high])
    return rows.join(cells, (rows["_cell"] == cells["_band_cell"]) & inside, "left").drop("_cell", "_band_cell")


def expected_days(df: DataFrame, keys, date_col: str = "dt") -> DataFrame:
    """Every calendar day between the first and last day of each key."""
    d = F.to_date(date_col)
    return df.groupBy(*keys).agg(F.explode(F.sequence(F.min(d), F.max(d))).alias(date_col))


def missing_keys(df: DataFrame, keys, date_col: str = "dt") -> DataFrame:
    """Expected days of each key that have no row."""
    have = df.select(*keys, F.to_date(date_col).alias(date_col)).distinct()
    return expected_days(df, keys, date_col).join(have, [*keys, date_col], "left_anti")
