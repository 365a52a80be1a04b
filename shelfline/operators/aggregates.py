"""Aggregates, ordered listings and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.ranks import running_totals, value_counts_by
from shelfline.session import materialize

from shelfline.operators.ranks import bounded_quantiles, exact_quantiles, value_counts_by


def agg_by(df: DataFrame, keys, **aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])


def n_unique(df: DataFrame, cols, by=(), approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approx else F.countDistinct
    return df.groupBy(*by).agg(*[count(c).alias(f"n_{c}") for c in cols])


def quantiles(df: DataFrame, col: str, probs, keys=(), bounded_groups: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation.

    ``bounded_groups`` says that each group is small (for instance one row per day of a
    series): then its values are sorted in one row. Whole-table quantiles go through
    ``exact_quantiles``, which never holds a group in one task.
    """
    if bounded_groups:
        return bounded_quantiles(df, keys, col, probs)
    return exact_quantiles(value_counts_by(df, keys, col), keys, col, probs)


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    out = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), col).limit(k) if k else out


def cond_counts(df: DataFrame, by=(), **preds: Column) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(p).alias(name) for name, p in preds.items()])


def distinct_of(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols).distinct()


def kpi_rollup(df: DataFrame, metric: str, weight: str, levels) -> DataFrame:
    """Weighted mean of a KPI at each level of a hierarchy; NULL in the finer levels marks a subtotal."""
    part = F.when(F.col(metric).isNotNull(), F.col(weight))
    return df.rollup(*levels).agg(
        (F.sum(F.col(metric) * F.col(weight)) / F.nullif(F.sum(part), F.lit(0.0))).alias(metric),
        F.sum(weight).alias(weight))


def listing(df: DataFrame, order, n: int) -> DataFrame:
    """Ordered rows, first n; each task keeps n rows before they meet."""
    return df.orderBy(*order).limit(n)


def ranking(df: DataFrame, value: str, descending: bool = False) -> DataFrame:
    """All rows with ``place``: 1 plus the number of rows with a better value, none for NULL.

    Places come from running totals over the distinct values, so no single task orders the whole table.
    """
    rows = materialize(df, "ranked")
    run = running_totals(value_counts_by(rows, [], value), [], value, ["n"])
    place = F.col("total_n") - F.col("cum_n") if descending else F.col("cum_n") - F.col("n")
    return rows.join(run.select(value, (place + 1).cast("int").alias("place")), value, "left").select(*df.columns, "place")


def latest_n(df: DataFrame, n: int, order=("date_key", "time_key"), tie=()) -> DataFrame:
    return listing(df, [*[F.col(c).desc() for c in order], *tie], n)


def action_queue(recs: DataFrame, tie=()) -> DataFrame:
    """Open actions by urgency. The tie columns order equal scores and let a range sort
    spread a score that very many rows share."""
    return recs.filter("recommendation_status = 'OPEN'").orderBy(F.desc("urgency_score"), *tie)


def top_duplicates(df: DataFrame, keys, n: int = 10) -> DataFrame:
    dup = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return dup.orderBy(F.desc("n"), *keys).limit(n)


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.distinct().join(b, a.columns, "left_anti")


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]
