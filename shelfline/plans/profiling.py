"""Source profile queries; the bronze table supplies NULLs, short arrays and negatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import profile
from shelfline.plans.catalog import BRONZE, DAILY, GRID, query, rounded
from shelfline.sources import tables

COLS = ["store_id", "product_id", "sale_amount", "discount", "precpt", "avg_temperature", "stock_hour6_22_cnt"]


@query("pf1_profile_columns", ctes=BRONZE, sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null, count(*) - count({c}) AS null_count, round((count(*) - count({c})) / count(*)::DOUBLE * 100.0, 6) AS null_pct,
round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, count(*) FILTER (WHERE {c} = 0) AS n_zeros,
count(*) FILTER (WHERE {c} < 0) AS n_negative, count(DISTINCT {c}) AS n_unique, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median,
round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75 FROM bronze""" for c in COLS))
def _(spark, sf):
    return rounded(profile.profile_columns(tables.bronze(spark, sf), COLS))


@query("pf1_profile_lineitem", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS non_null, round(avg({c}), 4) AS mean, count(DISTINCT {c}) AS n_unique, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS median,
round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem""" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def _(spark, sf):
    p = profile.profile_columns(tables.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(p.select("column_name", "non_null", "mean", "n_unique", "q25", "median", "q75"), 4)


@query("pf2_profile_array", ctes=BRONZE, sql="""SELECT count(len) AS non_null, count(*) - count(len) AS null_count, CAST(min(len) AS INTEGER) AS length_min, CAST(max(len) AS INTEGER) AS length_max,
round(avg(len), 6) AS length_mean, CAST(mode(len) AS INTEGER) AS length_mode, round(count(*) FILTER (WHERE len = 24) / count(len)::DOUBLE * 100.0, 6) AS pct_full, count(*) FILTER (WHERE len <> 24) AS not_full
FROM (SELECT len(hours_sale) AS len FROM bronze)""")
def _(spark, sf):
    return rounded(profile.profile_array(tables.bronze(spark, sf), "hours_sale"))


@query("pf2_length_histogram", ctes=BRONZE, sql="SELECT CAST(len(hours_stock_status) AS INTEGER) AS length, count(*) AS n FROM bronze GROUP BY ALL")
def _(spark, sf):
    return profile.length_histogram(tables.bronze(spark, sf), "hours_stock_status", "int")


@query("pf3_profile_elements", ctes=BRONZE, sql="""SELECT round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, count(*) FILTER (WHERE x = 0) AS n_zeros,
count(*) FILTER (WHERE x < 0) AS n_negative, round(count(*) FILTER (WHERE x = 0) / count(*)::DOUBLE * 100.0, 6) AS pct_zeros FROM (SELECT unnest(hours_sale) AS x FROM bronze)""")
def _(spark, sf):
    return rounded(profile.profile_elements(tables.bronze(spark, sf), "hours_sale"))


@query("pf3_element_values", ctes=BRONZE, sql="SELECT DISTINCT x AS value FROM (SELECT unnest(hours_sale) AS x FROM bronze) ORDER BY 1 LIMIT 20")
def _(spark, sf):
    """The first 20 distinct element values."""
    return profile.element_values(tables.bronze(spark, sf), "hours_sale")


@query("pf4_profile_key", ctes=BRONZE, sql="""SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(CASE WHEN s IS NULL OR p IS NULL OR dt IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_in_keys,
CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_rows, count(*) AS unique_combinations, max(n) = 1 AS is_unique
FROM (SELECT CASE WHEN n <> 7 THEN store_id END AS s, product_id AS p, dt, count(*) AS n FROM bronze GROUP BY ALL)""")
def _(spark, sf):
    """The store is NULL on every seventh day of a month."""
    store = F.when(F.dayofmonth(F.to_date("dt")) != 7, F.col("store_id"))
    return profile.profile_key(tables.bronze(spark, sf).withColumn("store_id", store), ["store_id", "product_id", "dt"])


@query("pf5_profile_dates", ctes=GRID, sql="""SELECT CAST(min(d) AS DATE) AS min_date, CAST(max(d) AS DATE) AS max_date, count(DISTINCT d) AS n_unique_dates, CAST(max(d) - min(d) + 1 AS INTEGER) AS date_range_days,
CAST(max(d) - min(d) + 1 - count(DISTINCT d) AS BIGINT) AS n_missing_dates, any_value(s.total_series) AS total_series, any_value(s.min_days) AS min_days, any_value(s.max_days) AS max_days,
round(any_value(s.mean_days), 6) AS mean_days, round(any_value(s.median_days), 6) AS median_days
FROM base CROSS JOIN (SELECT count(*) AS total_series, min(n) AS min_days, max(n) AS max_days, avg(n) AS mean_days, median(n) AS median_days
FROM (SELECT count(DISTINCT d) AS n FROM base GROUP BY store_id, product_id)) s""")
def _(spark, sf):
    return rounded(profile.profile_dates(tables.daily(spark, sf)))


@query("pf5_missing_dates", sql="""SELECT d FROM (SELECT unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM
(SELECT date_trunc('day', ts)::TIMESTAMP AS ts FROM events WHERE day(ts) NOT IN (5, 11)))) WHERE d NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE day(ts) NOT IN (5, 11))""")
def _(spark, sf):
    """Two days of the month are taken out and must be found."""
    return profile.missing_dates(tables.table(spark, sf, "events").filter("day(ts) NOT IN (5, 11)"), "ts")


@query("pf6_consistency", ctes=BRONZE, sql="""SELECT count(*) AS n_compared, count(*) FILTER (WHERE diff < 1e-6) AS exact_match, count(*) FILTER (WHERE diff / (abs(a) + 1e-9) < 0.01) AS close_match_1pct,
round(max(diff), 6) AS max_abs_diff, round(avg(diff), 6) AS mean_abs_diff, round(count(*) FILTER (WHERE diff < 1e-6) / count(*)::DOUBLE * 100.0, 6) AS pct_exact_match, round(median(diff), 6) AS median_abs_diff
FROM (SELECT sale_amount AS a, abs(sale_amount - list_sum(hours_sale)) AS diff FROM bronze) WHERE diff IS NOT NULL""")
def _(spark, sf):
    return rounded(profile.profile_consistency(tables.bronze(spark, sf)))


@query("pf7_discount", ctes=GRID, sql="""SELECT count(DISTINCT discount) AS n_unique, max(discount) > 1.0 AS has_values_above_1, round(count(*) FILTER (WHERE discount = 1.0) / count(*)::DOUBLE * 100.0, 6) AS pct_no_discount FROM base""")
def _(spark, sf):
    return rounded(profile.profile_discount(tables.daily(spark, sf)))


@query("pf7_top_discounts", ctes=GRID, sql="SELECT discount, count(*) AS n FROM base GROUP BY ALL ORDER BY n DESC, discount LIMIT 20")
def _(spark, sf):
    """The 20 most frequent multipliers."""
    from shelfline.operators.aggregates import value_counts

    return value_counts(tables.daily(spark, sf), "discount", 20)


@query("pf8_status_domain", ctes=BRONZE, sql="SELECT x AS value, count(*) AS n FROM (SELECT unnest(hours_stock_status) AS x FROM bronze) GROUP BY ALL")
def _(spark, sf):
    return profile.profile_status(tables.bronze(spark, sf))


@query("pf9_hierarchy", ctes=GRID, sql=" UNION ALL ".join(f"SELECT '{c}' AS level, count(DISTINCT {c}) AS n_unique FROM base" for c in profile.HIERARCHY))
def _(spark, sf):
    return profile.profile_hierarchy(tables.daily(spark, sf))


@query("pf10_stockout_summary", ctes=DAILY, sql="""SELECT round(avg(c), 6) AS mean_stockout_hours, round(avg((c = 0)::INT) * 100, 6) AS pct_zero_stockout, round(avg((c > 0)::INT) * 100, 6) AS pct_any_stockout,
round(avg((c >= 16)::INT) * 100, 6) AS pct_full_stockout FROM (SELECT stock_hour6_22_cnt AS c FROM daily)""")
def _(spark, sf):
    return rounded(profile.profile_stockout(tables.daily(spark, sf)))


@query("pf10_stockout_distribution", ctes=DAILY, sql="SELECT stock_hour6_22_cnt, count(*) AS n FROM daily GROUP BY ALL")
def _(spark, sf):
    from shelfline.operators.aggregates import value_counts

    return value_counts(tables.daily(spark, sf), "stock_hour6_22_cnt")


@query("pf11_scale", ctes=GRID, sql="SELECT count(*) AS source_daily_rows, count(*) * 24 AS exploded_hourly_rows, count(*) * 16 AS operational_hour_rows FROM base")
def _(spark, sf):
    return profile.profile_scale(tables.daily(spark, sf))
