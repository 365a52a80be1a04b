"""Registry of queries and shared SQL fragments for their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

POS = """pos AS (
  SELECT ts AS timestamp, CAST(user_id // 10 + 1 AS INTEGER) AS store_id,
         CASE event_type WHEN 'click' THEN 101 WHEN 'view' THEN 230 WHEN 'signup' THEN 345
              WHEN 'purchase' THEN 512 WHEN 'error' THEN 704 ELSE 865 END AS product_id,
         event_id AS transaction_id, value AS units_sold
  FROM events)"""

GRID = POS + """, cells AS (
  SELECT store_id, product_id, CAST(timestamp AS DATE) AS d, CAST(hour(timestamp) AS INTEGER) AS h,
         round(sum(units_sold), 4) AS v
  FROM pos GROUP BY ALL
), days AS (
  SELECT store_id, product_id, CAST(timestamp AS DATE) AS d, round(sum(units_sold), 4) AS sale_amount
  FROM pos GROUP BY ALL
), base AS (
  SELECT CAST((store_id - 1) % 18 + 1 AS INTEGER) AS city_id, store_id, product_id,
         CAST(product_id % 3 AS INTEGER) AS management_group_id, CAST(product_id % 5 AS INTEGER) AS first_category_id,
         CAST(product_id % 7 AS INTEGER) AS second_category_id, CAST(product_id % 11 AS INTEGER) AS third_category_id,
         d, CAST(day(d) AS INTEGER) AS n, sale_amount,
         round(1.0::DOUBLE - ((store_id + product_id + day(d)) % 4) * 0.1::DOUBLE, 1) AS discount,
         CAST(day(d) IN (1, 15) AS INTEGER) AS holiday_flag,
         CAST((product_id + day(d)) % 5 = 0 AS INTEGER) AS activity_flag,
         ((day(d) * 7) % 30) / 10.0::DOUBLE AS precpt, CAST(day(d) AS DOUBLE) - 2 AS avg_temperature,
         CAST(30 + (day(d) * 3) % 60 AS DOUBLE) AS avg_humidity, (day(d) % 6) / 2.0::DOUBLE AS avg_wind_level
  FROM days)"""

HOURLY = GRID + """, hours AS (SELECT unnest(range(24))::INTEGER AS h), hourly AS (
  SELECT b.store_id, b.product_id, b.city_id, b.d AS event_date, hours.h AS hour_of_day,
         CAST(b.d AS TIMESTAMP) + to_hours(hours.h) AS event_timestamp,
         coalesce(c.v, 0.0::DOUBLE) AS observed_sales, CAST(c.v IS NULL AS INTEGER) AS stockout_flag,
         hours.h BETWEEN 6 AND 21 AS is_operational_hour,
         CAST(dayofweek(b.d) + 1 AS INTEGER) AS day_of_week, CAST(isodow(b.d) - 1 AS INTEGER) AS iso_dow0,
         isodow(b.d) >= 6 AS is_weekend, CAST(weekofyear(b.d) AS INTEGER) AS week_of_year, CAST(month(b.d) AS INTEGER) AS month,
         CASE WHEN hours.h BETWEEN 6 AND 11 THEN 'Morning' WHEN hours.h BETWEEN 12 AND 17 THEN 'Afternoon'
              WHEN hours.h BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END AS part_of_day,
         b.discount, 1.0::DOUBLE - b.discount AS discount_depth, b.holiday_flag, b.activity_flag,
         b.precpt, b.avg_temperature, b.avg_humidity, b.avg_wind_level
  FROM base b CROSS JOIN hours LEFT JOIN cells c
    ON c.store_id = b.store_id AND c.product_id = b.product_id AND c.d = b.d AND c.h = hours.h
), ops AS (SELECT * FROM hourly WHERE is_operational_hour
), cutd AS (SELECT min(d) AS cut FROM (SELECT d, row_number() OVER (ORDER BY d) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT d FROM base)) WHERE i > ceil(n * 0.7))"""

DAILY = HOURLY + """, daily AS (
  SELECT b.*, strftime(b.d, '%Y-%m-%d') AS dt, a.hours_sale, a.hours_stock_status, a.stock_hour6_22_cnt
  FROM base b JOIN (
    SELECT store_id, product_id, event_date, list(observed_sales ORDER BY hour_of_day) AS hours_sale,
           list(stockout_flag ORDER BY hour_of_day) AS hours_stock_status,
           CAST(sum(CASE WHEN is_operational_hour THEN stockout_flag ELSE 0 END) AS INTEGER) AS stock_hour6_22_cnt
    FROM hourly GROUP BY ALL) a
  ON a.store_id = b.store_id AND a.product_id = b.product_id AND a.event_date = b.d)"""

BRONZE = DAILY + """, bronze AS (
  SELECT * EXCLUDE (hours_sale, hours_stock_status, sale_amount, mix, copy),
         CASE WHEN mix % 13 = 0 THEN hours_sale[1:23] ELSE hours_sale END AS hours_sale,
         CASE WHEN mix % 23 <> 0 THEN hours_stock_status END AS hours_stock_status,
         CASE WHEN mix % 17 = 0 THEN -1.0::DOUBLE WHEN mix % 19 <> 0 THEN sale_amount + copy END AS sale_amount,
         CASE WHEN n <= 20 THEN 'train' ELSE 'eval' END || '-' || copy || '.parquet' AS source_file,
         sha256(CASE WHEN n <= 20 THEN 'train' ELSE 'eval' END || '-' || copy || '.parquet') AS source_file_hash,
         CASE WHEN n <= 20 THEN 'train' ELSE 'eval' END AS source_split,
         'batch-' || copy AS ingestion_batch_id,
         CASE WHEN copy = 1 AND mix % 2 = 0 THEN '2024-02-02T00:00:00' ELSE '2024-02-01T00:00:00' END AS ingested_at,
         '1.0' AS schema_version,
         md5(store_id || '|' || product_id || '|' || dt) AS record_hash
  FROM (SELECT *, store_id + product_id + n AS mix,
               unnest(CASE WHEN (store_id + product_id + n) % 5 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM daily)
), latest AS (
  SELECT * FROM bronze
  QUALIFY row_number() OVER (PARTITION BY store_id, product_id, dt ORDER BY ingested_at DESC, source_file_hash DESC) = 1
), checked AS (
  SELECT *, coalesce(len(hours_sale) = 24 AND len(hours_stock_status) = 24 AND sale_amount >= 0, false) AS is_valid FROM latest)"""

# contiguous runs of stockout hours; {part} adds the event date for the per-day mode
INCIDENTS = HOURLY + """, marked AS (
  SELECT *, coalesce(lag(stockout_flag) OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp), 0) AS prev FROM ops
), runs AS (
  SELECT *, sum(CASE WHEN stockout_flag = 1 AND prev = 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp) AS run FROM marked
), incidents AS (
  SELECT store_id, product_id, min(event_timestamp) AS incident_start, max(event_timestamp) AS incident_end,
         count(*) AS duration_hours, avg(discount_depth) AS avg_discount_during,
         max(holiday_flag) AS spans_holiday, max(activity_flag) AS spans_promotion, min(event_date) AS start_date
  FROM runs WHERE stockout_flag = 1 GROUP BY store_id, product_id, run
), marked_day AS (
  SELECT *, coalesce(lag(stockout_flag) OVER (PARTITION BY store_id, product_id, event_date ORDER BY event_timestamp), 0) AS prev FROM ops
), runs_day AS (
  SELECT *, sum(CASE WHEN stockout_flag = 1 AND prev = 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY store_id, product_id, event_date ORDER BY event_timestamp) AS run FROM marked_day
), incidents_day AS (
  SELECT store_id, product_id, event_date, min(event_timestamp) AS incident_start, max(event_timestamp) AS incident_end,
         count(*) AS duration_hours
  FROM runs_day WHERE stockout_flag = 1 GROUP BY store_id, product_id, event_date, run)"""

ORDER_DEMAND = """demand AS (
  SELECT l_suppkey AS store_id, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS dt,
         round(sum(l_quantity), 4) AS sale_amount, round(1.0 - avg(l_discount), 4) AS discount, count(*) AS n_lines
  FROM lineitem GROUP BY ALL)"""


def query(name: str, sql: str | None = None, ctes: str | None = None):
    """Register a query; ``ctes`` is the WITH list its SQL counterpart builds on."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = f"WITH {ctes}\n{sql}" if ctes else sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, **by_column: int) -> DataFrame:
    """Round every double column so that two engines that add in a different order agree."""
    cols = []
    for field in df.schema.fields:
        if field.dataType.typeName() == "double":
            # adding 0.0 turns a negative zero into zero
            cols.append((F.round(F.col(field.name), by_column.get(field.name, digits)) + F.lit(0.0)).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)
