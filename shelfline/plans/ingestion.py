"""Sources, sinks, lineage and sampling."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from shelfline.functions import text
from shelfline.operators import clean, ingest, profile
from shelfline.plans.catalog import BRONZE, DAILY, GRID, query, rounded
from shelfline.session import scratch_path
from shelfline.sources import files, runlog, tables

FIXED_TS = "2024-02-03 00:00:00"


@query("flagship_store_stockouts", ctes=BRONZE + """, good AS (
  SELECT store_id, product_id, d FROM checked WHERE is_valid
), marked AS (
  SELECT o.*, coalesce(lag(stockout_flag) OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp), 0) AS prev
  FROM ops o SEMI JOIN good g ON o.store_id = g.store_id AND o.product_id = g.product_id AND o.event_date = g.d
), runs AS (
  SELECT *, sum(CASE WHEN stockout_flag = 1 AND prev = 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp) AS run FROM marked
), inc AS (SELECT store_id, product_id, run, count(*) AS dur FROM runs WHERE stockout_flag = 1 GROUP BY ALL)""",
       sql="""SELECT store_id, count(*) AS incidents, CAST(sum(dur) AS BIGINT) AS stockout_hours, max(dur) AS longest_hours,
       round(avg(dur), 6) AS mean_hours FROM inc GROUP BY store_id""")
def _(spark, sf):
    """Stores by stockout hours, from raw events to incidents."""
    from shelfline.operators.islands import incidents_from_daily

    good, _bad = clean.split_valid(clean.flag_valid(clean.dedup_latest(tables.bronze(spark, sf))))
    found = incidents_from_daily(good)
    return rounded(found.groupBy("store_id").agg(
        F.count("*").alias("incidents"), F.sum("duration_hours").alias("stockout_hours"),
        F.max("duration_hours").alias("longest_hours"), F.avg("duration_hours").alias("mean_hours"),
    ).orderBy(F.desc("stockout_hours"), "store_id"))


@query("io1_read_raw", sql="""SELECT event_type, 'events.parquet' AS file_name, count(*) AS n, min(ts) AS first_ts
FROM events GROUP BY event_type""")
def _(spark, sf):
    df = files.read_raw(spark, sf, pattern="events.parquet")
    return df.groupBy("event_type", F.element_at(F.split("source_path", "/"), -1).alias("file_name")).agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"))


@query("io2_read_bronze", ctes=BRONZE, sql="""SELECT source_split, store_id, count(*) AS n FROM bronze
WHERE source_split = 'train' GROUP BY ALL""")
def _(spark, sf):
    path = scratch_path(spark, "bronze")
    files.write_bronze(tables.bronze(spark, sf).drop("ingestion_batch_id"), path, "b1", "2024-02-01")
    return files.read_bronze(spark, path, "2024-02-01", "train").groupBy("source_split", "store_id").agg(F.count("*").alias("n"))


@query("io3_write_bronze_twice", ctes=BRONZE, sql="""SELECT source_split, source_file, 'b1' AS ingestion_batch_id,
CAST('2024-02-01' AS DATE) AS ingestion_date, count(*) AS n FROM bronze GROUP BY ALL""")
def _(spark, sf):
    """The second write of the same batch adds nothing."""
    path = scratch_path(spark, "bronze")
    rows = tables.bronze(spark, sf).drop("ingestion_batch_id")
    for _i in range(2):
        files.write_bronze(rows, path, "b1", "2024-02-01")
    return files.read_bronze(spark, path).groupBy(
        "source_split", "source_file", "ingestion_batch_id", "ingestion_date").agg(F.count("*").alias("n"))


@query("io6_scores_csv", ctes=GRID, sql="""SELECT store_id, product_id, CAST(d AS DATE) AS dt, sale_amount AS forecasted_demand FROM base""")
def _(spark, sf):
    path = scratch_path(spark, "scores")
    out = tables.daily(spark, sf).select("store_id", "product_id", F.to_date("dt").alias("dt"), F.col("sale_amount").alias("forecasted_demand"))
    files.write_scores(out, path)
    return files.read_scores(spark, path, out.schema)


@query("io7_profile_json", ctes=GRID, sql="""SELECT 'sale_amount' AS column_name, count(*) AS row_count, count(sale_amount) AS non_null,
round(min(sale_amount), 6) AS min, round(max(sale_amount), 6) AS max FROM base""")
def _(spark, sf):
    path = scratch_path(spark, "profile")
    out = rounded(profile.profile_columns(tables.daily(spark, sf), ["sale_amount"]).select(
        "column_name", "row_count", "non_null", "min", "max"))
    files.write_profile(out, path)
    return files.read_profile(spark, path, out.schema)


@query("io10_json_arrays", ctes=DAILY, sql="""SELECT store_id, product_id, dt, CAST(len(hours_stock_status) AS INTEGER) AS n_slots,
'[' || array_to_string(hours_stock_status, ',') || ']' AS status_json, round(list_sum(hours_sale), 6) AS total FROM daily""")
def _(spark, sf):
    """Arrays to JSON text and back."""
    texts = files.arrays_to_json(tables.daily(spark, sf).withColumn("kept", F.col("hours_sale")), ["hours_sale", "hours_stock_status"])
    back = files.json_to_arrays(texts.withColumn("status_json", F.col("hours_stock_status")),
                                {"hours_sale": "double", "hours_stock_status": "int"})
    return rounded(back.select("store_id", "product_id", "dt", F.size("hours_stock_status").alias("n_slots"), "status_json",
                               F.aggregate("hours_sale", F.lit(0.0), lambda a, x: a + x).alias("total")))


@query("io11_manifest")
def _(spark, sf):
    return files.build_manifest(spark, sf, "*.parquet")


@query("io12_manifest_check")
def _(spark, sf):
    """Every second file is listed with another hash, and one listed file does not exist."""
    m = files.build_manifest(spark, sf, "*.parquet")
    listed = m.withColumn("sha256", F.when(F.length("filename") % 2 == 0, F.sha2("filename", 256)).otherwise(F.col("sha256")))
    listed = listed.unionByName(m.filter("filename = 'events.parquet'").withColumn("relative_path", F.lit("gone.parquet")))
    return files.manifest_summary(files.verify_manifest(listed, m))


@query("io13_pending_files")
def _(spark, sf):
    m = files.mark_ingested(files.build_manifest(spark, sf, hashed=False), "events.parquet")
    return files.pending_files(files.parquet_files(m)).select("filename", "size_bytes", "ingested")


LISTED = """listed AS (SELECT 'part-' || p_partkey || CASE WHEN p_size % 2 = 0 THEN '.parquet' ELSE '.csv' END AS filename, sha256(p_name) AS sha256, CAST(p_size AS BIGINT) AS size_bytes, p_partkey FROM part
), found AS (SELECT filename, CASE WHEN p_partkey % 5 = 0 THEN sha256(p_name || '!') ELSE sha256(p_name) END AS actual FROM listed JOIN part USING (p_partkey) WHERE p_partkey % 7 <> 0)"""


def listed_parts(spark, sf):
    """A manifest with a file for each part; its hash is that of the part's name."""
    name = F.concat(F.lit("part-"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 2 == 0, ".parquet").otherwise(".csv"))
    return tables.table(spark, sf, "part").select(
        name.alias("filename"), name.alias("relative_path"), F.sha2("p_name", 256).alias("sha256"), F.col("p_size").cast("bigint").alias("size_bytes"),
        F.lit(False).alias("ingested"), "p_partkey", "p_name")


@query("io12_verify_parts", ctes=LISTED, sql="""SELECT l.filename, CASE WHEN f.filename IS NULL THEN 'MISSING' WHEN f.actual = l.sha256 THEN 'OK' ELSE 'CORRUPTED' END AS status FROM listed l LEFT JOIN found f USING (filename)""")
def _(spark, sf):
    """Files of a manifest that are gone, changed or unchanged in a second scan."""
    listed = listed_parts(spark, sf)
    changed = F.when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name"))
    scanned = listed.where("p_partkey % 7 <> 0").withColumn("sha256", F.sha2(changed, 256))
    return files.verify_manifest(listed, scanned).select("filename", "status")


@query("io13_pending_parts", ctes=LISTED, sql="SELECT filename, size_bytes FROM listed WHERE filename LIKE '%.parquet' AND filename <> 'part-' || (SELECT min(p_partkey) FROM listed WHERE filename LIKE '%.parquet') || '.parquet'")
def _(spark, sf):
    """Parquet files that wait, after the first of them was marked as ingested."""
    waiting = files.parquet_files(listed_parts(spark, sf))
    first = waiting.agg(F.concat(F.lit("part-"), F.min("p_partkey").cast("string"), F.lit(".parquet"))).scalar()
    return files.pending_files(files.mark_ingested(waiting, first)).select("filename", "size_bytes")


@query("io14_run_log", ctes=BRONZE, sql="""SELECT 'run-1' AS pipeline_run_id, 'bronze_to_silver' AS pipeline_name, 'SUCCESS' AS status,
count(*) AS source_rows, CAST(sum(is_valid::INT) AS BIGINT) AS accepted_rows, CAST(sum((NOT is_valid)::INT) AS BIGINT) AS rejected_rows,
60.0::DOUBLE AS duration_seconds FROM checked""")
def _(spark, sf):
    path = scratch_path(spark, "silver")
    flagged, seen = runlog.observed(clean.flag_valid(clean.dedup_latest(tables.bronze(spark, sf))), "silver", F.col("is_valid"))
    flagged.write.partitionBy("is_valid").parquet(path)
    t0 = datetime.datetime(2024, 2, 1)
    row = runlog.run_row(spark, "run-1", "bronze_to_silver", t0, t0 + datetime.timedelta(seconds=60), seen.get)
    return row.select("pipeline_run_id", "pipeline_name", "status", "source_rows", "accepted_rows", "rejected_rows", "duration_seconds")


@query("in1_source_split", ctes=BRONZE, sql="""SELECT source_split AS split, count(*) AS n FROM bronze GROUP BY ALL""")
def _(spark, sf):
    path = F.concat(F.lit("/data/RAW/"), F.upper("source_file"))
    return tables.bronze(spark, sf).groupBy(text.source_split(path).alias("split")).agg(F.count("*").alias("n"))


@query("in2_lineage", ctes=GRID, sql="""SELECT store_id, product_id, strftime(d, '%Y-%m-%d') AS dt,
'eval_' || store_id || '.parquet' AS source_file, 'eval' AS source_split, 'b7' AS ingestion_batch_id,
TIMESTAMP '2024-02-03 00:00:00' AS ingested_at, '1.0' AS schema_version,
md5(store_id || '|' || product_id || '|' || strftime(d, '%Y-%m-%d')) AS record_hash,
sha256('eval_' || store_id || '.parquet') AS source_file_hash FROM base""")
def _(spark, sf):
    rows = tables.daily(spark, sf).select("store_id", "product_id", "dt")
    name = F.concat(F.lit("eval_"), F.col("store_id").cast("string"), F.lit(".parquet"))
    hashes = rows.select(name.alias("filename")).distinct().withColumn("sha256", F.sha2("filename", 256))
    return ingest.add_lineage(rows, "b7", F.lit(FIXED_TS).cast("timestamp_ntz"), F.concat(F.lit("/raw/"), name), hashes)


@query("in3_record_hash", ctes=GRID, sql="""SELECT store_id, product_id,
md5(CASE WHEN n = 1 THEN '' ELSE store_id::VARCHAR END || '|' || product_id || '|' || strftime(d, '%Y-%m-%d')) AS h FROM base""")
def _(spark, sf):
    """NULL keys hash as empty text."""
    df = tables.daily(spark, sf)
    store = F.when(F.dayofmonth(F.to_date("dt")) != 1, F.col("store_id"))
    return df.select("store_id", "product_id", text.record_hash(store, F.col("product_id"), F.col("dt")).alias("h"))


@query("in4_bronze_checks", ctes=BRONZE, sql="""SELECT 'total_rows_nonzero' AS name, count(*) > 0 AS passed, 'Total rows: ' || count(*) AS detail FROM bronze
UNION ALL SELECT 'required_columns', true, 'All present'
UNION ALL SELECT 'not_all_null:' || c, n > 0, 'Non-null: ' || n FROM (
  SELECT unnest(['city_id','store_id','product_id','dt','sale_amount','hours_sale','hours_stock_status']) AS c,
         unnest([count(city_id), count(store_id), count(product_id), count(dt), count(sale_amount), count(hours_sale), count(hours_stock_status)]) AS n
  FROM bronze)""")
def _(spark, sf):
    return ingest.bronze_checks(tables.bronze(spark, sf))


UNIFORM = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query("in5_sample_series", ctes=GRID + f""", picked AS (SELECT DISTINCT store_id, product_id,
{UNIFORM.format("'42:' || store_id || ':' || product_id")} AS u FROM base ORDER BY u, store_id, product_id LIMIT 20)""",
       sql="""SELECT b.store_id, b.product_id, strftime(b.d, '%Y-%m-%d') AS dt, b.sale_amount FROM base b
SEMI JOIN picked p ON b.store_id = p.store_id AND b.product_id = p.product_id""")
def _(spark, sf):
    return ingest.sample_series(tables.daily(spark, sf), 20, 42).select("store_id", "product_id", "dt", "sale_amount")


@query("in6_sample_fraction", sql=f"""SELECT event_id, value FROM events
WHERE {UNIFORM.format("'7:' || event_id")} < 0.1""")
def _(spark, sf):
    """The sampling operator: a tenth of the rows by hash."""
    return ingest.sample_fraction(tables.table(spark, sf, "events"), 0.1, 7, "event_id").select("event_id", "value")
