"""Domain tables derived from the event and order tables by Spark itself.

events    -> point-of-sale rows -> one daily row per store, product and day
lineitem  -> daily order demand per store (supplier), product (part) and ship date

A store serves ten consecutive users, so the number of stores grows with the data.
Attributes the event table lacks (discount, weather, flags) follow fixed formulas of
store, product and day; ``bronze`` adds repeated and defective rows the same way, so
that the cleaning rules have something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.arrays import SLOTS
from shelfline.functions.text import record_hash
from shelfline.session import shuffle_width

# Product number per event type.
PRODUCT_OF_EVENT = {"click": 101, "view": 230, "signup": 345, "purchase": 512, "error": 704}


POS_COLUMNS = [
    "ts AS timestamp", "int(user_id DIV 10 + 1) AS store_id",
    "CASE event_type " + " ".join(f"WHEN '{e}' THEN {n}" for e, n in PRODUCT_OF_EVENT.items()) + " ELSE 865 END AS product_id",
    "event_id AS transaction_id", "value AS units_sold",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-of-sale rows."""
    return table(spark, sf_dir, "events").selectExpr(*POS_COLUMNS)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per store, product and day with two 24-slot arrays.

    A single hash aggregation folds the rows into slots: 24 conditional sums are
    combined before the shuffle, so a hot store adds no more than one row per map
    task and day. A slot without a sale counts as stocked out.
    """
    slots = range(SLOTS)
    folded = (
        pos(spark, sf_dir)
        .selectExpr("*", "to_date(timestamp) AS d", "hour(timestamp) AS h")
        .groupBy("store_id", "product_id", "d")
        .agg(
            F.expr("round(sum(units_sold), 4) AS sale_amount"),
            *[F.expr(f"round(sum(units_sold) FILTER (WHERE h = {h}), 4) AS h{h}") for h in slots],
        )
    )
    return folded.selectExpr(
        "(store_id - 1) % 18 + 1 AS city_id", "store_id", "product_id",
        "product_id % 3 AS management_group_id", "product_id % 5 AS first_category_id",
        "product_id % 7 AS second_category_id", "product_id % 11 AS third_category_id",
        "date_format(d, 'yyyy-MM-dd') AS dt", "sale_amount",
        "array(" + ", ".join(f"coalesce(h{h}, 0D)" for h in slots) + ") AS hours_sale",
        " + ".join(f"int(h{h} IS NULL)" for h in range(6, 22)) + " AS stock_hour6_22_cnt",
        "array(" + ", ".join(f"int(h{h} IS NULL)" for h in slots) + ") AS hours_stock_status",
        "round(1D - ((store_id + product_id + day(d)) % 4) * 0.1D, 1) AS discount",
        "int(day(d) IN (1, 15)) AS holiday_flag", "int((product_id + day(d)) % 5 = 0) AS activity_flag",
        "(day(d) * 7) % 30 / 10D AS precpt", "double(day(d)) - 2 AS avg_temperature",
        "double(30 + (day(d) * 3) % 60) AS avg_humidity", "(day(d) % 6) / 2D AS avg_wind_level",
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily rows with lineage, repeated deliveries and injected defects."""
    return (
        daily(spark, sf_dir)
        .selectExpr("*", "day(to_date(dt)) AS n", "store_id + product_id + day(to_date(dt)) AS mix")
        .selectExpr("*", "explode(IF(mix % 5 = 0, array(0, 1), array(0))) AS copy")
        # every second pair of deliveries carries the same load time, so the file hash decides
        .selectExpr(
            "* EXCEPT (hours_sale, hours_stock_status, sale_amount)",
            "IF(mix % 13 = 0, slice(hours_sale, 1, 23), hours_sale) AS hours_sale",
            "IF(mix % 23 <> 0, hours_stock_status, NULL) AS hours_stock_status",
            "CASE WHEN mix % 17 = 0 THEN -1D WHEN mix % 19 <> 0 THEN sale_amount + copy END AS sale_amount",
            "concat(IF(n <= 20, 'train', 'eval'), '-', copy, '.parquet') AS source_file",
            "sha2(concat(IF(n <= 20, 'train', 'eval'), '-', copy, '.parquet'), 256) AS source_file_hash",
            "IF(n <= 20, 'train', 'eval') AS source_split", "concat('batch-', copy) AS ingestion_batch_id",
            "IF(copy = 1 AND mix % 2 = 0, '2024-02-02T00:00:00', '2024-02-01T00:00:00') AS ingested_at",
            "'1.0' AS schema_version",
        )
        .drop("copy", "mix", "n")
        .withColumn("record_hash", record_hash(F.col("store_id"), F.col("product_id"), F.col("dt")))
    )


#: order lines that one task gathers
TASK_LINES = 500_000


def order_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily demand per store and product from order lines; one row per key and day.

    Hardly any two lines share a key and day, so an aggregate before the shuffle would hold every line of its task and combine
    nothing. The lines are dealt by store and product instead, to as many tasks as their number asks for, which also serves aggregates by series.
    """
    lines = table(spark, sf_dir, "lineitem")
    tasks = max(shuffle_width(spark), -(-lines.count() // TASK_LINES))  # the count comes from the files' footers
    return (
        lines.select(
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.to_date("l_shipdate").alias("dt"),
            "l_quantity", "l_discount",
        )
        .repartition(tasks, "store_id", "product_id")
        .groupBy("store_id", "product_id", "dt")
        .agg(
            F.round(F.sum("l_quantity"), 4).alias("sale_amount"),
            F.round(F.lit(1.0) - F.avg("l_discount"), 4).alias("discount"),
            F.count("*").alias("n_lines"),
        )
    )
