"""Small literal lookups: product catalogue, store names, category variation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name, category, shelf life in days, unit cost, retail price.
PRODUCT_CATALOG = [
    ("Organic Strawberries 500g", "Berries", 3, 3.80, 6.50),
    ("Whole Milk 1L", "Dairy", 7, 1.20, 2.00),
    ("Avocados 4-Pack", "Produce", 4, 2.50, 4.20),
    ("Artisanal Sourdough", "Bakery", 2, 1.80, 3.50),
    ("Baby Spinach 250g", "Greens", 3, 2.20, 3.80),
    ("Fresh Atlantic Salmon 400g", "Seafood", 2, 6.50, 11.90),
    ("Gala Apples 1kg", "Fruit", 10, 1.90, 3.40),
    ("Greek Yogurt 500g", "Dairy", 12, 1.60, 2.90),
    ("Organic Blueberries 250g", "Berries", 4, 2.80, 4.90),
    ("Grass-Fed Ribeye Steak", "Meat", 4, 8.50, 14.90),
    ("Fresh Hass Avocados", "Produce", 5, 1.50, 2.80),
    ("Butter Croissants 4-Pack", "Bakery", 2, 2.10, 3.90),
    ("Cherry Tomatoes 250g", "Produce", 5, 1.40, 2.60),
    ("Organic Bananas Bunch", "Fruit", 4, 0.90, 1.80),
    ("Free-Range Eggs 12-Pack", "Dairy", 14, 2.40, 4.50),
    ("Baby Carrots 500g", "Produce", 8, 1.10, 2.20),
    ("Wild Caught Shrimp 500g", "Seafood", 2, 7.20, 12.80),
    ("Fresh Sweet Basil 50g", "Greens", 3, 1.30, 2.50),
    ("Sharp Cheddar Cheese 250g", "Dairy", 21, 2.60, 4.80),
    ("French Garlic Baguette", "Bakery", 2, 1.50, 2.90),
]
# Store names.
STORE_NAMES = [
    "Metro Downtown Supercenter", "Suburb West Hypermarket", "East Riverside Express", "Northside Plaza Market",
    "Central Station Mart", "Uptown Organic Hub", "Harborview Fresh Market", "West End Grocers",
    "Grand Avenue Supermarket", "Valley Fair Foods",
]
# Coefficient of variation of demand by category, and the default.
CATEGORY_CV = {
    "Berries": 0.35, "Fruit": 0.30, "Greens": 0.30, "Produce": 0.28, "Vegetables": 0.25, "Bakery": 0.18,
    "Meat": 0.22, "Seafood": 0.28, "Dairy": 0.10, "High": 0.32, "Medium": 0.22, "Low": 0.12,
}
DEFAULT_CV = 0.22


def catalogue(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(PRODUCT_CATALOG)]
    return spark.createDataFrame(rows, "slot int, product_name string, category string, shelf_life_days int, unit_cost double, retail_price double")


def catalog_lookup(df: DataFrame, id_col: str) -> DataFrame:
    """Name, category, shelf life, cost and price by id modulo the catalogue (20 literal rows)."""
    slot = (F.col(id_col) % len(PRODUCT_CATALOG)).cast("int")
    return (
        df.withColumn("slot", slot).join(F.broadcast(catalogue(df.sparkSession)), "slot").drop("slot")
        .withColumn("display_name", F.concat(F.lit("SKU-"), F.col(id_col).cast("string"), F.lit(" | "), F.col("product_name")))
    )


def store_name(store_id: Column) -> Column:
    names = F.array(*[F.lit(n) for n in STORE_NAMES])
    return F.element_at(names, (store_id % len(STORE_NAMES) + 1).cast("int"))


def category_cv(category: Column) -> Column:
    pairs = [F.lit(x) for item in CATEGORY_CV.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), category), F.lit(DEFAULT_CV))
