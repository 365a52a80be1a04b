"""Lineage, bronze checks and series sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.text import hash_uniform, record_hash, source_split

# Columns a bronze batch must have.
REQUIRED = ["city_id", "store_id", "product_id", "dt", "sale_amount", "hours_sale", "hours_stock_status"]


def add_lineage(df: DataFrame, batch_id: str, ts: Column, path: Column, hashes: DataFrame | None = None,
                schema_version: str = "1.0", key=("store_id", "product_id", "dt")) -> DataFrame:
    """Lineage columns and the record hash; file hashes come from a manifest by file name."""
    out = df.withColumns(
        {
            "source_file": F.element_at(F.split(path, "/"), -1),
            "source_split": source_split(path),
            "ingestion_batch_id": F.lit(batch_id),
            "ingested_at": ts,
            "schema_version": F.lit(schema_version),
            "record_hash": record_hash(*[F.col(c) for c in key]),
        }
    )
    if hashes is None:
        return out
    names = hashes.select(F.col("filename").alias("source_file"), F.col("sha256").alias("source_file_hash"))
    # one file may hold a large part of all rows, so the rows should not be shuffled by file
    return out.join(names, "source_file", "left")


def bronze_checks(df: DataFrame, required=REQUIRED) -> DataFrame:
    """One row per check: rows present, columns present, no required column wholly NULL."""
    present = [c for c in required if c in df.columns]
    missing = [c for c in required if c not in df.columns]
    counts = df.agg(F.count("*").alias("n"), *[F.count(c).alias(f"c_{c}") for c in present])
    check = lambda name, passed, detail: F.struct(
        F.lit(name).alias("name"), passed.alias("passed"), detail.alias("detail"))
    rows = [
        check("total_rows_nonzero", F.col("n") > 0, F.concat(F.lit("Total rows: "), F.col("n").cast("string"))),
        check("required_columns", F.lit(not missing), F.lit(f"Missing: {missing}" if missing else "All present")),
        *[check(f"not_all_null:{c}", F.col(f"c_{c}") > 0, F.concat(F.lit("Non-null: "), F.col(f"c_{c}").cast("string")))
          for c in present],
    ]
    return counts.select(F.inline(F.array(*rows)))


def sample_series(df: DataFrame, n: int, seed: int = 42, keys=("store_id", "product_id")) -> DataFrame:
    """All rows of ``n`` series picked by a seeded hash: a top-n of the distinct keys, then a semi join."""
    picked = (
        df.select(*keys).distinct()
        .orderBy(hash_uniform(seed, *[F.col(k) for k in keys]), *keys)
        .limit(n)
    )
    return df.join(picked, list(keys), "left_semi")


def sample_fraction(df: DataFrame, fraction: float, seed: int, *keys: str) -> DataFrame:
    """A repeatable row sample: rows whose key hash falls below the fraction."""
    return df.filter(hash_uniform(seed, *[F.col(k) for k in keys]) < fraction)
