"""Parquet, CSV and JSON sources and sinks, and the file manifest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.text import source_split
from shelfline.sources.hashes import file_hashes


def read_raw(spark: SparkSession, path: str, schema=None, pattern: str = "*.parquet") -> DataFrame:
    """All Parquet files below a folder as one table, with the path of each row's file."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path).withColumn("source_path", F.col("_metadata.file_path"))


def read_bronze(spark: SparkSession, path: str, date: str | None = None, split: str | None = None) -> DataFrame:
    """The bronze table; both filters prune partitions before any file is opened."""
    df = spark.read.parquet(path)
    if date is not None:
        df = df.filter(F.col("ingestion_date") == F.lit(date).cast("date"))
    if split is not None:
        df = df.filter(F.col("source_split") == split)
    return df


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing is there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_bronze(df: DataFrame, path: str, batch_id: str, ingestion_date: str) -> DataFrame:
    """Append a batch partitioned by split and date, leaving out files it already holds.

    The files of the batch that are stored are found from the partition of that date
    with two columns read. That list is counted before it is broadcast: one file may hold
    a large part of the batch, so the rows should not be shuffled by file.
    """
    spark = df.sparkSession
    new = df.withColumn("ingestion_date", F.lit(ingestion_date).cast("date")).withColumn("ingestion_batch_id", F.lit(batch_id))
    stored = read_if_exists(spark, path)
    if stored is not None:
        done = (
            stored.filter(F.col("ingestion_date") == F.lit(ingestion_date).cast("date"))
            .filter(F.col("ingestion_batch_id") == batch_id)
            .select("ingestion_batch_id", "source_file").distinct()
        )
        new = new.join(done, ["ingestion_batch_id", "source_file"], "left_anti")
    new.write.partitionBy("source_split", "ingestion_date").mode("append").parquet(path)
    return new


def write_scores(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def read_scores(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def write_profile(df: DataFrame, path: str) -> None:
    df.write.json(path)


def read_profile(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def arrays_to_json(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.to_json(c) for c in cols})


def json_to_arrays(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.from_json(F.col(c), f"array<{t}>") for c, t in spec.items()})


def build_manifest(spark: SparkSession, path: str, pattern: str = "*", hashed: bool = True) -> DataFrame:
    """Name, relative path, size, sha256, split and flag of each file below a folder.

    Files of any size are hashed on the executors block by block; without ``hashed`` they are only listed.
    """
    return file_hashes(spark, path, pattern, hashed).select(
        "filename", "relative_path", "size_bytes", "sha256", source_split(F.col("path")).alias("source_split"), F.lit(False).alias("ingested"))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count("*").alias("total_files"), F.sum("size_bytes").alias("total_bytes"))


def verify_manifest(manifest: DataFrame, rescanned: DataFrame) -> DataFrame:
    """OK, MISSING or CORRUPTED per listed file."""
    actual = rescanned.select("relative_path", F.col("sha256").alias("actual_hash"))
    status = (
        F.when(F.col("actual_hash").isNull(), "MISSING")
        .when(F.col("actual_hash") == F.col("sha256"), "OK")
        .otherwise("CORRUPTED")
    )
    return manifest.join(actual, "relative_path", "left").withColumn("status", status)


def manifest_summary(verified: DataFrame) -> DataFrame:
    return verified.groupBy("status").agg(F.count("*").alias("files"))


def pending_files(manifest: DataFrame) -> DataFrame:
    return manifest.filter("NOT ingested")


def parquet_files(manifest: DataFrame) -> DataFrame:
    return manifest.filter(F.col("filename").endswith(".parquet"))


def mark_ingested(manifest: DataFrame, filename: str | Column) -> DataFrame:
    return manifest.withColumn("ingested", F.col("ingested") | (F.col("filename") == filename))
