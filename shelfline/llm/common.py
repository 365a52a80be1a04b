"""Helpers shared by the operators on training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import materialize

#: ASCII white space as a regular-expression class body: space and the controls 9 to 13
WS = r"\x20\x09-\x0D"
WORD = f"[^{WS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and safe from lost executors."""
    return materialize(df, f"llm-{name}")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def null_key(col: str) -> Column:
    """A string key that is never null, so that nulls meet each other in joins."""
    return F.when(F.col(col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(col).cast("string")))


def packed(docs: DataFrame, row: str) -> DataFrame:
    """The documents as one struct ``doc`` beside a row key, so that no column of theirs can clash with a helper column."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias(row))
