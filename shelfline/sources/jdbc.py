"""JDBC tables. The date filter reaches the database; reads can be split over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table_jdbc(spark: SparkSession, url: str, table: str, where: str | None = None,
                    partition: tuple[str, int, int, int] | None = None, **props) -> DataFrame:
    """A table or the rows ``where`` selects. ``partition`` is (column, lower, upper, tasks):
    without it one task reads the whole table, so name a key for anything large."""
    source = f"(SELECT * FROM {table} WHERE {where}) AS src" if where else table
    if partition is None:
        return spark.read.jdbc(url, source, properties=props)
    column, lower, upper, tasks = partition
    return spark.read.jdbc(url, source, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=tasks, properties=props)


def write_table_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", columns=None,
                     connections: int = 32, **props) -> None:
    """Write the declared columns only, over at most ``connections`` tasks; arrays go as JSON text."""
    out = df.select(*columns) if columns else df
    arrays = [f.name for f in out.schema.fields if f.dataType.typeName() in ("array", "struct")]
    out = out.withColumns({c: F.to_json(c) for c in arrays}) if arrays else out
    out.write.option("numPartitions", connections).jdbc(url, table, mode=mode, properties=props)
