"""Run log from the counts a write observes on its way: no extra pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = """pipeline_run_id string, pipeline_name string, started_at timestamp_ntz, ended_at timestamp_ntz,
status string, source_rows bigint, accepted_rows bigint, rejected_rows bigint, output_rows bigint,
duration_seconds double, error_type string"""


def observed(df: DataFrame, name: str, valid: Column) -> tuple[DataFrame, Observation]:
    """Attach row counts to a plan; they are available after its action."""
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("source_rows"), F.count_if(valid).alias("accepted_rows")), seen


def run_row(spark: SparkSession, run_id: str, name: str, started, ended, counts: dict, error: str | None = None) -> DataFrame:
    """The one-row log entry of a finished run."""
    source, accepted = counts.get("source_rows", 0), counts.get("accepted_rows", 0)
    row = (run_id, name, started, ended, "FAILED" if error else "SUCCESS", source, accepted, source - accepted,
           accepted, (ended - started).total_seconds(), error)
    return spark.createDataFrame([row], RUN_SCHEMA)
