"""Incremental cursor (K9, K10) and run summaries.

The cursor is a tiny append-only Parquet table ``(last_run_end, updated_at)``;
its current value is ``max(last_run_end)``, null before the first run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import CONTROL
from .tables import table_exists


def read_cursor(spark: SparkSession, path: str, ts_type: str = "timestamp") -> Column:
    """Scalar column: the last saved window end, or null (first run)."""
    if not table_exists(spark, path):
        return F.lit(None).cast(ts_type)
    df = spark.read.schema(CONTROL).parquet(path)
    return df.select(F.max("last_run_end").cast(ts_type)).scalar()


def save_cursor(spark: SparkSession, path: str, end: Column) -> None:
    """Append the new window end; done after each run, even an empty one."""
    (spark.range(1).select(end.cast("timestamp").alias("last_run_end"),
                           F.current_timestamp().alias("updated_at"))
     .write.mode("append").parquet(path))


def run_summary(df: DataFrame, batch: str, ts: str, name: str = "n_rows") -> DataFrame:
    """Rows, first and last timestamp per batch."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias(name),
                                 F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
