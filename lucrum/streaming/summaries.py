"""Run summaries of streams (K11): one row per micro-batch.

The rows are counted by ``observe`` while the micro-batch is processed, without a
second pass; a listener takes the figures from each batch's progress and appends
them to a Parquet table. A micro-batch without rows gives none. A batch that is
processed again after a failure has one row for each time; the last is its own.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

SUMMARIES = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("n_rows", T.LongType()),
                          T.StructField("first_us", T.LongType()), T.StructField("last_us", T.LongType())])
METRICS = "run_summary"
EPOCH = "timestamp_ntz'1970-01-01'"


def observed(stream: DataFrame, ts: str) -> DataFrame:
    """``stream`` with its rows, first and last ``ts`` (as wall-clock microseconds)
    counted per micro-batch."""
    us = F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, cast(`{ts}` as timestamp_ntz))")
    return stream.observe(METRICS, F.count(F.lit(1)).alias("n_rows"), F.min(us).alias("first_us"), F.max(us).alias("last_us"))


class _Listener(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended, self.error = spark, path, threading.Event(), None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if METRICS not in p.observedMetrics or not p.observedMetrics[METRICS].n_rows:
            return
        m = p.observedMetrics[METRICS]
        try:
            (self.spark.createDataFrame([(p.batchId, m.n_rows, m.first_us, m.last_us)], SUMMARIES).coalesce(1)
             .write.mode("append").parquet(self.path))
        except Exception as e:      # the listener's thread has nobody to raise to
            self.error = e

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


@contextmanager
def collecting(spark: SparkSession, path: str, timeout_s: float = 60) -> Iterator[None]:
    """Within it, the micro-batches of one stream made with :func:`observed` leave
    their summary under ``path``; on leaving, the last ones are there."""
    listener = _Listener(spark, path)
    spark.streams.addListener(listener)
    try:
        yield
        if not listener.ended.wait(timeout_s):      # progress comes a little after the query's end
            raise TimeoutError("the stream's summaries did not come")
        if listener.error is not None:
            raise listener.error
    finally:
        spark.streams.removeListener(listener)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """``(batch_id, n_rows, first_ts, last_ts)``."""
    at = lambda c: F.expr(f"timestampadd(MICROSECOND, {c}, {EPOCH})")
    return spark.read.schema(SUMMARIES).parquet(path).select("batch_id", "n_rows", at("first_us").alias("first_ts"), at("last_us").alias("last_ts"))
