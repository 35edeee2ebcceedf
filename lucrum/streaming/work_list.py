"""Streaming form of the shipment work list.

Two kinds of landed records meet in one stream: shipping ids that orders name, and
shipments that were fetched. Keyed state remembers for each id whether it was
offered for fetching and whether its shipment came. An id is offered once when an
order first names it, and again after ``retry`` as long as no shipment came, so a
failed fetch is not forgotten and a pending one not repeated every run. A shipment
that comes first, or after any number of offers, settles the id.

Every change of an id's state is upserted into the table, keyed by id: ``offers``
(times offered so far), ``done``, and ``step`` (its own version, so a replayed
micro-batch changes nothing). The work list is the table's ids that are not done:
the same as the batch anti-join (:func:`lucrum.plans.incremental.pending_by_id`),
however the files fall into micro-batches and whether the run was interrupted.

State is a few numbers an id, and an id that is done is kept: an order may name it
again. Ids are dealt by hash into :data:`BUCKETS` buckets, which are the keys of the
state: a call of the function takes all rows of a bucket in a micro-batch and works on
arrays, so calls don't grow with the ids. The buckets' number is part of the
checkpoint's state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sinks.tables import create_table, upsert

INPUT = T.StructType([T.StructField("shipping_id", T.LongType()), T.StructField("fetched", T.BooleanType())])
WORK_LIST = T.StructType([T.StructField("shipping_id", T.LongType()), T.StructField("offers", T.IntegerType()),
                          T.StructField("done", T.BooleanType()), T.StructField("step", T.IntegerType())])
# one entry an id, in the order of ids
FIELDS = {"ids": "<i8", "offers": "<i4", "done": "?", "step": "<i4", "due": "<i8"}
STATE = ", ".join(f"{c} binary" for c in FIELDS)
DAY_MS = 86_400_000
BUCKETS = 4_096


def offer(retry_ms: int):
    """The state transition of one bucket of ids."""
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else (b"",) * len(FIELDS)
        ids, offers, done, step, due = (np.frombuffer(bytes(b), kind) for b, kind in zip(kept, FIELDS.values()))
        known, now = len(ids), state.getCurrentProcessingTimeMs()
        named, fetched = np.zeros(0, "<i8"), np.zeros(0, "<i8")
        for f in () if state.hasTimedOut else frames:
            at = f["shipping_id"].to_numpy("<i8")
            named = np.union1d(named, at)
            fetched = np.union1d(fetched, at[f["fetched"].eq(True).to_numpy(bool)])
        new = np.setdiff1d(named, ids)
        order = np.argsort(np.concatenate([ids, new]), kind="stable")
        grown = lambda a: np.concatenate([a, np.zeros(len(new), a.dtype)])[order]
        ids, offers, done, step, due = np.concatenate([ids, new])[order], grown(offers), grown(done), grown(step), grown(due)
        here, before, was = np.isin(ids, named), offers.copy(), done.copy()
        done |= np.isin(ids, fetched)
        again = ~here & ~done & (due <= now)        # offered before, and nothing came
        offers[(here & ~done & (offers == 0)) | again] += 1
        changed = (order >= known) | (offers != before) | (done != was)
        step[changed] += 1
        due[(here | again) & ~done] = now + retry_ms
        if changed.any():
            yield pd.DataFrame({"shipping_id": ids[changed], "offers": offers[changed], "done": done[changed], "step": step[changed]})
        state.update(tuple(a.astype(kind).tobytes() for a, kind in zip((ids, offers, done, step, due), FIELDS.values())))
        if not done.all():
            state.setTimeoutDuration(int(max(due[~done].min() - now, 1)))
    return run


def stream_work_list(spark: SparkSession, source_dir: str, table: str, table_root: str, checkpoint: str, retry_ms: int = DAY_MS,
                     max_files_per_trigger: int | None = None, timeout_s: float | None = None) -> None:
    """Take every file of :data:`INPUT` rows now in ``source_dir`` (from orders with
    ``fetched`` false, from shipments true; null and 0 are no ids) into the work
    list ``table`` under ``table_root``. Offers that are due again are made with the
    next micro-batch after ``retry_ms``."""
    create_table(spark, table, WORK_LIST, table_root)
    reader = spark.readStream.schema(INPUT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    ids = reader.parquet(source_dir).where(F.col("shipping_id").isNotNull() & (F.col("shipping_id") != 0))
    changes = ids.withColumn("bucket", F.pmod(F.xxhash64("shipping_id"), F.lit(BUCKETS))).groupBy("bucket").applyInPandasWithState(
        offer(retry_ms), WORK_LIST, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)

    def save(batch: DataFrame, epoch_id: int) -> None:
        upsert(spark, table, batch, ["shipping_id"], "step", check_unique=False)

    # a run ends with its files: no further micro-batch just to look at the clock
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    q = (changes.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())       # which copies the session's settings
    spark.conf.set(setting, before)
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s} s")
    if q.exception() is not None:
        raise q.exception()


def pending(spark: SparkSession, table: str) -> DataFrame:
    """The ids still to be fetched."""
    return spark.table(table).where(~F.col("done")).select("shipping_id")
