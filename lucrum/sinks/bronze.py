"""Bronze landing (K1-K4, K13): JSONL partitioned by execution date.

One Spark write per batch: rows carry their ``year``/``month``/``day``
(zero-padded strings of the execution instant), ``_ingested_at`` and a
``batch_label`` lineage column; ``partitionBy`` lays out the
``year=YYYY/month=MM/day=DD`` directories. Append mode, so a later run on the
same day never replaces an earlier one's files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.paths import partition_parts, window_label
from ..operators.nested import tag

PARTITION_COLUMNS = ["year", "month", "day"]
# ISO-8601 with microseconds, so typed timestamps survive the
# JSON round trip (Spark's default keeps milliseconds only).
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def stamp(df: DataFrame, execution_ts: Column | str, name: str = "data",
          date_from: Column | str | None = None, date_to: Column | str | None = None,
          ingested_at_format: str | None = None) -> DataFrame:
    """Adds ``_ingested_at`` (overriding any existing one, K3), the partition
    parts of ``execution_ts`` (K2) and ``batch_label`` (K4)."""
    ts = F.col(execution_ts) if isinstance(execution_ts, str) else execution_ts
    f = ts if date_from is None else (F.col(date_from) if isinstance(date_from, str) else date_from)
    t = ts if date_to is None else (F.col(date_to) if isinstance(date_to, str) else date_to)
    ing = F.date_format(ts, ingested_at_format) if ingested_at_format else ts
    parts = partition_parts(ts)
    return tag(df, "_ingested_at", ing).select(
        "*", *[c.alias(n) for n, c in parts.items()],
        window_label(name, f, t).alias("batch_label"))


def land_jsonl(df: DataFrame, root: str, skip_empty: bool = False,
               summary_ts: str | None = None, compression: str = "none") -> dict:
    """Append ``df`` (already stamped) as JSON lines under ``root``.

    Rows are clustered by partition with the ``rebalance`` hint: each
    directory receives few files, and AQE splits a day holding a large share
    of the rows over several tasks instead of one. With ``skip_empty`` an
    empty batch writes nothing (K13); appending zero rows is harmless
    otherwise. ``compression`` is the codec of the files ("gzip": about a tenth of
    the bytes; a file is then read by one task, and the rebalance bounds files).
    Returns the run summary (K11) — rows written and, with
    ``summary_ts``, the first and last value of that column — gathered by
    ``observe`` during the write, without a second pass over the data."""
    if skip_empty and df.isEmpty():
        return {"written": False, "rows": 0, "root": root}
    metrics = [F.count(F.lit(1)).alias("rows")]
    if summary_ts:
        metrics += [F.min(summary_ts).alias("first_ts"), F.max(summary_ts).alias("last_ts")]
    obs = Observation("bronze_landing")
    (df.observe(obs, *metrics).hint("rebalance", *PARTITION_COLUMNS)
       .write.mode("append").partitionBy(*PARTITION_COLUMNS)
       .option("compression", compression)
       .option("timestampNTZFormat", TS_NTZ_FORMAT).option("timestampFormat", TS_FORMAT)
       .json(root))
    return {"written": True, "root": root, **obs.get}
