"""Backfill tiling and per-window audits.

Windows are contiguous ``[from, to)`` spans of ``window_days`` starting
``horizon_days`` before ``now``; the last one is clipped at ``now``. Rows are
assigned to a window by arithmetic on their timestamp (an equi-key), never by
a range join, so counting is one partial aggregation plus a join against the
window table, whose size is fixed by ``horizon_days / window_days``.

:func:`split` goes on until no window reaches the source's cap, so that none is cut
short there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import scratch_path
from ..functions.paths import partition_parts
from ..functions.time import WINDOW_STAMP

# The reference's backfill horizon and step, and its page cap.
MONTHS_BACK = 6
DAYS_PER_MONTH = 30
WINDOW_DAYS = 7
PAGE_SIZE = 50
MAX_PAGES = 200
WINDOW_ROW_CAP = PAGE_SIZE * MAX_PAGES


def tile(spark: SparkSession, now: Column, horizon_days: int = MONTHS_BACK * DAYS_PER_MONTH,
         window_days: int = WINDOW_DAYS, ts_type: str = "timestamp_ntz") -> DataFrame:
    """``(window_index, date_from, date_to, execution_dt)``, one row per window.

    ``now`` is a scalar column (a literal or a scalar subquery); it is floored
    to midnight. Bounds are ``ts_type``: ``timestamp_ntz`` (default) keeps UTC
    wall-clock midnights whatever the session time zone; ``timestamp`` gives
    session-zone midnights as instants. ``sequence`` includes its end, so it
    stops one microsecond before ``now`` — otherwise a horizon of whole weeks
    would gain an empty window."""
    end = F.to_date(now).cast(ts_type)
    start = end - F.make_dt_interval(F.lit(horizon_days))
    step = F.make_dt_interval(F.lit(window_days))
    one_us = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001))
    starts = F.sequence(start, end - one_us, step)
    w = spark.range(1).select(F.posexplode(starts).alias("window_index", "date_from"),
                              end.alias("_end"))
    w = w.withColumn("date_to", F.least(F.col("date_from") + step, F.col("_end")))
    return w.select("window_index", "date_from", "date_to",
                    F.col("date_to").alias("execution_dt"))


def describe(windows: DataFrame) -> DataFrame:
    """Adds the text forms used for file names and partitions."""
    parts = partition_parts("execution_dt")
    return windows.select(
        "*",
        F.date_format("date_from", WINDOW_STAMP).alias("date_from_text"),
        F.date_format("date_to", WINDOW_STAMP).alias("date_to_text"),
        *[c.alias(n) for n, c in parts.items()])


def window_index(ts: Column, start: Column, window_days: int = WINDOW_DAYS) -> Column:
    """Index of the window holding ``ts`` (``floor((ts - start) / step)``)."""
    step_us = window_days * 86_400 * 1_000_000
    return F.floor(F.timestamp_diff("MICROSECOND", start, ts) / F.lit(step_us)).cast("int")


def assign(rows: DataFrame, ts: str, windows: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Rows inside the tiled span, tagged with ``window_index`` (C11)."""
    bounds = windows.agg(F.min("date_from").alias("lo"), F.max("date_to").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    inside = rows.filter((F.col(ts) >= lo) & (F.col(ts) < hi))
    return inside.withColumn("window_index", window_index(F.col(ts), lo, window_days))


def counts(rows: DataFrame, ts: str, windows: DataFrame, window_days: int = WINDOW_DAYS,
           name: str = "n_rows") -> DataFrame:
    """Rows per window, 0 for empty windows (A2)."""
    per = (assign(rows, ts, windows, window_days)
           .groupBy("window_index").agg(F.count(F.lit(1)).alias(name)))
    return (windows.join(per, "window_index", "left")
            .select(*windows.columns, F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)))


def rollup_counts(rows: DataFrame, ts: str, windows: DataFrame, window_days: int = WINDOW_DAYS,
                  name: str = "n_rows") -> DataFrame:
    """Per-window counts plus a grand-total row with a null window (A3)."""
    per = counts(rows, ts, windows, window_days, name).select("window_index", name)
    return per.rollup("window_index").agg(F.sum(name).cast("bigint").alias(name))


def cap_audit(window_counts: DataFrame, name: str = "n_rows", cap: int = WINDOW_ROW_CAP) -> DataFrame:
    """Flags windows whose count reached the source's page cap and may have
    been cut short (A4)."""
    return window_counts.withColumn("may_be_truncated", F.col(name) >= F.lit(cap))


EPOCH = "timestamp_ntz'1970-01-01'"
SPLIT = 4


def _micros(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, cast(`{ts}` as timestamp_ntz))")


def _instant(us: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {us}, {EPOCH})")


def split(rows: DataFrame, ts: str, windows: DataFrame, cap: int = WINDOW_ROW_CAP, parts: int = SPLIT,
          window_days: int = WINDOW_DAYS) -> DataFrame:
    """Windows that stay below the source's cap (A4, C10): ``(date_from, date_to,
    n_rows, over_cap)``, contiguous over the span of ``windows`` (from :func:`tile`,
    ``timestamp_ntz``).

    A window of ``cap`` rows or more is cut into ``parts`` equal ones, these again,
    until each is below; only one of a microsecond can't be cut, and is flagged
    ``over_cap`` if it still reaches the cap. The rows are read once, for the count
    of each distinct instant; a round then works on the instants and windows that
    are left, so rounds get smaller, and there are at most log(window / 1 us) of
    them."""
    if cap < 1 or parts < 2:
        raise ValueError("cap must be 1 or more, parts 2 or more")
    spark = rows.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"split-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    left = windows.select("window_index", _micros("date_from").alias("s"), _micros("date_to").alias("e"))
    instants = (assign(rows, ts, windows, window_days).groupBy("window_index", _micros(ts).alias("t")).agg(F.count(F.lit(1)).alias("n"))
                .join(left, "window_index").select("s", "e", "t", "n"))
    left, instants, out = left.select("s", "e"), kept(instants, "instants"), []
    while True:
        counted = kept(left.join(instants.groupBy("s", "e").agg(F.sum("n").alias("n")), ["s", "e"], "left")
                       .select("s", "e", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows")), "windows")
        full = (F.col("n_rows") >= cap) & (F.col("e") - F.col("s") > 1)
        out.append(counted.where(~full))
        cut = counted.where(full).withColumn("width", F.expr(f"(e - s + {parts - 1}) div {parts}"))
        if cut.isEmpty():
            break
        left = cut.select(F.explode(F.expr("transform(sequence(s, e - 1, width), x -> named_struct('s', x, 'e', least(x + width, e)))")).alias("w")).select("w.*")
        instants = kept(instants.join(cut, ["s", "e"]).withColumn("s", F.expr("s + (t - s) div width * width")).select(
            "s", F.expr("least(s + width, e)").alias("e"), "t", "n"), "instants")
    done = out[0]
    for more in out[1:]:
        done = done.unionByName(more)
    return done.select(_instant("s").alias("date_from"), _instant("e").alias("date_to"), "n_rows", (F.col("n_rows") >= cap).alias("over_cap"))
