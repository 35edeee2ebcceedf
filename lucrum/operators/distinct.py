"""Exact distinct counts that can be merged (A1, A3).

The ids of a day are kept as bitmaps: one of 32,768 bits for each run of ids that
occurs. The distinct ids of any span of days are the OR of its days' bitmaps, so a
count over a window, or over all of them, reads the bitmaps and not the rows, and a
new day adds its own without touching the others. Ids are positive longs, best
dense (as running numbers are): a bitmap takes 4 KB however few bits are set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def daily_bitmaps(rows: DataFrame, ts: str, id_col: str) -> DataFrame:
    """``(day, bucket, bits)`` of the ids that are neither null nor zero.
    Partially aggregated before the shuffle; a bitmap is bounded, so a hot day is
    no large group."""
    ids = rows.where(F.col(id_col).isNotNull() & (F.col(id_col) != 0)).where(F.col(ts).isNotNull())
    return ids.groupBy(F.to_date(ts).alias("day"), F.bitmap_bucket_number(id_col).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, *by: Column) -> DataFrame:
    """``(*by, bucket, bits)``: days merged; ``by`` are expressions of ``day``."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_distinct(bitmaps: DataFrame, by: Column, name: str = "n_ids") -> DataFrame:
    """Distinct ids per value of ``by``, an expression of ``day``, and in total (a
    row with null). The total merges the groups' bitmaps: an id that occurs in two
    groups counts once."""
    key = "_by"
    per = merge_bitmaps(bitmaps, by.alias(key))
    total = merge_bitmaps(per).select(F.lit(None).cast(per.schema[key].dataType).alias(key), "bucket", "bits")
    label = bitmaps.select(by).columns[0]
    return (per.where(F.col(key).isNotNull()).unionByName(total).groupBy(key).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))
            .withColumnRenamed(key, label))
