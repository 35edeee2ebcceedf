"""Row numbers within groups of any size.

``row_number() over (partition by g order by o)`` puts a whole group into one
task. Here rows are range-partitioned by (g, o), so a group that holds a third of
all rows spreads over a third of the ranges; a row's number is its place in its
range plus the group's rows in the ranges before, which come from one small count
per (range, group). The ranges are written once, because the counts and the rows
must see the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import scratch_path

RANGE = "_range"


def by_name(df: DataFrame, order: Sequence[Column | str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() if isinstance(c, str) else c for c in order]


def write_ranges(df: DataFrame, order: Sequence[Column | str], path: str, ranges: int | None = None) -> DataFrame:
    """``df`` as a Parquet table of sorted ranges, read back: folder ``_range=i``
    holds the i-th, ``_tie`` is the last sort column. Rows that tie in ``order`` are told apart by a hash of all columns;
    equal rows stay together, as they are interchangeable."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # maps have no hash
    hashed = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    keys = [*by_name(df, order), F.col("_tie")]
    out = (df.withColumn("_tie", F.xxhash64(*hashed)).repartitionByRange(ranges, *keys).withColumn(RANGE, F.spark_partition_id())
           .sortWithinPartitions(*keys))
    out.write.partitionBy(RANGE).parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "rank",
                ranges: int | None = None) -> DataFrame:
    """``df`` with ``name`` (long, from 1): the row's number in its group in
    ``order``; nulls in ``group`` form one group."""
    rows = write_ranges(df, [*group, *order], scratch_path(df.sparkSession, "ranges"), ranges)
    own = [F.col(f"`{c}`") for c in group]
    place = F.row_number().over(Window.partitionBy(RANGE, *own).orderBy(*by_name(df, order), "_tie"))
    # a row per range and group: few more than there are ranges or groups
    counts = rows.groupBy(RANGE, *own).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*own).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1))
    key = F.struct(RANGE, *own).alias("_key")       # equal also where a group's value is null
    starts = counts.select(key, F.coalesce(before, F.lit(0)).alias("_before"))
    return (rows.withColumn("_place", place).withColumn("_key", key).join(starts, "_key")
            .select(*df.columns, (F.col("_place") + F.col("_before")).cast("long").alias(name)))
