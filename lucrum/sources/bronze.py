"""Bronze reads.

Always with an explicit schema (inference breaks on absent fields and
all-empty arrays). The whole bronze root is read with partition discovery, so
a day filter becomes partition pruning instead of a hand-built path.

:func:`read_jsonl` takes well-formed lines for granted: what doesn't parse becomes
null. :func:`read_checked` accounts for every line: it is a good row or it is
quarantined with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.paths import date_from_path

PART_FIELDS = [T.StructField("year", T.StringType()), T.StructField("month", T.StringType()),
               T.StructField("day", T.StringType())]
JSON_FILES = "*.json*"


def with_partitions(schema: T.StructType) -> T.StructType:
    names = {f.name for f in schema.fields}
    return T.StructType(schema.fields + [f for f in PART_FIELDS if f.name not in names])


def read_jsonl(spark: SparkSession, root: str, schema: T.StructType,
               file_glob: str = JSON_FILES) -> DataFrame:
    """All landed records under ``root`` (S1, S8), with the ``year``/``month``/
    ``day`` partition values as strings (padding kept)."""
    from ..sinks.bronze import TS_FORMAT, TS_NTZ_FORMAT
    return (spark.read.schema(with_partitions(schema))
            .option("basePath", root).option("pathGlobFilter", file_glob)
            .option("timestampNTZFormat", TS_NTZ_FORMAT).option("timestampFormat", TS_FORMAT)
            .option("mode", "PERMISSIVE").json(root))


#: why a line is quarantined
BROKEN, NOT_OBJECT, MISTYPED, UNKNOWN = "broken", "not_object", "mistyped", "unknown_fields"
_LINE, _CORRUPT = "value", "_corrupt_record"


def read_checked(spark: SparkSession, root: str, schema: T.StructType, file_glob: str = JSON_FILES,
                 unknown: str = "keep") -> tuple[DataFrame, DataFrame]:
    """All landed lines under ``root`` as two DataFrames, each line in exactly one.

    The first holds the lines that parse into ``schema``: its columns, the
    partition values, and ``_unknown``, a VARIANT object of the top-level fields
    that ``schema`` doesn't have (null if there are none).

    The second holds the others: ``reason``, ``line`` (the text as landed),
    ``document`` (the line as a VARIANT where it is JSON at all, so that nothing a
    repair needs is lost), ``file_path`` and the partition values. Reasons:

    * ``broken``: no JSON, such as a line cut off;
    * ``not_object``: JSON, but an array or a single value;
    * ``mistyped``: a field, nested ones too, holds what its type can't;
    * ``unknown_fields``: only with ``unknown="quarantine"``.

    Blank lines hold no record, as for the JSON source, and count for neither. A
    null or absent field is no error. Each DataFrame scans the files once."""
    if unknown not in ("keep", "quarantine"):
        raise ValueError(f"unknown must be 'keep' or 'quarantine', not {unknown!r}")
    from ..sinks.bronze import TS_FORMAT, TS_NTZ_FORMAT
    parts = [f.name for f in PART_FIELDS if f.name not in schema.names]
    lines = (spark.read.schema(with_partitions(T.StructType([T.StructField(_LINE, T.StringType())])))
             .option("basePath", root).option("pathGlobFilter", file_glob).text(root)
             .select("*", F.col("_metadata.file_path").alias("file_path")).where(F.trim(_LINE) != ""))
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    row = F.from_json(_LINE, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT,
                                    "timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_NTZ_FORMAT})
    document = F.try_parse_json(F.col(_LINE))
    known = F.array(*[F.lit(c) for c in schema.names]) if schema.names else F.array().cast("array<string>")
    others = F.array_except(F.json_object_keys(_LINE), known)
    object_like = F.ltrim(_LINE).startswith("{")
    reason = (F.when(F.col("_row").isNull() | F.col(f"_row.{_CORRUPT}").isNotNull() | ~object_like,
                     F.when(F.col("document").isNull(), BROKEN).when(~object_like, NOT_OBJECT).otherwise(MISTYPED)))
    if unknown == "quarantine":
        reason = reason.when(F.size("_others") > 0, UNKNOWN)
    read = lines.select("*", row.alias("_row"), document.alias("document"), others.alias("_others")).withColumn("reason", reason)
    # only the unknown fields, each as it stands in the line
    fields = F.from_json(_LINE, "map<string, variant>")
    rest = F.when(F.size("_others") > 0, F.parse_json(F.to_json(F.map_filter(fields, lambda k, _: F.array_contains("_others", k)))))
    good = read.where("reason is null").select(*[F.col(f"_row.`{c}`").alias(c) for c in schema.names], *parts, rest.alias("_unknown"))
    bad = read.where("reason is not null").select("reason", F.col(_LINE).alias("line"), "document", "file_path", *parts)
    return good, bad


def read_day(spark: SparkSession, root: str, schema: T.StructType, day,
             file_glob: str = JSON_FILES) -> DataFrame:
    """One execution day (S2): a partition filter the scan prunes on. A day
    with no files yields an empty DataFrame (S3), not an error."""
    d = F.lit(day).cast("date")
    df = read_jsonl(spark, root, schema, file_glob)
    return df.filter((F.col("year") == F.date_format(d, "yyyy"))
                     & (F.col("month") == F.date_format(d, "MM"))
                     & (F.col("day") == F.date_format(d, "dd")))


def read_days(spark: SparkSession, root: str, schema: T.StructType, start, end,
              file_glob: str = JSON_FILES) -> DataFrame:
    """Execution days ``start``..``end`` inclusive: a predicate on the
    partition columns only, so the scan prunes every other directory."""
    day = F.try_to_date(F.concat_ws("-", "year", "month", "day"), "yyyy-MM-dd")
    df = read_jsonl(spark, root, schema, file_glob)
    return df.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def with_file_date(df: DataFrame, keep_invalid: bool = False) -> DataFrame:
    """Adds ``file_path`` and ``partition_date`` parsed from it (S7, X14);
    files under a path without a valid date are dropped (S9)."""
    out = df.select("*", F.col("_metadata.file_path").alias("file_path"))
    out = out.withColumn("partition_date", date_from_path("file_path"))
    return out if keep_invalid else out.filter(F.col("partition_date").isNotNull())


def shipping_ids(spark: SparkSession, root: str, file_glob: str = JSON_FILES) -> DataFrame:
    """``(shipping_id, year, month, day)`` from landed orders, parsing only the
    nested id (S10)."""
    from ..schemas import SHIPPING_ID_ONLY
    df = read_jsonl(spark, root, SHIPPING_ID_ONLY, file_glob)
    return df.select(F.col("shipping.id").alias("shipping_id"), "year", "month", "day")
