"""Partition paths and file labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .time import DAY_STAMP


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def partition_parts(ts) -> dict[str, Column]:
    """Zero-padded ``year``/``month``/``day`` strings of an instant (K2).

    Strings, not ints, so the directory names keep their padding."""
    t = _c(ts)
    return {"year": F.date_format(t, "yyyy"),
            "month": F.date_format(t, "MM"),
            "day": F.date_format(t, "dd")}


def date_from_path(path) -> Column:
    """Date encoded as ``year=Y/month=M/day=D`` in a file path, or null when the
    path has no valid one (X14, S9)."""
    p = _c(path)
    y = F.regexp_extract(p, r"/year=(\d{1,4})/", 1)
    m = F.regexp_extract(p, r"/month=(\d{1,2})/", 1)
    d = F.regexp_extract(p, r"/day=(\d{1,2})/", 1)
    ok = (y != "") & (m != "") & (d != "")
    made = F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"),
                                     F.lpad(d, 2, "0")), "yyyy-MM-dd")
    return F.when(ok, made)


def window_label(name: str, date_from, date_to) -> Column:
    """``name_YYYYMMDD`` when both ends share a day, else
    ``name_YYYYMMDD_YYYYMMDD`` (K4) — a lineage column, since Spark owns file
    names."""
    f = F.date_format(_c(date_from), DAY_STAMP)
    t = F.date_format(_c(date_to), DAY_STAMP)
    return F.when(f == t, F.concat_ws("_", F.lit(name), f)) \
        .otherwise(F.concat_ws("_", F.lit(name), f, t))
