"""Latest row per key.

``row_number`` over the key, newest version first, keep rank 1. Catalyst turns
the ``rank == 1`` filter into a partial ``WindowGroupLimit`` before the shuffle
and a final one after it, so every map task forwards at most one row per key:
a key holding a third of all rows costs no more shuffle than any other key.

The reference orders by the version only, which leaves ties to chance; here
every remaining column (in table order, ascending, nulls last) breaks ties, so
the result is deterministic and reproducible by any SQL engine. A null version
ranks last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def tiebreak_columns(df: DataFrame, keys: Sequence[str], version: str) -> list[str]:
    """Default tiebreak: all other orderable columns, in table order."""
    skip = set(keys) | {version}
    return [f.name for f in df.schema.fields
            if f.name not in skip and _orderable(f.dataType)]


def rank_latest(df: DataFrame, keys: Sequence[str], version: str,
                tiebreak: Sequence[str] | None = None, rank_col: str = "_rn") -> DataFrame:
    """Adds ``rank_col``: 1 for the newest row of each key."""
    if tiebreak is None:
        tiebreak = tiebreak_columns(df, keys, version)
    order = [F.col(version).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w))


def keep_first(df: DataFrame, rank_col: str = "_rn") -> DataFrame:
    """Keep rank 1 and drop the helper column (F1)."""
    return df.filter(F.col(rank_col) == 1).drop(rank_col)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str,
                   tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``version``."""
    return keep_first(rank_latest(df, keys, version, tiebreak))
