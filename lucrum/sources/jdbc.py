"""Relational source.

The reference scans whole tables over one connection. Here the read is split
on a numeric column into ``num_partitions`` ranges so executors read in
parallel; :func:`balanced_predicates` gives ranges of equal size for a skewed column. No JDBC driver jar ships with
this repo, so tests check the options and inject DataFrames instead.
"""

from __future__ import annotations

import decimal
from pyspark.sql import DataFrame, SparkSession, functions as F


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int = 8, fetch_size: int = 10_000,
                 driver: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower),
                     "upperBound": str(upper), "numPartitions": str(num_partitions)})
    return opts


def _literal(v) -> str:
    return str(v) if isinstance(v, (int, float, decimal.Decimal)) else f"'{v}'"


def _ranges(column: str, cuts: list, alone: frozenset = frozenset()) -> list[str]:
    """Predicates of the ranges between ascending cuts, each from its lower one on,
    or from behind it where that value has a predicate ``alone``."""
    if not cuts:
        return [f"{column} IS NOT NULL"]
    low = [f"{column} {'>' if c in alone else '>='} {_literal(c)}" for c in cuts]
    high = [f"{column} < {_literal(c)}" for c in cuts]
    return [high[0], *(f"{a} AND {b}" for a, b in zip(low, high[1:])), low[-1]]


def _cuts(df: DataFrame, column: str, parts: int) -> list:
    """Values that cut the rows into ``parts`` equal ones, wrong by a hundredth of a
    part at most; one that holds several parts is there several times."""
    if parts < 2:
        return []
    got = df.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
    return list(got or [])


def balanced_predicates(df: DataFrame, column: str, parts: int, then: str | None = None) -> list[str]:
    """Predicates for a parallel read (``spark.read.jdbc(predicates=...)``) of which
    every row, null keys too, meets exactly one, and that hold about as many rows
    each, however skewed ``column`` is; equal steps between two bounds would not.

    ``df`` gives the keys: the table itself, a sample of it, or a key column read
    from it. Split points are equi-depth quantiles, so the driver gets ``parts``
    values. A key that holds half a part or more gets predicates of its own, split by ``then`` (a second column, ideally unique); so do the null keys. Columns
    are numbers, dates or timestamps."""
    n, n_null = df.agg(F.count(F.lit(1)), F.sum(F.col(column).isNull().cast("long"))).first()
    if not n:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]

    def split(own: str, share: int) -> list[str]:
        cuts = sorted(set(_cuts(df.where(own), then, share))) if then and share > 1 else []
        if not cuts:
            return [own]
        first, *rest = _ranges(then, cuts)
        return [f"{own} AND ({first} OR {then} IS NULL)", *(f"{own} AND {r}" for r in rest)]

    cuts = sorted(set(_cuts(df.where(F.col(column).isNotNull()), column, parts)))
    own = {r[0]: r[1] for r in df.where(F.col(column).isin(cuts)).groupBy(column).count().collect()} if cuts else {}    # ``parts`` keys at most
    heavy = {v: round(k * parts / n) or 1 for v, k in own.items() if 2 * k * parts >= n}
    out = _ranges(column, cuts, frozenset(heavy))
    for v, share in sorted(heavy.items()):
        out += split(f"{column} = {_literal(v)}", share)
    return out + split(f"{column} IS NULL", round(parts * (n_null or 0) / n))


def read_table(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
