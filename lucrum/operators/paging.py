"""Ordered pages (O1, O3): ``ORDER BY k LIMIT size OFFSET page * size``.

``page`` is planned as a top-k (``TakeOrderedAndProject`` with offset): each task
keeps only its first ``offset + size`` rows, so no global sort of the input. What
a task keeps grows with the page number, so it is for the first pages. To read on
from a page use ``page_after``, which keeps ``size`` rows however far it has come.
To open any page by its number, or many pages of one order, build a page index
once: the rows in sorted ranges, and how many rows come before each range. A page
then reads the one or two ranges it lies in.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from .ranking import RANGE, write_ranges


def sort_by(df: DataFrame, order: Sequence[str], descending: bool = False) -> DataFrame:
    cols = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    return df.orderBy(*cols)


def page(df: DataFrame, order: Sequence[str], page_number: int, page_size: int = 50) -> DataFrame:
    """Rows ``page_number * page_size`` .. ``+ page_size`` in ``order``
    (ascending; include a unique column in ``order`` for stable pages)."""
    return sort_by(df, order).offset(page_number * page_size).limit(page_size)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence, page_size: int = 50) -> DataFrame:
    """The ``page_size`` rows that follow the one whose ``order`` columns hold
    ``last`` (the last row of the page before; nulls first, as in ``page``)."""
    if len(last) != len(order):
        raise ValueError("last needs a value for each order column")
    follows, same = F.lit(False), F.lit(True)
    for name, value in zip(order, last):
        later = F.col(name).isNotNull() if value is None else F.col(name) > F.lit(value)
        follows = follows | (same & F.coalesce(later, F.lit(False)))
        same = same & F.col(name).eqNullSafe(F.lit(value))
    return sort_by(df.where(follows), order).limit(page_size)


class PageIndex(NamedTuple):
    """Rows in sorted ranges, and how many come before each: a number a range."""
    ranges: DataFrame
    order: list[str]
    starts: list[int]       # of every range, and the total

    @property
    def rows(self) -> int:
        return self.starts[-1]


def build_page_index(df: DataFrame, order: Sequence[str], path: str, ranges: int | None = None) -> PageIndex:
    """Writes ``df`` sorted under ``path``. With ``ranges`` such that a range holds
    some pages, what a task of :func:`indexed_page` holds doesn't depend on the page
    number or the table."""
    return open_page_index(write_ranges(df, order, path, ranges), order)


def open_page_index(ranges: DataFrame, order: Sequence[str]) -> PageIndex:
    """The index over ranges written before."""
    counts = {r[0]: r[1] for r in ranges.groupBy(RANGE).count().collect()}     # a row a range
    starts = [0]
    for i in range(max(counts, default=-1) + 1):
        starts.append(starts[-1] + counts.get(i, 0))
    return PageIndex(ranges, list(order), starts)


def indexed_page(index: PageIndex, page_number: int, page_size: int = 50) -> DataFrame:
    """The page of that number, read from the ranges it lies in; empty beyond the
    last. Rows that tie in the order keep one place in all pages."""
    first, end = page_number * page_size, (page_number + 1) * page_size
    hit = [i for i, (a, b) in enumerate(zip(index.starts, index.starts[1:])) if a < end and b > first and b > a]
    rows = index.ranges.where(F.col(RANGE).isin(hit) if hit else F.lit(False))
    skip = first - index.starts[hit[0]] if hit else 0
    return (rows.orderBy(RANGE, *[F.col(c).asc_nulls_first() for c in index.order], "_tie")
            .offset(skip).limit(page_size).drop(RANGE, "_tie"))
