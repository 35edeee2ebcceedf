"""Bag union of batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_batches(*batches: DataFrame) -> DataFrame:
    """Union by column name; a column missing from a batch is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
