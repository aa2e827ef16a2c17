"""Set operations on keys."""

from __future__ import annotations

from pyspark.sql import DataFrame


def set_difference(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Distinct left keys without a match on the right."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), on, "left_anti")
