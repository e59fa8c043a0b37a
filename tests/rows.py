from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def bag(table: DataFrame) -> Counter:
    """Rows with their multiplicity, whatever their order."""
    return Counter(map(tuple, table.collect()))
