"""How rows are brought together before a write with one directory per hour.

Without a shuffle by hour each task would write a file for each hour it meets.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillscope.operators.spread import ROWS_PER_PIECE, dealt

_changing = threading.RLock()


def hour_counts(table: DataFrame, hour: str) -> DataFrame:
    """Rows of each hour, for `in_measured_tasks`; a small table, worth writing."""
    return table.groupBy(F.col(hour).alias("Hour")).agg(F.count("*").alias("HourRows"))


def with_hour_task(
    table: DataFrame, hour: str, counts: DataFrame, rows_per_piece: int = ROWS_PER_PIECE
) -> tuple[DataFrame, int]:
    """Add the number of the task that writes a row, and say how many tasks there are.

    The hours are laid end to end in their order, and an hour of more than
    ``rows_per_piece`` rows is divided into pieces. Each piece goes to the task that
    its first row's place falls into, by number and not by hash, so no two large
    pieces meet. The number of tasks is the number of rows over ``rows_per_piece``, or
    that of a shuffle by default if that is more; it is the caller's to bound. ``table``
    must be `numbered` and ``counts`` be its `hour_counts`.
    """
    default = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counts.agg(F.sum("HourRows")).first()[0] or 1
    size = min(rows_per_piece, ceil(rows / default))
    before = F.sum("HourRows").over(W.orderBy("Hour")) - F.col("HourRows")
    places = counts.select(
        "Hour",
        before.alias("Before"),
        F.ceil(F.col("HourRows") / rows_per_piece).alias("Pieces"),
    )
    first = F.col("Before") + dealt(F.col("Pieces")) * rows_per_piece
    task = F.floor(first / size).cast("int")
    placed = table.join(places, F.col(hour).eqNullSafe(F.col("Hour")))
    return placed.select(*table.columns, task.alias("HourTask")), ceil(rows / size)


def in_hour_tasks(table: DataFrame, tasks: int) -> DataFrame:
    return table.repartitionById(tasks, F.col("HourTask")).drop("HourTask")


def by_hour(table: DataFrame, hour: str) -> DataFrame:
    """Shuffle hours that are known to be small enough for a task each.

    A fixed number of tasks that adaptive execution leaves alone: merging tasks that
    hold little data would save no file and leave few to create them all.
    """
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(tasks, hour)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session settings for the duration of one write.

    One at a time, so that two threads never restore each other's values. Another query
    that the session plans meanwhile sees them too.
    """
    with _changing:
        before = {key: spark.conf.get(key, None) for key in settings}
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)
