"""The table of sold lines per area and hour, replaced hour by hour.

Each function takes the counts that `area_hour_counts` makes from a catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.schemas import AREA_HOUR
from tillscope.sinks.by_hour import by_hour, session_settings

_HOUR = "TimestampDateHr"

# The first is for a table of Spark's own formats, the others for a Hive table.
_DYNAMIC_OVERWRITE = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "hive.exec.dynamic.partition": "true",
    "hive.exec.dynamic.partition.mode": "nonstrict",
}


def create_area_hour_table(
    spark: SparkSession, table: str, path: str | None = None
) -> None:
    """Create the table, empty, if it is not there."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in AREA_HOUR)
    place = " LOCATION '{}'".format(path.replace("\\", "\\\\").replace("'", "\\'")) if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({_HOUR}){place}"
    )


def refresh_area_hour_table(counts: DataFrame, table: str) -> None:
    """Replace in ``table`` the hours that the counts cover, and no others."""
    # insertInto heeds only the session's settings, not a write option.
    with session_settings(counts.sparkSession, _DYNAMIC_OVERWRITE):
        _by_hour(_int_counts(counts)).write.insertInto(table, overwrite=True)


def refresh_area_hour_path(counts: DataFrame, path: str) -> None:
    """The same for a table that is only a directory of Parquet files."""
    (
        _by_hour(_int_counts(counts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_HOUR)
        .parquet(path)
    )


def save_area_hour_table(
    counts: DataFrame, table: str, path: str | None = None, mode: str = "error"
) -> None:
    """Create ``table`` from the counts, which stay bigint here."""
    writer = _by_hour(counts).write.mode(mode).partitionBy(_HOUR)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _by_hour(counts: DataFrame) -> DataFrame:
    # Counted already, so an hour has no more rows than there are areas.
    return by_hour(counts, _HOUR)


def _int_counts(counts: DataFrame) -> DataFrame:
    # The insert goes by position, so the order of the columns matters. A count
    # over the int range stops the job, whether or not ANSI mode is on.
    count = F.col("Count")
    checked = F.when(count <= 2**31 - 1, count.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("count does not fit an int: "), count.cast("string")))
    )
    return counts.withColumn("Count", checked).select(*AREA_HOUR.names)

