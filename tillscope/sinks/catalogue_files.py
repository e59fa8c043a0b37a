"""Saving a catalogue as CSV, one directory per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.operators.spread import ROWS_PER_PIECE, numbered
from tillscope.scratch import remove_folders, scratch_folder
from tillscope.schemas import CATALOGUE
from tillscope.sinks.by_hour import hour_counts, in_hour_tasks, with_hour_task


def save_catalogue(
    catalogue: DataFrame, path: str, rows_per_piece: int = ROWS_PER_PIECE
) -> None:
    """Replace the catalogue at ``path``, whatever hours it had.

    Its rows are written once as they come and read back by position. So it is computed
    once, its hours are counted in one column of that table, and an hour with
    much of the data is written by several tasks even where its rows are all equal.
    """
    spark = catalogue.sparkSession
    rows = catalogue.select(*CATALOGUE.names)
    folder = scratch_folder(spark, "catalogue-rows")
    rows.write.parquet(folder)
    written = numbered(spark.read.schema(rows.schema).parquet(folder))
    counts = hour_counts(written, "Timestamp")
    placed, tasks = with_hour_task(written, "Timestamp", counts, rows_per_piece)
    write_catalogue(in_hour_tasks(placed, tasks), path)
    remove_folders(spark, folder)


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """The same for rows that already lie together by hour: no shuffle.

    Texts keep their outer spaces. A line break can't be read back from CSV that is
    read in parts, so a value that has one stops the write.
    """
    (
        _on_one_line(catalogue.select(*CATALOGUE.names))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("header", True)
        .option("sep", ",")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("Timestamp")
        .csv(path)
    )


def _on_one_line(catalogue: DataFrame) -> DataFrame:
    text = F.concat_ws("", *(name for name in catalogue.columns if name != "Timestamp"))
    broken = text.contains("\n") | text.contains("\r")
    first = catalogue.columns[0]
    checked = F.when(
        broken, F.raise_error(F.lit("a catalogue value has a line break")).cast("string")
    ).otherwise(F.col(first))
    return catalogue.withColumn(first, checked)
