"""Written intermediate tables, so that a lost executor never repeats a long lineage."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from tillscope.scratch import remove_folders, scratch_folder

TASKS_PER_CORE = 4
ROW_BYTES = 64
# Once a table is written, the shuffle files it was made from serve nobody.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_settings = threading.Lock()
_writing: list[None] = []
_before: list[str] = []
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def staged(table: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """The table, written to the shared scratch folder and read again.

    A file costs more than the few rows a shuffle partition of a ``narrow`` table has, so such a
    table is written by a few tasks per core, each of which reads several partitions.
    """
    spark = table.sparkSession
    path = scratch_folder(spark, label)
    if narrow:
        table = table.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    with _clean_up(spark):
        table.write.parquet(path)
    if (made := _made.get()) is not None:
        made.append(path)
    # The schema is known, so nothing has to be inferred from files that an empty table lacks.
    written = spark.read.schema(table.schema).parquet(path)
    _folders[written] = path
    return written


@contextmanager
def _clean_up(spark: SparkSession) -> Iterator[None]:
    """The setting holds while any thread writes, and is put back by the last of them."""
    with _settings:
        if not _writing:
            _before[:] = [spark.conf.get(_CLEAN_UP, "false")]
            spark.conf.set(_CLEAN_UP, "true")
        _writing.append(None)
    try:
        yield
    finally:
        with _settings:
            _writing.pop()
            if not _writing:
                spark.conf.set(_CLEAN_UP, _before[0])


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables that are staged within it are removed at its end, but for those in the list."""
    made: list[str] = []
    kept: list[DataFrame] = []
    token = _made.set(made)
    try:
        yield kept
    finally:
        _made.reset(token)
        left = {_folders[table] for table in kept}
        remove_folders(spark, *(path for path in made if path not in left))


def release(*tables: DataFrame) -> None:
    """Remove the folders of staged tables that nothing will read any more."""
    for table in tables:
        remove_folders(table.sparkSession, _folders.pop(table))


def own_shuffle(aggregate: DataFrame) -> DataFrame:
    """An aggregate for a join on the keys that it was grouped by.

    Otherwise the join runs in the aggregate's own stage, where adaptive execution can't
    divide the rows of a hot key of the other side.
    """
    return aggregate.hint("rebalance")


def in_blocks(rows: DataFrame, blocks: int, hot_bytes: int) -> DataFrame:
    """The rows (id, text) with the number of one of so many blocks, by id and text.

    Equal rows would all be in one block. Where those of one id and text have more than
    ``hot_bytes``, they are dealt one by one. There are fewer such keys than ``hot_bytes`` goes
    into the table, which bounds their broadcast.
    """
    keyed = rows.withColumn("key", F.xxhash64("id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES
    hot = (
        keyed.groupBy("key")
        .agg(F.sum(size).alias("bytes"))
        .filter(F.col("bytes") > hot_bytes)
        .select("key", F.lit(True).alias("hot"))
    )
    one = F.when(F.col("hot"), F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long"))
    dealt = keyed.join(F.broadcast(hot), "key", "left")
    return dealt.select(*rows.columns, F.pmod(F.xxhash64("key", one), F.lit(blocks)).alias("block"))


def by_number(table: DataFrame, column: str, tasks: int) -> GroupedData:
    """Groups of a number's rows, in as many tasks, each with as many numbers as any other.

    Dealt by the number itself: by its hash some tasks would have several numbers and some none.
    """
    dealt = table.withColumn("task", F.pmod(column, F.lit(tasks)).cast("int"))
    return dealt.repartitionById(tasks, F.col("task")).groupBy("task", column)


def rows_with_names(documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """The documents with columns c0, c1, ... and two more, which tell each row from all others.

    Ids can be null or be repeated, and so can whole rows. Of a table as it was read from files a
    row's name is its file and its place there. Any other is written first: after a join, say,
    a row of a file can be there twice.
    """
    names = ["of_file", "at_row"]
    columns = [f"c{k}" for k in range(len(documents.columns))]
    if documents._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        documents = staged(documents.toDF(*columns), "rows")
    return documents.select(
        *(F.col(f"`{name}`").alias(c) for name, c in zip(documents.columns, columns, strict=True)),
        F.col("_metadata.file_path").alias(names[0]),
        F.col("_metadata.row_index").alias(names[1]),
    ), names


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
