"""Keeping joins and writes balanced when one value holds much of the data.

A value with more rows than one task should take is divided into pieces, and its
rows are dealt out over them. Shuffling by (value, piece) then sends the value to
as many tasks as it has pieces. No row is left out or seen twice: a join
repeats the dimension's rows of that value once per piece.

Rows are dealt by a hash of their position in the scan, not of their content, so
that even equal rows are divided. The position must be the same if a lost task is run
again, so `divide` belongs directly on tables read from files.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_PIECE = 2_000_000


class Divided(NamedTuple):
    rows: DataFrame
    hot: dict[str, DataFrame]


def piece_column(column: str) -> str:
    return f"{column}Piece"


def hot_values(rows: DataFrame, column: str, rows_per_piece: int) -> DataFrame:
    """Values of a column with more than ``rows_per_piece`` rows, and their pieces.

    There are fewer of them than ``rows_per_piece`` goes into the number of rows, which
    bounds their broadcast.
    """
    return (
        rows.groupBy(column)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > rows_per_piece)
        .select(column, F.ceil(F.col("n") / rows_per_piece).alias("Pieces"))
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Give each row of a table that comes straight from files its position."""
    if "RowPosition" in rows.columns:
        return rows
    return rows.withColumn("RowPosition", F.monotonically_increasing_id())


def dealt(pieces: Column) -> Column:
    """The piece of a row with a ``RowPosition``, 0 where ``pieces`` is null."""
    piece = F.pmod(F.xxhash64("RowPosition"), pieces)
    return F.coalesce(piece, F.lit(0).cast("long"))


def divide(
    rows: DataFrame, columns: Iterable[str], rows_per_piece: int = ROWS_PER_PIECE
) -> Divided:
    """Add a piece number for each of the columns; 0 for values that are not hot.

    Rows that are `numbered` already are dealt by that position.
    """
    hot = {column: hot_values(rows, column, rows_per_piece) for column in columns}
    if not hot:
        return Divided(rows, hot)
    kept = [column for column in rows.columns if column != "RowPosition"]
    divided = numbered(rows)
    for column, values in hot.items():
        values = values.withColumnRenamed(column, "HotValue")
        kept = [*kept, piece_column(column)]
        # A null is a value too: rows without an hour can be many.
        divided = divided.join(
            F.broadcast(values), F.col(column).eqNullSafe(F.col("HotValue")), "left"
        ).select("RowPosition", *kept[:-1], dealt(F.col("Pieces")).alias(kept[-1]))
    return Divided(divided.select(*kept), hot)


def join_divided(
    rows: DataFrame, dimension: DataFrame, key: str, hot: DataFrame, how: str | None = None
) -> DataFrame:
    """Inner join on a divided key; the same rows as joining on the key alone.

    ``how`` is a join hint, such as ``merge`` for a dimension known to be large.
    """
    piece = piece_column(key)
    pieces = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("Pieces"), F.lit(1)) - 1)
    copies = dimension.join(F.broadcast(hot), key, "left").select(
        *dimension.columns, F.explode(pieces).alias(piece)
    )
    if how:
        copies = copies.hint(how)
    return rows.join(copies, [key, piece]).drop(piece)
