"""Events joined to their customers and products."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.operators.spread import ROWS_PER_PIECE, divide, join_divided
from tillscope.schemas import CATALOGUE

EVENT_COLUMNS = ["CustomerId", "ProductId", "Timestamp", "Channel"]
DIMENSION_COLUMNS = {
    "CustomerId": ["CustomerId", "City", "State", "ZipCode"],
    "ProductId": ["ProductId", "Product", "Category", "SubCategory"],
}

BROADCAST_BYTES = 256 * 1024 * 1024

# What a row costs in a broadcast table besides its text, generously.
_ROW_BYTES = 96


class Dimensions(NamedTuple):
    """Both dimensions, and the keys that have to be joined by a shuffle."""

    customers: DataFrame
    products: DataFrame
    shuffled: tuple[str, ...]


def size_dimensions(
    customers: DataFrame, products: DataFrame, limit: int = BROADCAST_BYTES
) -> Dimensions:
    """Measure the dimensions and mark those that fit for a broadcast join.

    One small aggregation per dimension, over the columns a catalogue needs. A
    dimension that is over the limit is joined by a shuffle, for which
    `build_catalogue` should divide the hot keys.
    """
    shuffled = []
    sized = []
    for key, table in (("CustomerId", customers), ("ProductId", products)):
        table = table.select(*DIMENSION_COLUMNS[key])
        if _held_bytes(table) <= limit:
            table = F.broadcast(table)
        else:
            shuffled.append(key)
        sized.append(table)
    return Dimensions(*sized, tuple(shuffled))


def _held_bytes(table: DataFrame) -> int:
    text = F.octet_length(F.concat_ws("", *table.columns)) + _ROW_BYTES
    return table.agg(F.sum(text).alias("bytes")).first()["bytes"] or 0


def build_catalogue(
    events: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    divided: Iterable[str] = (),
    rows_per_piece: int = ROWS_PER_PIECE,
    how: str | None = None,
) -> DataFrame:
    """Each event with the place of its customer and the kind of its product.

    Inner joins: an event with a null or unknown key has no row, and a key that a
    dimension lists twice gives two.

    ``divided`` names keys whose hot values are dealt out over several tasks; it
    needs events that come straight from files (see `spread`). Those joins come
    first, for they shuffle the events, and each join makes the events wider. ``how`` is
    their join hint. Without ``divided`` a shuffle join has adaptive execution alone
    against skew; `plan_catalogue` measures and divides.
    """
    lines, hot = divide(events.select(*EVENT_COLUMNS), divided, rows_per_piece)
    tables = {"CustomerId": customers, "ProductId": products}
    for key in sorted(tables, key=lambda key: key not in hot):
        lines = join_dimension(lines, tables[key], key, hot.get(key), how)
    return lines.select(*CATALOGUE.names)


def join_dimension(
    lines: DataFrame,
    dimension: DataFrame,
    key: str,
    hot: DataFrame | None = None,
    how: str | None = None,
) -> DataFrame:
    dimension = dimension.select(*DIMENSION_COLUMNS[key])
    if hot is None:
        return lines.join(dimension, key)
    return join_divided(lines, dimension, key, hot, how)
