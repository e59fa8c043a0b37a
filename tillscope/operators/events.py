"""Splitting the raw log into event tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import channel_of, hour_bucket, parse_price
from tillscope.schemas import EVENT, EVENT_LINE, KINDS, PURCHASE


class EventTables(NamedTuple):
    purchases: DataFrame
    carts: DataFrame
    views: DataFrame


def split_events(raw: DataFrame) -> EventTables:
    """One cleaned table per kind of event, purchases with one row per item.

    The split is not exclusive: a record that carries two kinds of event is in
    two tables. A record without a kind, or with an empty basket, is in none.
    """
    return EventTables(*(events_of_kind(raw, kind) for kind in KINDS))


def events_of_kind(raw: DataFrame, kind: str) -> DataFrame:
    """The cleaned table of one kind of event."""
    member = f"EventType.{kind}"
    rows = raw.filter(F.col(member).isNotNull())
    if kind != "Purchase":
        return _clean(rows, member, EVENT.names)
    items = rows.select(
        "timestamp", "CustomerId", "Source", F.explode(member).alias("item")
    )
    return _clean(items, "item", PURCHASE.names)


def _clean(rows: DataFrame, item: str, names: list[str]) -> DataFrame:
    cleaned = {
        "Timestamp": hour_bucket(F.col("timestamp")),
        "CustomerId": F.col("CustomerId"),
        "ProductId": F.col(f"{item}.ProductId"),
        "Price": parse_price(F.col(f"{item}.Price")),
        "Source": F.col("Source"),
        "Channel": channel_of(F.col("Source")),
    }
    if "Quantity" in names:
        cleaned["Quantity"] = F.col(f"{item}.Quantity")
    return rows.select(*(cleaned[name].alias(name) for name in names))


def event_lines(raw: DataFrame) -> DataFrame:
    """All three event tables in one pass over the log, told apart by ``Kind``.

    Holds what the catalogues need. Same rows as the tables of `split_events`,
    for a job that wants all three without parsing the log three times.
    """
    def single(kind: str) -> Column:
        item = F.col(f"EventType.{kind}")
        return F.when(item.isNotNull(), F.array(item["ProductId"]))

    products_by_kind = {
        "Purchase": F.col("EventType.Purchase")["ProductId"],
        "AddToCart": single("AddToCart"),
        "ProductView": single("ProductView"),
    }
    pairs = [part for kind, ids in products_by_kind.items() for part in (F.lit(kind), ids)]
    lines = raw.select(
        "timestamp",
        "CustomerId",
        "Source",
        F.stack(F.lit(len(KINDS)), *pairs).alias("Kind", "ProductIds"),
    ).select(
        hour_bucket(F.col("timestamp")).alias("Timestamp"),
        "CustomerId",
        F.explode("ProductIds").alias("ProductId"),
        channel_of(F.col("Source")).alias("Channel"),
        "Kind",
    )
    return lines.select(*EVENT_LINE.names)
