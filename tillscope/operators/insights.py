"""Questions asked of a catalogue or of one dimension.

Each aggregation counts map-side first, so a shuffle carries at most one row per
group and task, however large a single group is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def product_counts(catalogue: DataFrame) -> DataFrame:
    """Sold basket lines per product, category and channel.

    Enough to answer both `top_sold_by_channel` and `top_sold_by_category` after
    one pass over the catalogue.
    """
    return catalogue.groupBy("ProductId", "Product", "Category", "Channel").agg(
        F.count("*").alias("Count")
    )


def top_sold_by_channel(sold: DataFrame, channel: str = "Mobile", n: int = 5) -> DataFrame:
    """The n products with the most sold basket lines in a channel.

    ``sold`` is a catalogue or its `product_counts`.
    """
    return _top_sold(sold, "Channel", channel, n)


def top_sold_by_category(sold: DataFrame, category: str = "Electronics", n: int = 5) -> DataFrame:
    """The n products with the most sold basket lines in a category.

    ``sold`` is a catalogue or its `product_counts`.
    """
    return _top_sold(sold, "Category", category, n)


def _top_sold(sold: DataFrame, column: str, value: str, n: int) -> DataFrame:
    lines = F.sum("Count") if "Count" in sold.columns else F.count("*")
    # Ties on the count are broken by ProductId, so the cut is always the same.
    return (
        sold.filter(F.col(column) == value)
        .groupBy("ProductId", "Product", column)
        .agg(lines.alias("Count"))
        .orderBy(F.desc("Count"), "ProductId", "Product")
        .limit(n)
    )


def area_hour_counts(catalogue: DataFrame) -> DataFrame:
    """Sold basket lines per area and hour."""
    return (
        catalogue.groupBy(
            "City",
            "State",
            F.col("ZipCode").alias("Zipcode"),
            F.col("Timestamp").alias("TimestampDateHr"),
        )
        .agg(F.count("*").alias("Count"))
        .select("City", "State", "Zipcode", "Count", "TimestampDateHr")
    )


_PRODUCT = ("ProductId", "Product", "Category", "Channel")
_AREA = ("City", "State", "ZipCode", "Timestamp")


def product_and_area_counts(catalogue: DataFrame) -> DataFrame:
    """`product_counts` and `area_hour_counts` in one pass; `split_counts` parts them."""
    return catalogue.groupingSets([_PRODUCT, _AREA], *_PRODUCT, *_AREA).agg(
        F.count("*").alias("Count"), F.grouping("City").alias("OfProduct")
    )


def split_counts(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of products, and of areas and hours."""
    areas = counts.filter("OfProduct = 0").select(
        "City",
        "State",
        F.col("ZipCode").alias("Zipcode"),
        "Count",
        F.col("Timestamp").alias("TimestampDateHr"),
    )
    return counts.filter("OfProduct = 1").select(*_PRODUCT, "Count"), areas


def sold_by_area_hour(catalogue: DataFrame) -> DataFrame:
    """Sold basket lines, one row per area and hour, largest first."""
    return rank_areas(area_hour_counts(catalogue))


def rank_areas(counts: DataFrame) -> DataFrame:
    """The counts of `area_hour_counts`, largest first, without their hour.

    The hour groups and breaks ties but is not shown. Sorting by more than the
    count also lets the range shuffle split the many groups of equal count.
    """
    return counts.orderBy(
        F.desc("Count"), "City", "State", "Zipcode", "TimestampDateHr"
    ).drop("TimestampDateHr")


def customers_by_zip(customers: DataFrame, zip_code: str) -> DataFrame:
    """Customers of one zip code; codes are compared as text, so zeros count."""
    return customers.select("CustomerId", "FirstName", "ZipCode", "State").filter(
        F.col("ZipCode") == zip_code
    )


def customers_per_state(customers: DataFrame) -> DataFrame:
    return customers.groupBy("State").count()


def products_per_category(products: DataFrame) -> DataFrame:
    return products.groupBy("Category").count()
