"""The driver's tables written in the raw shapes that the loaders read.

The files hold what the rules are about: customers and products that are missing or listed
twice, events without a customer, records of two kinds, long zip codes, categories with
outer spaces, and baskets of many items and of none. Which rows those are follows from their ids.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.operators.catalogue import Dimensions, size_dimensions
from tillscope.scratch import scratch_folder
from tillscope.schemas import PRODUCT, RAW_CUSTOMER, RAW_EVENT
from tillscope.sources import load_customers, load_events, load_products

# Which kind of event each type of the events table stands for.
_KIND_TYPES = {"Purchase": "purchase", "AddToCart": "click", "ProductView": "view"}

_KINDS_TYPE = RAW_EVENT["EventType"].dataType
_TABLES = ("nation", "region", "customer", "part", "events", "lineitem")
_AS_IT_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


class RetailTables(NamedTuple):
    customers: DataFrame
    products: DataFrame
    events: DataFrame
    baskets: DataFrame
    dimensions: Dimensions


_loaded: dict[tuple, RetailTables] = {}


def retail_tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    """Load customers, products and both event logs of a folder of driver tables.

    The raw files are written and sized once per session and state of the driver's tables, so
    that every query goes through the same sources as a real log.
    """
    key = (spark, sf_dir, _state(spark, sf_dir))
    if key not in _loaded:
        folder = scratch_folder(spark, "raw")
        write_raw_files(spark, sf_dir, folder)
        _loaded[key] = load_raw_files(spark, folder)
    return _loaded[key]


def load_raw_files(spark: SparkSession, folder: str) -> RetailTables:
    customers = load_customers(spark, f"{folder}/customers")
    products = load_products(spark, f"{folder}/products")
    return RetailTables(
        customers,
        products,
        load_events(spark, f"{folder}/events"),
        load_events(spark, f"{folder}/baskets"),
        size_dimensions(customers, products),
    )


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Times and sizes of the tables' files."""
    found = []
    for name in _TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.listStatus(path):
            found.append((str(status.getPath()), status.getModificationTime(), status.getLen()))
    return tuple(sorted(found))


def write_raw_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    for name, table in (
        ("customers", _raw_customers(spark, sf_dir)),
        ("products", _raw_products(spark, sf_dir)),
    ):
        table.write.options(header=True, **_AS_IT_IS).csv(f"{folder}/{name}")
    _raw_events(spark, sf_dir).write.json(f"{folder}/events")
    _basket_log(spark, sf_dir).write.json(f"{folder}/baskets")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    customer = _table(spark, sf_dir, "customer")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("CustomerId"),
            F.col("c_name").alias("First_Name"),
            F.col("c_mktsegment").alias("Last_Name"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("Country"),
            F.col("r_name").alias("State"),
            F.when(F.col("c_custkey") % 31 == 0, "12345-6789")
            .otherwise(F.col("c_nationkey").cast("string"))
            .alias("Zip"),
            _listings(F.col("c_custkey"), 13, 17),
            F.col("c_mktsegment").alias("Segment"),
        )
        # In another order than the loader's, and with a column that nobody asks for.
        .select("Segment", *reversed(RAW_CUSTOMER.names))
    )


def _raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "part")
        .select(
            F.col("p_partkey").cast("string").alias("ProductId"),
            F.col("p_name").alias("Product"),
            F.when(F.col("p_partkey") % 10 == 3, F.concat("p_type", F.lit(" ")))
            .when(F.col("p_partkey") % 10 == 4, F.concat(F.lit(" "), "p_type"))
            .otherwise(F.col("p_type"))
            .alias("Category"),
            F.col("p_brand").alias("SubCategory"),
            _listings(F.col("p_partkey"), 19, 23),
        )
        .select(*PRODUCT.names)
    )


def _listings(number: Column, missing: int, twice: int) -> Column:
    """No listing of some numbers, two of others, and one of the rest."""
    times = F.when(number % missing == 5, 0).when(number % twice == 3, 2).otherwise(1)
    return F.explode(F.array_repeat(F.lit(True), times)).alias("listed")


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.from_json("props", "k INT")["k"].cast("string").alias("ProductId")
    item = F.struct(product, price_text().alias("Price"))
    # Most baskets have one item, each fifth up to eight, and some none.
    number = F.col("event_id")
    items = F.when(number % 37 == 0, 0).when(number % 5 == 0, 1 + number % 8).otherwise(1)
    basket = F.transform(
        F.filter(F.array(*map(F.lit, range(8))), lambda n: n < items),
        lambda n: F.struct(
            (F.from_json("props", "k INT")["k"] + 7 * n).cast("string").alias("ProductId"),
            price_text().alias("Price"),
            (n + 1).alias("Quantity"),
        ),
    )

    # Each eleventh record carries a cart too, or a view beside a cart.
    second = F.when(F.col("event_id") % 11 == 0, F.lit("AddToCart"))
    second = F.when(
        F.col("event_type") == "click", F.when(second.isNotNull(), "ProductView")
    ).otherwise(second)

    def member(kind: str, value: Column) -> Column:
        carried = (F.col("event_type") == _KIND_TYPES[kind]) | (second == kind)
        return F.when(carried, value).alias(kind)

    return _table(spark, sf_dir, "events").select(
        _log_time(F.col("ts")).alias("timestamp"),
        F.when(F.col("event_id") % 29 > 0, F.col("user_id").cast("string")).alias("CustomerId"),
        _source_name(F.col("event_id")).alias("Source"),
        F.struct(
            member("Purchase", basket),
            member("AddToCart", item),
            member("ProductView", item),
        ).alias("EventType"),
    )


def _log_time(ts: Column) -> Column:
    # Fields of a timestamp without zone, so the session's zone has no part in it.
    return F.concat(
        F.date_format(ts.cast("date"), "dd-MM-yyyy"),
        F.lit(" "),
        F.hour(ts).cast("string"),
        F.date_format(ts, ":mm:ss"),
    )


def _source_name(event_id: Column) -> Column:
    # The last two try the precedence and the case of the channel rule.
    names = F.array(*map(F.lit, ("desktop-web", "tablet-app", "desk-tablet", "Desktop")))
    return F.get(names, (event_id % 4).cast("int"))


def price_text() -> Column:
    """Price of an event as the log has it; each seventh one cannot be read."""
    return F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(
        F.concat(F.col("value").cast("string"), F.lit("$"))
    )


# Spellings that are numbers and that only look like it.
_ODD_PRICES = ("inf", "-inf", "nan", "NAN", "Infinity", "-Infinity", "NaN", "1e3", "12$$", " 5.5 ")


def odd_price_text() -> Column:
    """`price_text`, but each third event has one of the odd spellings."""
    odd = F.get(
        F.array(*map(F.lit, _ODD_PRICES)), (F.floor(F.col("event_id") / 3) % 10).cast("int")
    )
    return F.when(F.col("event_id") % 3 == 0, odd).otherwise(price_text())


def _basket_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as purchase records, an order's lines of one part of the table in a basket.

    So an order has as many baskets as parts that it stands in, and no basket grows with the data.
    """
    basket = F.spark_partition_id()
    item = F.struct(
        F.col("l_partkey").cast("string").alias("ProductId"),
        F.col("l_extendedprice").cast("string").alias("Price"),
        F.col("l_quantity").cast("long").alias("Quantity"),
    )
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", basket.alias("basket"), item.alias("item")
    )
    kinds = F.struct(
        F.col("items").alias("Purchase"),
        F.lit(None).cast(_KINDS_TYPE["AddToCart"].dataType).alias("AddToCart"),
        F.lit(None).cast(_KINDS_TYPE["ProductView"].dataType).alias("ProductView"),
    )
    return (
        lines.groupBy("l_orderkey", "basket")
        .agg(F.collect_list("item").alias("items"))
        .select(
            F.lit(None).cast("string").alias("timestamp"),
            F.col("l_orderkey").cast("string").alias("CustomerId"),
            F.lit(None).cast("string").alias("Source"),
            kinds.alias("EventType"),
        )
    )
