"""Loaders for the CSV and JSON-lines inputs and for saved catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillscope.functions import pad_zip
from tillscope.schemas import PRODUCT, RAW_CUSTOMER, RAW_EVENT, SAVED_CATALOGUE


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    # enforceSchema=False compares each file's header with the schema, so a file
    # with its columns in another order fails instead of being read wrongly.
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("enforceSchema", False)
        .csv(path)
    )


def _read_by_name(spark: SparkSession, path: str, needed: list[str]) -> DataFrame:
    """The needed columns of a CSV input, in whatever order and among whatever others.

    One header is read for the names; all files of the input have to have the same one.
    """
    names = spark.read.option("header", True).option("sep", ",").csv(path).columns
    missing = sorted(set(needed) - set(names))
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = StructType([StructField(name, StringType()) for name in names])
    return _read_csv(spark, path, schema).select(*needed)


def load_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customers with their names in one style and the zip code padded."""
    raw = _read_by_name(spark, path, RAW_CUSTOMER.names)
    return raw.select(
        "CustomerId",
        F.col("First_Name").alias("FirstName"),
        F.col("Last_Name").alias("LastName"),
        "City",
        "Country",
        "State",
        pad_zip(F.col("Zip")).alias("ZipCode"),
    )


def load_products(spark: SparkSession, path: str) -> DataFrame:
    return _read_by_name(spark, path, PRODUCT.names)


def load_events(spark: SparkSession, path: str) -> DataFrame:
    """The raw event log, one JSON object per line.

    A malformed line becomes a row of nulls, which no event table takes.
    """
    return spark.read.schema(RAW_EVENT).json(path)


def load_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A saved catalogue: all columns string, ``Timestamp`` last.

    ``Timestamp`` is in the schema, so that its values are never taken for dates
    or numbers; a filter on it prunes directories.
    """
    return _read_csv(spark, path, SAVED_CATALOGUE)


def register_catalogue(catalogue: DataFrame, name: str = "PurchaseCatalogue") -> None:
    """Make a catalogue available to ``spark.sql`` under ``name``."""
    catalogue.createOrReplaceTempView(name)
