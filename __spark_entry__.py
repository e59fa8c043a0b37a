
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tillscope.functions import parse_price  # noqa: E402
from tillscope.operators import (  # noqa: E402
    area_hour_counts,
    build_catalogue,
    customers_by_zip,
    customers_per_state,
    events_of_kind,
    products_per_category,
    sold_by_area_hour,
    top_sold_by_category,
    top_sold_by_channel,
)
from tillscope.plans.raw_files import odd_price_text, retail_tables  # noqa: E402
from tillscope.plans.retail_job import (  # noqa: E402
    plan_catalogue,
    save_catalogues,
    stage_lines,
)
from tillscope.scratch import scratch_folder  # noqa: E402
from tillscope.sinks import (  # noqa: E402
    create_area_hour_table,
    refresh_area_hour_path,
    refresh_area_hour_table,
    save_area_hour_table,
    save_catalogue,
)
from tillscope.sources import load_catalogue, register_catalogue  # noqa: E402

try:
    from corpus_pipeline import ORACLE_SQL, run  # noqa: E402
    from tillscope.llm.queries import ORACLES, QUERIES  # noqa: E402
except ModuleNotFoundError as missing:
    # The subpackage and its pipeline may be left out of an installation.
    if missing.name not in ("corpus_pipeline", "tillscope.llm", "tillscope.llm.queries"):
        raise
    ORACLE_SQL, ORACLES, QUERIES = None, {}, {}
else:
    QUERIES = {**QUERIES, "pipeline": run}

Query = Callable[[SparkSession, str], DataFrame]

CATEGORY = "PROMO"
ZIP_CODE = "000016"
LATER_DAYS = "16"


def _numeric(table: DataFrame, *columns: str) -> DataFrame:
    """Ids are text in the raw files and numbers in the driver's tables."""
    return table.withColumns({column: F.col(column).cast("bigint") for column in columns})


def _catalogue(spark: SparkSession, sf_dir: str, kind: str = "Purchase") -> DataFrame:
    tables = retail_tables(spark, sf_dir)
    return plan_catalogue(tables.events, kind, tables.dimensions)


def _catalogue_query(kind: str) -> Query:
    return lambda spark, sf_dir: _numeric(
        _catalogue(spark, sf_dir, kind), "CustomerId", "ProductId"
    )


def _events_query(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = events_of_kind(retail_tables(spark, sf_dir).events, kind)
        events = _numeric(events, "CustomerId", "ProductId")
        return events.withColumn("Price", F.col("Price").cast("double"))

    return query


def customers_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric(retail_tables(spark, sf_dir).customers, "CustomerId")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric(retail_tables(spark, sf_dir).products, "ProductId")


def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    price = parse_price(odd_price_text()).cast("double")
    endless = F.lit(float("inf"))
    special = F.when(F.isnan(price), "NaN").when(price == endless, "Infinity").when(
        price == -endless, "-Infinity"
    )
    return events.select(
        "event_id",
        F.when(special.isNull(), price).alias("Price"),
        F.coalesce(special, F.lit("number")).alias("PriceKind"),
    )


def basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = events_of_kind(retail_tables(spark, sf_dir).baskets, "Purchase")
    return _numeric(items, "CustomerId", "ProductId").select(
        F.col("CustomerId").alias("l_orderkey"),
        "ProductId",
        F.col("Price").cast("double").alias("Price"),
        "Quantity",
    )


def purchase_catalogue_divided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase catalogue by shuffle joins, with frequent keys in pieces."""
    tables = retail_tables(spark, sf_dir)
    lines = stage_lines(tables.events, scratch_folder(spark, "lines"))
    catalogue = build_catalogue(
        lines.filter(F.col("Kind") == "Purchase"),
        tables.customers,
        tables.products,
        divided=("CustomerId", "ProductId"),
        rows_per_piece=10,
        how="merge",
    )
    return _numeric(catalogue, "CustomerId", "ProductId")


def catalogue_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "catalogue")
    save_catalogue(_catalogue(spark, sf_dir), path)
    return load_catalogue(spark, path)


def saved_catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = retail_tables(spark, sf_dir)
    paths = save_catalogues(
        tables.events, tables.customers, tables.products, scratch_folder(spark, "catalogues")
    )
    saved = (
        load_catalogue(spark, path).withColumn("Kind", F.lit(kind))
        for kind, path in paths.items()
    )
    return reduce(DataFrame.unionByName, saved)


def saved_catalogue_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question put in SQL to the registered view of a saved catalogue."""
    view = f"PurchaseCatalogue_{uuid.uuid4().hex}"
    register_catalogue(catalogue_roundtrip(spark, sf_dir), view)
    return spark.sql(f"SELECT channel, category, COUNT(*) AS Lines FROM {view} GROUP BY ALL")


def category_by_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories with outer spaces, counted with and without saving the catalogue."""
    routes = {"memory": _catalogue(spark, sf_dir), "saved": catalogue_roundtrip(spark, sf_dir)}
    counts = (
        catalogue.groupBy("Category").agg(F.count("*").alias("Lines")).withColumn(
            "Route", F.lit(route)
        )
        for route, catalogue in routes.items()
    )
    return reduce(DataFrame.unionByName, counts)


def _filled_then_refreshed(
    spark: SparkSession, sf_dir: str, refresh: Callable[[DataFrame], None]
) -> None:
    """All hours with counts that are 1,000 too high, then the first days' hours again."""
    counts = area_hour_counts(_catalogue(spark, sf_dir))
    refresh(counts.withColumn("Count", F.col("Count") + 1000))
    refresh(counts.filter(F.col("TimestampDateHr") < LATER_DAYS))


def area_hour_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "area-hour")
    _filled_then_refreshed(spark, sf_dir, lambda counts: refresh_area_hour_path(counts, path))
    return spark.read.parquet(path)


def area_hour_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"area_hour_{uuid.uuid4().hex}"
    create_area_hour_table(spark, table, scratch_folder(spark, "area-hour"))
    _filled_then_refreshed(spark, sf_dir, lambda counts: refresh_area_hour_table(counts, table))
    return spark.table(table)


def area_hour_saved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"area_hour_saved_{uuid.uuid4().hex}"
    counts = area_hour_counts(_catalogue(spark, sf_dir))
    save_area_hour_table(counts, table, path=scratch_folder(spark, "area-hour"))
    return spark.table(table)


def top_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_sold_by_channel(_numeric(_catalogue(spark, sf_dir), "ProductId"), "Mobile")


def top_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_sold_by_category(_numeric(_catalogue(spark, sf_dir), "ProductId"), CATEGORY)


def by_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = retail_tables(spark, sf_dir).customers
    return _numeric(customers_by_zip(customers, ZIP_CODE), "CustomerId")


def _with_package(query: Query) -> Query:
    """Python workers have to find this package where it isn't installed."""

    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers = spark.sparkContext.environment
        paths = workers.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            workers["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
        return query(spark, sf_dir)

    return run_query


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the products sold most through the mobile channel."""
    return top_by_channel(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        "customers_clean": customers_clean,
        "products": products,
        "purchase_events": _events_query("Purchase"),
        "cart_events": _events_query("AddToCart"),
        "view_events": _events_query("ProductView"),
        "price_parse": price_parse,
        "basket_items": basket_items,
        "purchase_catalogue": _catalogue_query("Purchase"),
        "cart_catalogue": _catalogue_query("AddToCart"),
        "view_catalogue": _catalogue_query("ProductView"),
        "purchase_catalogue_divided": purchase_catalogue_divided,
        "catalogue_roundtrip": catalogue_roundtrip,
        "saved_catalogues": saved_catalogues,
        "saved_catalogue_sql": saved_catalogue_sql,
        "category_by_route": category_by_route,
        "top_sold_by_channel": top_by_channel,
        "top_sold_by_category": top_by_category,
        "sold_by_area_hour": lambda spark, sf_dir: sold_by_area_hour(_catalogue(spark, sf_dir)),
        "area_hour_path": area_hour_path,
        "area_hour_table": area_hour_table,
        "area_hour_saved_table": area_hour_saved_table,
        "customers_by_zip": by_zip,
        "customers_per_state": lambda spark, sf_dir: customers_per_state(
            retail_tables(spark, sf_dir).customers
        ),
        "products_per_category": lambda spark, sf_dir: products_per_category(
            retail_tables(spark, sf_dir).products
        ),
        **{name: _with_package(query) for name, query in QUERIES.items()},
    }


# Cleaned dimensions, events and catalogues straight from the driver's tables.
_TABLES = """
WITH cust AS (
  SELECT c_custkey AS CustomerId, c_name AS FirstName, c_mktsegment AS LastName,
         n_name AS City, r_name AS Country, r_name AS State,
         CASE WHEN c_custkey % 31 = 0 THEN '12345-6789'
              WHEN length(CAST(c_nationkey AS VARCHAR)) < 6
              THEN lpad(CAST(c_nationkey AS VARCHAR), 6, '0')
              ELSE CAST(c_nationkey AS VARCHAR) END AS ZipCode
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
                JOIN (VALUES (1), (2)) AS t(listing)
                  ON c_custkey % 13 <> 5 AND (listing = 1 OR c_custkey % 17 = 3)),
prod AS (
  SELECT p_partkey AS ProductId, p_name AS Product,
         CASE p_partkey % 10 WHEN 3 THEN concat(p_type, ' ') WHEN 4 THEN concat(' ', p_type)
                             ELSE p_type END AS Category,
         p_brand AS SubCategory
  FROM part JOIN (VALUES (1), (2)) AS t(listing)
              ON p_partkey % 19 <> 5 AND (listing = 1 OR p_partkey % 23 = 3)),
src AS (
  SELECT event_id, ts, CASE WHEN event_id % 29 > 0 THEN user_id END AS CustomerId,
         event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS ProductId,
         CASE event_id % 4 WHEN 0 THEN 'desktop-web' WHEN 1 THEN 'tablet-app'
                           WHEN 2 THEN 'desk-tablet' ELSE 'Desktop' END AS Source,
         CASE WHEN event_id % 7 = 0 THEN 'n/a'
              ELSE concat(CAST(value AS VARCHAR), '$') END AS p
  FROM events),
kinds AS (
  SELECT src.* REPLACE (ProductId + 7 * n AS ProductId),
         CAST(n + 1 AS BIGINT) AS Quantity, 'Purchase' AS Kind
  FROM src JOIN range(8) AS item(n)
    ON n < CASE WHEN event_id % 37 = 0 THEN 0 WHEN event_id % 5 = 0 THEN 1 + event_id % 8
                ELSE 1 END
  WHERE event_type = 'purchase'
  UNION ALL
  SELECT *, NULL AS Quantity,
         CASE event_type WHEN 'click' THEN 'AddToCart' ELSE 'ProductView' END AS Kind
  FROM src WHERE event_type IN ('click', 'view')
  UNION ALL
  SELECT *, NULL AS Quantity,
         CASE event_type WHEN 'click' THEN 'ProductView' ELSE 'AddToCart' END AS Kind
  FROM src WHERE event_id % 11 = 0),
ev AS (
  SELECT event_id, CustomerId, ProductId,
         strftime(ts, '%d-%m-%Y') || '-' || hour(ts) AS Timestamp, Kind, Source,
         CASE WHEN contains(Source, 'desk') THEN 'Desk'
              WHEN contains(Source, 'tablet') THEN 'Tablet'
              ELSE 'Mobile' END AS Channel,
         CAST(CASE WHEN p = 'n/a' THEN 0 ELSE CAST(rtrim(p, '$') AS FLOAT) END AS DOUBLE) AS Price,
         Quantity
  FROM kinds),
cat AS (
  SELECT ev.Kind, ev.CustomerId, ev.ProductId, ev.Timestamp, City, State, ZipCode,
         Product, Category, SubCategory, Channel
  FROM ev JOIN cust ON ev.CustomerId = cust.CustomerId
          JOIN prod ON ev.ProductId = prod.ProductId
  WHERE Kind IS NOT NULL),
sold AS (SELECT * EXCLUDE (Kind) FROM cat WHERE Kind = 'Purchase')
"""

# What each spelling is by the rule: only these two words in this case are numbers.
_ODD_PRICES = """
, odd(k, Price, PriceKind) AS (VALUES
  (0, 0.0, 'number'), (1, 0.0, 'number'), (2, 0.0, 'number'), (3, 0.0, 'number'),
  (4, NULL, 'Infinity'), (5, NULL, '-Infinity'), (6, NULL, 'NaN'), (7, 1000.0, 'number'),
  (8, 0.0, 'number'), (9, 5.5, 'number'))
SELECT event_id,
       CASE WHEN event_id % 3 = 0 THEN CAST(odd.Price AS DOUBLE)
            WHEN p = 'n/a' THEN 0
            ELSE CAST(CAST(rtrim(p, '$') AS FLOAT) AS DOUBLE) END AS Price,
       CASE WHEN event_id % 3 = 0 THEN PriceKind ELSE 'number' END AS PriceKind
FROM src JOIN odd ON k = (event_id // 3) % 10"""

_SAVED_COLUMNS = (
    "CAST(CustomerId AS VARCHAR) AS CustomerId, CAST(ProductId AS VARCHAR) AS ProductId, "
    "City, State, ZipCode, Product, Category, SubCategory, Channel, Timestamp"
)
_AREA_HOUR = (
    "SELECT City, State, ZipCode AS Zipcode, {count} AS Count, Timestamp AS TimestampDateHr "
    "FROM sold GROUP BY City, State, ZipCode, Timestamp"
)
_REFRESHED = _AREA_HOUR.format(
    count=f"CAST(COUNT(*) + CASE WHEN Timestamp < '{LATER_DAYS}' THEN 0 ELSE 1000 END AS INT)"
)


def _events_sql(kind: str, extra: str = "") -> str:
    return (
        f"SELECT Timestamp, CustomerId, ProductId, Price, Source, Channel{extra} "
        f"FROM ev WHERE Kind = '{kind}'"
    )


def oracle_sql() -> dict[str, str]:
    tails = {
        "customers_clean": "SELECT * FROM cust",
        "products": "SELECT * FROM prod",
        "purchase_events": _events_sql("Purchase", ", Quantity"),
        "cart_events": _events_sql("AddToCart"),
        "view_events": _events_sql("ProductView"),
        "price_parse": _ODD_PRICES,
        "basket_items": (
            "SELECT l_orderkey, l_partkey AS ProductId, "
            "CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS Price, "
            "CAST(l_quantity AS BIGINT) AS Quantity FROM lineitem"
        ),
        "purchase_catalogue": "SELECT * FROM sold",
        "cart_catalogue": "SELECT * EXCLUDE (Kind) FROM cat WHERE Kind = 'AddToCart'",
        "view_catalogue": "SELECT * EXCLUDE (Kind) FROM cat WHERE Kind = 'ProductView'",
        "purchase_catalogue_divided": "SELECT * FROM sold",
        "catalogue_roundtrip": f"SELECT {_SAVED_COLUMNS} FROM sold",
        "saved_catalogues": f"SELECT {_SAVED_COLUMNS}, Kind FROM cat",
        "saved_catalogue_sql": (
            "SELECT Channel AS channel, Category AS category, COUNT(*) AS Lines "
            "FROM sold GROUP BY Channel, Category"
        ),
        "category_by_route": (
            "SELECT Category, COUNT(*) AS Lines, Route FROM sold "
            "CROSS JOIN (VALUES ('memory'), ('saved')) AS t(Route) GROUP BY Category, Route"
        ),
        "top_sold_by_channel": (
            "SELECT ProductId, Product, Channel, COUNT(*) AS Count FROM sold "
            "WHERE Channel = 'Mobile' GROUP BY ProductId, Product, Channel "
            "ORDER BY Count DESC, ProductId LIMIT 5"
        ),
        "top_sold_by_category": (
            "SELECT ProductId, Product, Category, COUNT(*) AS Count FROM sold "
            f"WHERE Category = '{CATEGORY}' GROUP BY ProductId, Product, Category "
            "ORDER BY Count DESC, ProductId LIMIT 5"
        ),
        "sold_by_area_hour": (
            "SELECT City, State, ZipCode AS Zipcode, COUNT(*) AS Count FROM sold "
            "GROUP BY City, State, ZipCode, Timestamp"
        ),
        "area_hour_path": _REFRESHED,
        "area_hour_table": _REFRESHED,
        "area_hour_saved_table": _AREA_HOUR.format(count="COUNT(*)"),
        "customers_by_zip": (
            f"SELECT CustomerId, FirstName, ZipCode, State FROM cust WHERE ZipCode = '{ZIP_CODE}'"
        ),
        "customers_per_state": "SELECT State, COUNT(*) AS count FROM cust GROUP BY State",
        "products_per_category": (
            "SELECT Category, COUNT(*) AS count FROM prod GROUP BY Category"
        ),
    }
    of_pipeline = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
    return {name: f"{_TABLES} {tail}" for name, tail in tails.items()} | ORACLES | of_pipeline
