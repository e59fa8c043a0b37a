from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from rows import bag

from tillscope.operators import build_catalogue, event_lines, split_events
from tillscope.operators.catalogue import size_dimensions
from tillscope.operators.spread import divide, hot_values
from tillscope.plans import plan_catalogue
from tillscope.schemas import CATALOGUE
from tillscope.sinks.by_hour import session_settings


def test_catalogue(raw_events, customers, products):
    purchases, carts, views = split_events(raw_events)
    catalogue = build_catalogue(purchases, customers, products)
    assert catalogue.schema.simpleString() == CATALOGUE.simpleString()
    place = ("20-06-2019-0", "Aville", "AA", "008014")
    assert bag(catalogue) == {
        ("c1", "p1", *place, "Cat Bed", "Pets", "Cats", "Desk"): 1,
        ("c1", "p2", *place, "Cable, 2 m", "Electronics", "Cables", "Desk"): 1,
    }
    assert [r.CustomerId for r in build_catalogue(carts, customers, products).collect()] == ["c2"]
    assert [r.CustomerId for r in build_catalogue(views, customers, products).collect()] == ["c3"]


def test_unmatched_null_and_repeated_keys(spark, customers, products):
    events = spark.createDataFrame(
        [("c1", "p1"), ("c1", "p1"), (None, "p1"), ("c1", None), ("cx", "p1"), ("c1", "px")],
        "CustomerId string, ProductId string",
    ).withColumns({"Timestamp": F.lit("d-1"), "Channel": F.lit("Desk")})
    assert build_catalogue(events, customers, products).count() == 2
    assert build_catalogue(events, customers.union(customers), products).count() == 4


def test_ids_need_not_be_text(spark, customers, products):
    events = spark.createDataFrame(
        [(1, 2, "d-1", "Desk")],
        "CustomerId long, ProductId long, Timestamp string, Channel string",
    )
    customers = customers.limit(1).withColumn("CustomerId", F.lit(1).cast("long"))
    products = products.limit(1).withColumn("ProductId", F.lit(2).cast("long"))
    row = build_catalogue(events, customers, products).first()
    assert (row.CustomerId, row.ProductId) == (1, 2)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """2,000 events: a third are copies of one row, others crowd on one product."""
    path = str(tmp_path_factory.mktemp("skewed") / "events")
    n = F.col("id")
    copy = n % 3 == 0
    spark.range(2000).select(
        F.when(copy, "c1").otherwise(F.concat(F.lit("c"), n % 5)).alias("CustomerId"),
        F.when(copy | (n % 2 == 0), "p1")
        .when(n % 7 > 0, F.concat(F.lit("p"), n % 4))
        .alias("ProductId"),
        F.when(copy, "d-1").when(n % 11 > 0, F.concat(F.lit("d-"), n % 24)).alias("Timestamp"),
        F.when(copy, "Desk").otherwise("Mobile").alias("Channel"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_divided_catalogue_has_the_same_rows(skewed, customers, products):
    customers = customers.union(customers.limit(1))
    plain = bag(build_catalogue(skewed, customers, products))
    for rows_per_piece in (1, 7, 100, 10_000):
        divided = build_catalogue(
            skewed,
            customers,
            products,
            divided=("CustomerId", "ProductId"),
            rows_per_piece=rows_per_piece,
        )
        assert bag(divided) == plain


def test_pieces_are_even_and_no_row_is_lost(skewed):
    columns = ("CustomerId", "ProductId", "Timestamp")
    divided, hot = divide(skewed, columns, rows_per_piece=50)
    assert bag(divided.select(*skewed.columns)) == bag(skewed)
    for column in columns:
        pieces = divided.groupBy(column, f"{column}Piece").count()
        # Dealt by a hash, so pieces can differ, but not by much.
        assert pieces.agg(F.max("count")).first()[0] <= 100
        values = skewed.groupBy(column).count()
        assert pieces.count() == values.agg(F.sum(F.ceil(F.col("count") / 50))).first()[0]
    # Rows without an hour are a value like any other.
    assert hot["Timestamp"].filter("Timestamp IS NULL").count() == 1


def test_every_value_over_the_size_is_divided(skewed):
    counts = skewed.groupBy("CustomerId").count()
    for rows_per_piece in (1, 100, 400):
        hot = hot_values(skewed, "CustomerId", rows_per_piece)
        assert hot.count() == counts.filter(F.col("count") > rows_per_piece).count()


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_dividing_again_deals_the_same(skewed):
    first, second = (divide(skewed, ("CustomerId",), rows_per_piece=50).rows for _ in range(2))
    assert bag(first) == bag(second)


def test_dimensions_are_broadcast_only_below_the_limit(skewed, customers, products, spark):
    small = size_dimensions(customers, products)
    large = size_dimensions(customers, products, limit=0)
    assert small.shuffled == ()
    assert large.shuffled == ("CustomerId", "ProductId")

    # Without Spark's own choice, only what was measured and marked is broadcast.
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        broadcast, shuffled = (
            plan_of(build_catalogue(skewed, d.customers, d.products, d.shuffled))
            for d in (small, large)
        )
    assert broadcast.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in broadcast
    assert shuffled.count("SortMergeJoin") == 2
    assert "CustomerIdPiece" in shuffled and "ProductIdPiece" in shuffled
    assert "CartesianProduct" not in shuffled and "NestedLoop" not in shuffled


def test_planning_writes_nothing(spark, raw_events, customers, products):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    dimensions = size_dimensions(customers, products, limit=0)
    plain = bag(build_catalogue(split_events(raw_events).purchases, customers, products))
    assert bag(plan_catalogue(raw_events, "Purchase", dimensions)) == plain
    assert (set(os.listdir(shared)) if os.path.isdir(shared) else set()) == before
    lines = event_lines(raw_events)
    assert bag(plan_catalogue(raw_events, "Purchase", dimensions, lines)) == plain


def test_a_hint_makes_divided_joins_shuffle(skewed, customers, products):
    plan = plan_of(
        build_catalogue(
            skewed, customers, products, ("CustomerId", "ProductId"), rows_per_piece=50, how="merge"
        )
    )
    assert plan.count("SortMergeJoin") == 2
    assert "CustomerIdPiece" in plan and "ProductIdPiece" in plan
