from __future__ import annotations

import pytest
from rows import bag

from tillscope.operators import (
    customers_by_zip,
    customers_per_state,
    product_counts,
    products_per_category,
    sold_by_area_hour,
    top_sold_by_category,
    top_sold_by_channel,
)
from tillscope.schemas import CATALOGUE
from tillscope.sources import register_catalogue


def line(product, channel, category="Electronics", hour="d-1", city="A"):
    return ("c", product, hour, city, "S", "000001", product.upper(), category, "sub", channel)


@pytest.fixture(scope="module")
def catalogue(spark):
    rows = (
        [line("p2", "Mobile")] * 3
        + [line("p1", "Mobile")] * 3
        + [line("p3", "Mobile", "Pets", "d-2")] * 4
        + [line("p4", "Mobile", "Pets", "d-2", "B")] * 2
        + [line("p5", "Desk", "Electronics", "d-2", "B")] * 9
        + [line("p0", "Mobile", "Home")] * 2
    )
    return spark.createDataFrame(rows, CATALOGUE)


def test_top_by_channel_breaks_ties_by_product(catalogue):
    assert [tuple(r) for r in top_sold_by_channel(catalogue, "Mobile", 4).collect()] == [
        ("p3", "P3", "Mobile", 4),
        ("p1", "P1", "Mobile", 3),
        ("p2", "P2", "Mobile", 3),
        ("p0", "P0", "Mobile", 2),
    ]
    assert top_sold_by_channel(catalogue, "Tablet").count() == 0


def test_top_by_category(catalogue):
    assert [tuple(r) for r in top_sold_by_category(catalogue).collect()] == [
        ("p5", "P5", "Electronics", 9),
        ("p1", "P1", "Electronics", 3),
        ("p2", "P2", "Electronics", 3),
    ]


def test_counts_of_products_answer_the_same(catalogue):
    counts = product_counts(catalogue)
    for question, value in ((top_sold_by_channel, "Mobile"), (top_sold_by_category, "Pets")):
        assert question(counts, value).collect() == question(catalogue, value).collect()


def test_by_area_and_hour(catalogue):
    result = sold_by_area_hour(catalogue)
    assert result.columns == ["City", "State", "Zipcode", "Count"]
    # City A has a row for each of its two hours.
    assert [tuple(r) for r in result.collect()] == [
        ("B", "S", "000001", 11),
        ("A", "S", "000001", 8),
        ("A", "S", "000001", 4),
    ]
    assert sum(r.Count for r in result.collect()) == catalogue.count()


def test_questions_in_sql_on_the_view(spark, catalogue):
    register_catalogue(catalogue)
    by_channel = spark.sql(
        """
        SELECT ProductId, Product, Channel, COUNT(*) AS Count
        FROM PurchaseCatalogue WHERE Channel = 'Mobile'
        GROUP BY ProductId, Product, Channel
        """
    )
    assert bag(by_channel) == bag(top_sold_by_channel(catalogue, "Mobile", 100))
    # Names are found in any case and come out as the query spells them.
    by_area = spark.sql(
        """
        SELECT City, State, Zipcode, COUNT(*) AS Count
        FROM purchasecatalogue GROUP BY City, State, Zipcode, timestamp
        """
    )
    assert by_area.columns == ["City", "State", "Zipcode", "Count"]
    assert bag(by_area) == bag(sold_by_area_hour(catalogue))


def test_top_k_does_not_sort_everything(catalogue):
    plan = top_sold_by_channel(catalogue)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert plan.count("HashAggregate") == 2
    assert plan.count("Exchange") == 1


def test_dimension_questions(customers, products):
    assert bag(customers_by_zip(customers, "008014")) == {("c1", "Ann", "008014", "AA"): 1}
    assert customers_by_zip(customers, "8014").count() == 0
    assert bag(customers_per_state(customers)) == {("AA", 1): 1, ("BB", 2): 1, (None, 1): 1}
    assert bag(products_per_category(products)) == {
        ("Pets", 1): 1,
        ("Electronics", 1): 1,
        ("Home", 1): 1,
    }
