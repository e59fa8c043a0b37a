from __future__ import annotations

import pytest
from rows import bag

from tillscope.operators import event_lines, split_events
from tillscope.schemas import CUSTOMER, EVENT, PRODUCT, PURCHASE, RAW_EVENT
from tillscope.sources import load_customers, load_events, load_products


def test_customers(customers):
    assert customers.schema == CUSTOMER
    assert bag(customers) == {
        ("c1", "Ann", "Ash", "Aville", "Acounty", "AA", "008014"): 1,
        ("c2", "Bob", "Birch", "Btown", "Bcounty", "BB", "070116"): 1,
        ("c3", "Cy", "Cedar", "Ccity", "Ccounty", "BB", "12345-6789"): 1,
        ("c4", "Di", None, "Dtown", "Dcounty", None, None): 1,
    }


def test_products(products):
    assert products.schema == PRODUCT
    assert ("p2", "Cable, 2 m", "Electronics", "Cables") in bag(products)


def test_csv_columns_are_found_by_name(spark, tmp_path, products):
    path = tmp_path / "products.csv"
    path.write_text("SubCategory,Extra,Product,ProductId,Category\nCats,x,Cat Bed,p1,Pets\n")
    loaded = load_products(spark, str(path))
    assert loaded.schema == PRODUCT
    assert bag(loaded) == {("p1", "Cat Bed", "Pets", "Cats"): 1}


def test_csv_without_a_needed_column_is_refused(spark, raw_paths):
    with pytest.raises(ValueError, match="no column Category, Product, ProductId, SubCategory"):
        load_products(spark, raw_paths["customers"])
    with pytest.raises(ValueError, match="no column .*Zip"):
        load_customers(spark, raw_paths["products"])


def test_csv_files_of_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ProductId,Product,Category,SubCategory\np1,a,b,c\n")
    (tmp_path / "b.csv").write_text("Product,ProductId,Category,SubCategory\na,p1,b,c\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_products(spark, str(tmp_path)).collect()


def test_purchases(raw_events):
    purchases = split_events(raw_events).purchases
    assert purchases.schema.simpleString() == PURCHASE.simpleString()
    assert bag(purchases) == {
        ("20-06-2019-0", "c1", "p1", 10.5, "desktop", "Desk", 2): 1,
        ("20-06-2019-0", "c1", "p2", 0.0, "desktop", "Desk", 1): 1,
        ("20-06-2019-2", "c9", "p9", 1.0, "m", "Mobile", 3): 1,
    }


def test_carts_and_views(raw_events):
    _, carts, views = split_events(raw_events)
    assert carts.schema.simpleString() == EVENT.simpleString()
    assert bag(carts) == {
        ("20-06-2019-1", "c2", "p1", 0.0, "tablet-app", "Tablet"): 1,
        ("20-06-2019-2", "c9", "p1", 1.0, "m", "Mobile"): 1,
    }
    assert bag(views) == {("20-06-2019-1", "c3", "p1", 7.0, "Desktop", "Mobile"): 1}


def test_log_without_a_kind_gives_empty_tables(spark, tmp_path):
    log = tmp_path / "log.json"
    log.write_text('{"timestamp":"1-1-2019 1:1","EventType":{}}\n{"timestamp":"1-1-2019 1:1"}\n')
    for table in split_events(load_events(spark, str(log))):
        assert table.count() == 0


def test_null_items_and_baskets(spark):
    raw = spark.createDataFrame(
        [
            ("d 1:0", "c1", None, (None, None, None)),
            ("d 1:0", "c2", None, ([], None, None)),
            (None, "c3", None, ([None, ("p", None, None)], None, None)),
            ("d 1:0", "c4", "tablet", None),
        ],
        RAW_EVENT,
    )
    assert bag(split_events(raw).purchases) == {
        (None, "c3", None, 0.0, None, "Mobile", None): 1,
        (None, "c3", "p", 0.0, None, "Mobile", None): 1,
    }


def test_event_lines_hold_the_split_tables(raw_events, spark):
    null_item = spark.createDataFrame(
        [("d 1:0", "c1", "desk", ([None, ("p", "1", 1), ("p", "1", 1)], (None, None), ("v", "")))],
        RAW_EVENT,
    )
    for raw in (raw_events, null_item):
        lines = event_lines(raw)
        for kind, table in zip(
            ("Purchase", "AddToCart", "ProductView"), split_events(raw), strict=True
        ):
            columns = ["Timestamp", "CustomerId", "ProductId", "Channel"]
            of_kind = lines.filter(lines.Kind == kind).select(columns)
            assert bag(of_kind) == bag(table.select(columns))
