from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tillscope-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A record of two kinds, an empty basket and, on purpose, a malformed last line.
EVENT_LOG = "".join(
    f"{line}\n"
    for line in (
        '{"timestamp":"20-06-2019 0:05:10","CustomerId":"c1","Source":"desktop",'
        '"EventType":{"Purchase":[{"ProductId":"p1","Price":"10.5$","Quantity":2},'
        '{"ProductId":"p2","Price":"abc","Quantity":1}]}}',
        '{"timestamp":"20-06-2019 1:05:10","CustomerId":"c2","Source":"tablet-app",'
        '"EventType":{"AddToCart":{"ProductId":"p1","Price":"$7"}}}',
        '{"timestamp":"20-06-2019 1:05:10","CustomerId":"c3","Source":"Desktop",'
        '"EventType":{"ProductView":{"ProductId":"p1","Price":"7 $"}}}',
        '{"timestamp":"20-06-2019 2:05:10","CustomerId":"c3","Source":"m",'
        '"EventType":{"Purchase":[]}}',
        '{"timestamp":"20-06-2019 2:05:10","CustomerId":"c9","Source":"m",'
        '"EventType":{"Purchase":[{"ProductId":"p9","Price":"1","Quantity":3}],'
        '"AddToCart":{"ProductId":"p1","Price":"1"}}}',
        "{bad json",
    )
)

CUSTOMERS = """\
CustomerId,First_Name,Last_Name,City,Country,State,Zip
c1,Ann,Ash,Aville,Acounty,AA,8014
c2,Bob,Birch,Btown,Bcounty,BB,70116
c3,Cy,Cedar,Ccity,Ccounty,BB,12345-6789
c4,Di,,Dtown,Dcounty,,
"""

PRODUCTS = """\
ProductId,Product,Category,SubCategory
p1,Cat Bed,Pets,Cats
p2,"Cable, 2 m",Electronics,Cables
p3,Lamp,Home,Light
"""


@pytest.fixture(scope="session")
def raw_paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    paths = {}
    for name, text in (
        ("events.json", EVENT_LOG),
        ("customers.csv", CUSTOMERS),
        ("products.csv", PRODUCTS),
    ):
        file = folder / name
        file.write_text(text)
        paths[file.stem] = str(file)
    return paths


@pytest.fixture(scope="session")
def customers(spark, raw_paths):
    from tillscope.sources import load_customers

    return load_customers(spark, raw_paths["customers"])


@pytest.fixture(scope="session")
def products(spark, raw_paths):
    from tillscope.sources import load_products

    return load_products(spark, raw_paths["products"])


@pytest.fixture(scope="session")
def raw_events(spark, raw_paths):
    from tillscope.sources import load_events

    return load_events(spark, raw_paths["events"])
