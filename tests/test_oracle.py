"""Every registered query against DuckDB on the driver's tables."""

from __future__ import annotations

import os
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tillscope.plans import run_retail_job
from tillscope.plans.raw_files import write_raw_files

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_divided_catalogue_is_joined_by_shuffles(spark):
    query = driver.queries()["purchase_catalogue_divided"](spark, SF_DIR)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and "CustomerIdPiece" in plan


def _by_name(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


# The optional subpackage has tests of its own.
NAMES = [name for name in driver.queries() if not re.match(r"op\d+_|pipeline$", name)]


def test_every_query_has_an_oracle():
    assert set(NAMES) == {name for name in driver.oracle_sql() if name in NAMES}


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    got = _by_name(result.columns, map(tuple, result.collect()))
    relation = duck.sql(driver.oracle_sql()[name])
    expected = _by_name(relation.columns, relation.fetchall())
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[1], "an empty result proves nothing"


def test_whole_job_equals_oracle(spark, duck, tmp_path):
    raw = str(tmp_path / "raw")
    write_raw_files(spark, SF_DIR, raw)
    report = run_retail_job(
        spark,
        f"{raw}/customers",
        f"{raw}/products",
        f"{raw}/events",
        str(tmp_path / "out"),
        area_table="whole_job_areas",
        category=driver.CATEGORY,
    )
    # Ids are text in the files, so ties in the lists are cut in the order of text.
    lists = {"Channel": (report.top_by_channel, "Mobile")}
    lists["Category"] = (report.top_by_category, driver.CATEGORY)
    for column, (result, value) in lists.items():
        expected = duck.sql(
            driver._TABLES
            + f"SELECT CAST(ProductId AS VARCHAR) AS id, Product, {column}, COUNT(*) AS n "
            f"FROM sold WHERE {column} = '{value}' GROUP BY ALL ORDER BY n DESC, id LIMIT 5"
        )
        assert list(map(tuple, result.collect())) == expected.fetchall()
    for result, name in (
        (report.purchase_catalogue, "catalogue_roundtrip"),
        (report.by_area_hour, "sold_by_area_hour"),
        (spark.table("whole_job_areas"), None),
    ):
        count = "CAST(COUNT(*) AS INT)"
        areas = driver._TABLES + driver._AREA_HOUR.format(count=count)
        relation = duck.sql(driver.oracle_sql()[name] if name else areas)
        got = _by_name(result.columns, map(tuple, result.collect()))
        assert got == _by_name(relation.columns, relation.fetchall())
    spark.sql("DROP TABLE whole_job_areas")


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 5
    assert [row.Count for row in rows] == sorted((row.Count for row in rows), reverse=True)
