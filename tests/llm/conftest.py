from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

ROOT = str(Path(__file__).resolve().parents[2])
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.collect()}


LONG = " ".join(f"word{k % 977} and{k}" for k in range(20_000))

# Nulls, empty and very long texts, ties, repeated rows; texts that differ in case only.
ODD_ROWS = [
    (1, "The same text of some words, more than five.", "a"),
    (1, "The same text of some words, more than five.", "a"),
    (2, "THE SAME TEXT OF SOME WORDS, MORE THAN FIVE.", "a"),
    (3, None, None),
    (4, "", "b"),
    (5, " \t\n", "b"),
    (6, "Ünï çÖdé", "c"),
    (7, "ünï ÇÖDÉ", "c"),
    (8, LONG, "c"),
    (9, LONG + " end", None),
    (None, "a row without an id", "a"),
    (10, "three little words", "empty"),
    (11, "three little words", "empty"),
    (12, "x" * 50_000, "d"),
    (13, "\n\n\n", "d"),
]
_CLASHING = (
    "id string, size int, text_size int, key int, bucket int, component int, digest int, "
    "row int, block int, part int, band int, label int"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with columns whose names the operators use themselves."""
    names = [column.split()[0] for column in _CLASHING.split(", ")]
    rows = [(*row, "en", 0, *("x" if name == "id" else 0 for name in names)) for row in ODD_ROWS]
    schema = f"doc_id bigint, text string, source string, lang string, n_chars bigint, {_CLASHING}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
