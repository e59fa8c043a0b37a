from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillscope.functions import channel_of, hour_bucket, pad_zip, parse_price


def apply(spark, rule, values):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = table.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in rows]


def check(spark, rule, cases):
    assert dict(zip(cases, apply(spark, rule, list(cases)), strict=True)) == cases


def test_pad_zip(spark):
    check(
        spark,
        pad_zip,
        {
            "8014": "008014",
            "70116": "070116",
            "123456": "123456",
            "1234567": "1234567",
            "12345-6789": "12345-6789",
            "": "000000",
            None: None,
        },
    )


def test_hour_bucket(spark):
    check(
        spark,
        hour_bucket,
        {
            "20-06-2019 0:05:10": "20-06-2019-0",
            "20-06-2019 09:05": "20-06-2019-09",
            "20-06-2019 23": "20-06-2019-23",
            "20-06-2019  9:1": "20-06-2019-",
            "20:06:2019 7:1": "20-06-2019-7",
            "20-06-2019": None,
            "20-06-2019 ": None,
            "": None,
            None: None,
        },
    )


def test_channel_of(spark):
    check(
        spark,
        channel_of,
        {
            "desktop": "Desk",
            "desk-tablet": "Desk",
            "my-tablet": "Tablet",
            "Desktop": "Mobile",
            "phone": "Mobile",
            "": "Mobile",
            None: "Mobile",
        },
    )


def test_parse_price(spark):
    check(
        spark,
        parse_price,
        {
            "10.5$": 10.5,
            "7 $": 7.0,
            "1e3": 1000.0,
            "1.5f": 1.5,
            "-2$": -2.0,
            "$": 0.0,
            "$7": 0.0,
            "12$$": 0.0,
            "1,000$": 0.0,
            "abc": 0.0,
            "": 0.0,
            None: 0.0,
        },
    )


def test_parse_price_special_values(spark):
    prices = ["NaN", " NaN$", "Infinity", "-Infinity$", "+Infinity"]
    nan, signed, up, down, plus = apply(spark, parse_price, prices)
    assert math.isnan(nan) and math.isnan(signed)
    assert up == plus == math.inf and down == -math.inf
    others = ["nan", "NAN", "inf", "-inf", "inf$", "+INF", "infinity", "INFINITY$"]
    assert apply(spark, parse_price, others) == [0.0] * len(others)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_rules_do_not_depend_on_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert apply(spark, parse_price, ["x", "1$"]) == [0.0, 1.0]
        assert apply(spark, hour_bucket, ["x", "d 1:2"]) == [None, "d-1"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


texts = st.lists(st.text(alphabet="0123456789 :$-.deskablt", max_size=12), min_size=1, max_size=30)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(texts)
def test_rules_on_any_text(spark, values):
    for value, zip_code in zip(values, apply(spark, pad_zip, values), strict=True):
        assert zip_code == (value if len(value) >= 6 else value.rjust(6, "0"))
    for value, bucket in zip(values, apply(spark, hour_bucket, values), strict=True):
        parts = value.rstrip(" ").split(" ")
        if len(parts) < 2:
            assert bucket is None
        else:
            assert bucket == f"{parts[0]}:{parts[1].split(':')[0]}".replace(":", "-")
    for value, channel in zip(values, apply(spark, channel_of, values), strict=True):
        assert channel == (
            "Desk" if "desk" in value else "Tablet" if "tablet" in value else "Mobile"
        )
