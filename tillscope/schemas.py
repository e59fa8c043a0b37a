"""Column names and types of every table the engine reads or writes.

All sources get an explicit schema: no inference pass over the log, and a kind
of event that happens not to occur in a file is an empty table, not an error.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Fixed names: headers of the two CSV inputs.
RAW_CUSTOMER = _strings(
    "CustomerId", "First_Name", "Last_Name", "City", "Country", "State", "Zip"
)
PRODUCT = _strings("ProductId", "Product", "Category", "SubCategory")

# Fixed names: fields of one line of the event log.
_ITEM = _strings("ProductId", "Price")
_BASKET_ITEM = T.StructType([*_ITEM, T.StructField("Quantity", T.LongType())])
RAW_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("CustomerId", T.StringType()),
        T.StructField("Source", T.StringType()),
        T.StructField(
            "EventType",
            T.StructType(
                [
                    T.StructField("Purchase", T.ArrayType(_BASKET_ITEM)),
                    T.StructField("AddToCart", _ITEM),
                    T.StructField("ProductView", _ITEM),
                ]
            ),
        ),
    ]
)

# Fixed names from here on: columns of the tables that are given out.
CUSTOMER = _strings(
    "CustomerId", "FirstName", "LastName", "City", "Country", "State", "ZipCode"
)

# Carts and views; purchases have Quantity as well.
EVENT = T.StructType(
    [
        T.StructField("Timestamp", T.StringType()),
        T.StructField("CustomerId", T.StringType()),
        T.StructField("ProductId", T.StringType()),
        T.StructField("Price", T.FloatType()),
        T.StructField("Source", T.StringType()),
        T.StructField("Channel", T.StringType()),
    ]
)
PURCHASE = T.StructType([*EVENT, T.StructField("Quantity", T.LongType())])

CATALOGUE = _strings(
    "CustomerId",
    "ProductId",
    "Timestamp",
    "City",
    "State",
    "ZipCode",
    "Product",
    "Category",
    "SubCategory",
    "Channel",
)

# A saved catalogue has the hour in its directory names, so it is read last.
SAVED_CATALOGUE = T.StructType(
    [field for field in CATALOGUE if field.name != "Timestamp"] + [CATALOGUE["Timestamp"]]
)

# The part of the event tables that the catalogues need, all kinds together.
EVENT_LINE = _strings("Timestamp", "CustomerId", "ProductId", "Channel", "Kind")

KINDS = ("Purchase", "AddToCart", "ProductView")

AREA_HOUR = T.StructType(
    [
        T.StructField("City", T.StringType()),
        T.StructField("State", T.StringType()),
        T.StructField("Zipcode", T.StringType()),
        T.StructField("Count", T.IntegerType()),
        T.StructField("TimestampDateHr", T.StringType()),
    ]
)
