"""The four cleaning rules, as column expressions that stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZIP_LENGTH = 6


def pad_zip(zip_code: Column) -> Column:
    """Left-pad with zeros to six characters; longer codes stay whole.

    ``lpad`` alone would cut a longer code, hence the guard.
    """
    short = F.length(zip_code) < ZIP_LENGTH
    return F.when(short, F.lpad(zip_code, ZIP_LENGTH, "0")).otherwise(zip_code)


def hour_bucket(timestamp: Column) -> Column:
    """``20-06-2019 0:05:10`` becomes ``20-06-2019-0``.

    Works on the text alone: the hour keeps its padding or lack of it, nothing
    is parsed as a date. A text without date and time gives null.
    """
    text = F.rtrim(timestamp)
    date = F.substring_index(text, " ", 1)
    hour = F.substring_index(F.split_part(text, F.lit(" "), F.lit(2)), ":", 1)
    bucket = F.translate(F.concat(date, F.lit("-"), hour), ":", "-")
    return F.when(text.contains(" "), bucket)


def channel_of(source: Column) -> Column:
    """Sales channel by a case-sensitive search in the source's name."""
    return (
        F.when(source.contains("desk"), "Desk")
        .when(source.contains("tablet"), "Tablet")
        .otherwise("Mobile")
    )


def parse_price(price: Column) -> Column:
    """Float price without one trailing ``$``; 0.0 where it cannot be read.

    ``NaN`` and ``Infinity``, with a sign or without, are numbers in this spelling only.
    """
    has_sign = F.endswith(price, F.lit("$"))
    bare = F.when(has_sign, F.left(price, F.length(price) - 1)).otherwise(price)
    number = bare.try_cast("float")
    # The cast takes these words in any case, and a short form too. Digits can be endless as well.
    endless = F.isnan(number) | (F.abs(number) == F.lit(float("inf")).cast("float"))
    word = F.trim(bare)
    other_spelling = word.rlike("^[+-]?[a-zA-Z]") & ~word.rlike("^[+-]?(NaN|Infinity)$")
    unreadable = F.lit(0.0).cast("float")
    return F.when(endless & other_spelling, unreadable).otherwise(F.coalesce(number, unreadable))
