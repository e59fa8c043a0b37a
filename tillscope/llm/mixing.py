"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

A source's target is its share of the mix by weight, but at most ``most_repeats`` times its
own size; what that cuts off goes to the other sources by weight. A target is met by
complete epochs of the source and then by a fraction of it: documents come in the order
of exponential keys ``-ln(u) / quality`` (the smallest first, so documents of high quality
come early), and are taken as long as the prefix sum of their sizes is near enough.

No source is ever sorted as a whole. The logarithm of a key has a density of at most 1/e
whatever the qualities are, so a bucket of width 1/1024 on that scale is expected to hold
less than 0.04 % of a source. Sizes are summed by bucket, the bucket in which
the budget ends is found from these sums, and only that bucket is put in order. What
remains per source is one limit, so choosing documents is a filter.

Defined cases: a null text has size 0; a null source is a source, the last one; a source
of size 0 has target 0; an empty table gives an empty mix. Rows of one id, or without any, are
drawn each by its own text; rows that are equal in id and text are taken together or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillscope.llm.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
BUCKETS_PER_UNIT = 1024
ORDINARY_WORD = 6.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column, size: Column) -> Column:
    """1 for words of ordinary length on average, less the further from it; in (0, 1]."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    away = F.abs(F.coalesce(mean, F.lit(0.0)) - F.lit(ORDINARY_WORD)) / F.lit(ORDINARY_WORD)
    return F.lit(1.0) / (F.lit(1.0) + away)


def exponential_key(row_id: Column, text: Column, quality: Column) -> Column:
    """-ln(u) / quality, with u in (0, 1) from id and text, so that reruns agree.

    From both, for ids can be null or be repeated, and such rows would be drawn all alike.
    """
    named = [F.coalesce(c.cast("string"), F.lit("")) for c in (row_id, text)]
    digest = F.md5(F.concat(named[0], F.lit(":"), named[1]).cast("binary"))
    drawn = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    u = (drawn + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / quality


def _targets(
    sized: DataFrame, weights: tuple[float, ...], share: float, most_repeats: float
) -> DataFrame:
    """One row per source, with its target; windows run over the sources only."""
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    # Filled from the one that is full first: below this water level none is above its cap.
    filling = W.orderBy("full_at", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    earlier_caps = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    earlier_weights = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most_repeats)))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumns(
            {
                "budget": F.sum("source_size").over(everything) * F.lit(share),
                "all_weights": F.sum("weight").over(everything),
                "place": F.row_number().over(filling),
                "earlier_caps": earlier_caps,
                "earlier_weights": earlier_weights,
            }
        )
        .withColumn(
            "level",
            (F.col("budget") - F.col("earlier_caps"))
            / (F.col("all_weights") - F.col("earlier_weights")),
        )
        .withColumn(
            "level",
            F.min(
                F.when(F.col("level") <= F.col("full_at"), F.struct("place", "level"))
            ).over(everything)["level"],
        )
        .withColumn(
            "target",
            F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")),
        )
        .withColumn(
            "epochs",
            F.when(
                F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
            ).otherwise(0),
        )
        .withColumn("left_over", F.col("target") - F.col("epochs") * F.col("source_size"))
        .select("source", "source_size", "target", "epochs", "left_over")
    )


def sized_documents(
    documents: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: Column | None = None,
) -> DataFrame:
    """Id, source, size in words, exponential key and the key's bucket of every row."""
    sized = documents.select(
        F.col(row_id).alias("id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.col(text).alias("text"),
        (quality if quality is not None else F.lit(None).cast("double")).alias("given"),
    )
    weight = F.coalesce(F.col("given"), text_quality(F.col("text"), F.col("size")))
    key = exponential_key(F.col("id"), F.col("text"), weight)
    keyed = sized.select("id", "source", "size", key.alias("key"))
    return keyed.withColumn("bucket", F.floor(F.log("key") * BUCKETS_PER_UNIT))


def mixing_plan(
    sized: DataFrame,
    weights: tuple[float, ...] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most_repeats: float = MOST_REPEATS,
) -> DataFrame:
    """One row per source: target, complete epochs, and the last document taken once more.

    ``sized`` should be a written table; it is read three times.
    """
    targets = staged(_targets(sized, weights, share, most_repeats), "mix-targets")
    up_to = W.partitionBy("source").orderBy("bucket")
    ends = (
        sized.groupBy("source", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
        .withColumn("with_it", F.sum("bucket_size").over(up_to))
        .withColumn("without_it", F.col("with_it") - F.col("bucket_size"))
        .alias("b")
        .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .filter("without_it < left_over AND left_over <= with_it")
        .select("b.source", "bucket", (F.col("left_over") - F.col("without_it")).alias("room"))
    )
    ends = staged(ends, "mix-ends")
    order = F.struct("key", "id", "size")
    so_far = W.partitionBy("source").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    last = (
        sized.alias("d")
        .join(
            ends.alias("e"),
            F.col("d.source").eqNullSafe(F.col("e.source"))
            & (F.col("d.bucket") == F.col("e.bucket")),
        )
        .select("d.source", "key", "id", "size", "room")
        .withColumn("taken_before", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
        # Taken if that brings the sum nearer to the target; these rows are a prefix.
        .filter(F.col("taken_before") + F.col("size") / 2 <= F.col("room"))
        .groupBy("source")
        .agg(F.max(order).alias("last"))
    )
    plan = (
        targets.alias("t")
        .join(ends.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left")
        .select("t.*", F.col("e.bucket").alias("end_bucket"))
        .alias("p")
        .join(last.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")), "left")
        .select("p.source", "source_size", "target", "epochs", "end_bucket", "last")
    )
    return staged(plan, "mix-plan")


def times_taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """How often the mix takes each row: ``times``, beside all columns of both tables."""
    fraction = (F.col("bucket") < F.col("end_bucket")) | (
        (F.col("bucket") == F.col("end_bucket"))
        & (F.struct("key", "id", "size") <= F.col("last"))
    )
    times = F.col("epochs") + F.coalesce(fraction, F.lit(False)).cast("long")
    return (
        sized.alias("d")
        .join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select("d.*", "source_size", "target", times.cast("long").alias("times"))
    )


def mix_sources(documents: DataFrame, **settings) -> DataFrame:
    """Id, source, size, key, source_size, target, times and words taken for every row."""
    sized = staged(sized_documents(documents, **settings), "mix-sizes")
    taken = times_taken(sized, mixing_plan(sized))
    return taken.withColumn("taken", F.col("size") * F.col("times"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it, with their own columns."""
    whole = documents.select(F.struct(*documents.columns).alias("row"), "doc_id", "text", "source")
    sized = staged(sized_documents(documents), "mix-sizes")
    plan = mixing_plan(sized)
    size = word_count(F.col("text"))
    again = (
        whole.withColumn("size", size)
        .withColumn(
            "key",
            exponential_key(
                F.col("doc_id"), F.col("text"), text_quality(F.col("text"), F.col("size"))
            ),
        )
        .select(
            "row",
            F.col("doc_id").alias("id"),
            "source",
            "size",
            "key",
            F.floor(F.log("key") * BUCKETS_PER_UNIT).alias("bucket"),
        )
    )
    taken = times_taken(again, plan).filter(F.col("times") > 0)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return taken.select("row", copies.alias("copy")).select("row.*")
