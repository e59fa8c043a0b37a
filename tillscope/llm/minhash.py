"""MinHash near-dedup by min-max hashing.

A document is the set of its five-word shingles. Of each of 64 permutations both the
minimum and the maximum over the set are kept, so 128 signature values cost 64 hash
evaluations; minimum and maximum agree between two sets with the probability of
their Jaccard similarity each. The values are banded in 32 bands of 4. Equal sets are one class from the
start, so copies never meet each other. In a band's bucket of several classes every class is
compared with one centre, which gives as many pairs as there are members, and similarity is
confirmed on the full sets. Buckets that are then in several components get a few more centres,
chosen by a hash; in a crowd of near copies, which are similar to many others and not to all, that
joins nearly all of them.

What is then still not in one component is searched exactly, in a join by prefixes: sets in their order of
rarest shingles first can only be similar if they share one of the first quarter; of the smaller
set the first seventh or so is enough. That join takes the sets of buckets that are still in
several components, and all sets of up to `SMALL` shingles, so that no link among those depends
on bands. Only sets of different components are paired, and a shingle's largest component is never
paired with itself.

A pair of larger sets that no centre connects is missed if it shares no band: of similarity 0.75
with probability 5e-6 in large sets. In small ones minimum and maximum depend on each other:
measured, 2e-5 at 8 shingles and 1e-5 at 12, which are searched exactly.

Full sets are only sent for classes that share a bucket. Which those are is known to all tasks
from a bitmap of at most `MOST_SLOTS` bits; what it lets through in vain is sent in vain and
meets no pair.

Defined cases: a text of fewer than five words has its whole sequence as its one shingle;
a text without words and a null have the empty set, which is linked with nothing; rows
that repeat an id are compared one by one, each with its own text; a null id is linked
like others but never names a component, and is its own where there is no other. Of a
component's rows `without_near_duplicates` keeps one with the smallest id, even if rows repeat that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.graph import connected_components
from tillscope.llm.staging import own_shuffle, release, rows_with_names, staged
from tillscope.llm.textblocks import blocks, mix, shingles, spread_starts

PERMUTATIONS = 64
BANDS = 32
ROWS = 2 * PERMUTATIONS // BANDS
SIMILAR = 75  # per cent
MORE_CENTRES = 4
SMALL = 16  # shingles
MOST_SLOTS = 1 << 27
MOST_COUNTERS = 1 << 20
_KEYS = ["n_shingles", "key1", "key2"]

_RANDOM = np.random.Generator(np.random.PCG64(75))
_FACTORS = _RANDOM.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_MIXERS = _RANDOM.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_max_signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row per non-empty set; minima in even columns, maxima in odd ones."""
    starts = spread_starts(counts[counts > 0])[:-1]
    signatures = np.empty((len(starts), 2 * PERMUTATIONS), dtype=np.uint64)
    for k in range(PERMUTATIONS):
        permuted = hashes * _FACTORS[k] + _OFFSETS[k]
        signatures[:, 2 * k] = np.minimum.reduceat(permuted, starts)
        signatures[:, 2 * k + 1] = np.maximum.reduceat(permuted, starts)
    return signatures


def band_keys(signatures: np.ndarray) -> np.ndarray:
    banded = signatures.reshape(len(signatures), BANDS, ROWS)
    keys = (mix(banded) * _MIXERS).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(BANDS, dtype=np.uint64))


def _set_keys(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each non-empty set, whatever its order."""
    starts = spread_starts(counts[counts > 0])[:-1]
    second = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    return np.add.reduceat(mix(hashes), starts), np.add.reduceat(second, starts)


def _keys_of_rows(hashes: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """Number of shingles and 128 bits of each set; those of an empty one are 0."""
    keys = np.zeros((2, len(counts)), dtype=np.uint64)
    if (counts > 0).any():
        keys[:, counts > 0] = _set_keys(hashes, counts)
    return [pa.array(counts.astype(np.int64)), *(pa.array(key.view(np.int64)) for key in keys)]


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    starts = pa.array(spread_starts(counts).astype(np.int32))
    return pa.ListArray.from_arrays(starts, pa.array(values.view(np.int64)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but the text, with the set's keys, its bands and, if it is small, the set."""
    for block in blocks(batches, "text"):
        hashes, counts = shingles(block.data, block.starts)
        some = counts > 0
        bands = np.zeros((0, BANDS), dtype=np.uint64)
        if some.any():
            bands = band_keys(min_max_signatures(hashes, counts))
        few = counts * (counts <= SMALL)
        rows = block.rows.drop_columns("text")
        yield pa.RecordBatch.from_arrays(
            [
                *rows.columns,
                *_keys_of_rows(hashes, counts),
                _lists(some * BANDS, bands.ravel()),
                _lists(few, hashes[np.repeat(counts <= SMALL, counts)]),
            ],
            names=[*rows.schema.names, *_KEYS, "bands", "small"],
        )


def _slot(key: Column, slots: int) -> Column:
    return key.bitwiseAND(slots - 1)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the slots that key1 has, about eight slots for each row, up to `MOST_SLOTS`."""
    slots = 1 << 10
    rows = keys.count()
    while slots < min(8 * rows, MOST_SLOTS):
        slots *= 2
    slot = _slot(F.col("key1"), slots)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    words = (
        keys.groupBy(F.shiftright(slot, 6).alias("at"))
        .agg(F.bit_or(bit).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(slots // 64, dtype=np.int64)
    bitmap[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return bitmap.view(np.uint64)


def _sets_of(bitmap: np.ndarray):
    """The full sets whose key the bitmap may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            hashes, counts = shingles(block.data, block.starts)
            keys = _keys_of_rows(hashes, counts)
            slot = keys[1].to_numpy().view(np.uint64) & np.uint64(64 * len(bitmap) - 1)
            bit = bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)
            wanted = bit.astype(bool) & (counts > 0)
            rows = pa.array(np.flatnonzero(wanted))
            yield pa.RecordBatch.from_arrays(
                [
                    *(key.take(rows) for key in keys),
                    _lists(counts[wanted], hashes[np.repeat(wanted, counts)]),
                ],
                names=[*_KEYS, "shingles"],
            )

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    return (
        pairs.join(sets.select(F.col("number").alias("b"), F.col("shingles").alias("of_b")), "b")
        .join(sets.select(F.col("number").alias("a"), F.col("shingles").alias("of_a")), "a")
        .withColumn("both", F.size(F.array_intersect("of_a", "of_b")))
        .filter(100 * F.col("both") >= SIMILAR * (F.size("of_a") + F.size("of_b") - F.col("both")))
        .select("a", "b")
    )


def _in_components(numbers: DataFrame, components: DataFrame) -> DataFrame:
    """With the component of each number, which is its own where it has no link."""
    named = components.withColumnRenamed("node", "number")
    return numbers.join(named, "number", "left").withColumn(
        "component", F.coalesce("component", "number")
    )


def _least(size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many shingles similar sets of these sizes have in common at least."""
    return -(-SIMILAR * (size + other) // (100 + SIMILAR))


def _postings(rarity: np.ndarray):
    """Rows (token, number, component, n, at, indexed) of each set's rarest shingles.

    ``at`` is the place in the set's order, the same order for all sets; a set has ``indexed``
    rows for larger sets to find, and a few more by which to find smaller ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            sizes = np.diff(lists.offsets.to_numpy())
            tokens = lists.flatten().to_numpy()
            hashed = tokens.view(np.uint64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            rank = rarity[hashed & np.uint64(len(rarity) - 1)]
            order = np.lexsort((hashed, rank, owner))
            at = np.arange(len(tokens)) - np.repeat(spread_starts(sizes)[:-1], sizes)
            smallest = -(-SIMILAR * sizes // 100)
            probed = at < (sizes - smallest + 1)[owner]
            indexed = at < (sizes - _least(sizes, sizes) + 1)[owner]
            rows = pa.array(owner[probed])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens[order][probed]),
                    batch.column("number").take(rows),
                    batch.column("component").take(rows),
                    pa.array(sizes[owner][probed].astype(np.int64)),
                    pa.array(at[probed]),
                    pa.array(indexed[probed]),
                ],
                names=["token", "number", "component", "n", "at", "indexed"],
            )

    return run


def _rarity(sets: DataFrame) -> np.ndarray:
    """Twice the logarithm of how often the shingles of a slot occur; any order would be right."""
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    slots = 1 << 10
    while slots < min(2 * total, MOST_COUNTERS):
        slots *= 2
    counted = (
        sets.select(F.explode("shingles").alias("token"))
        .groupBy(_slot(F.col("token"), slots).alias("slot"))
        .agg(F.round(2 * F.log2(F.count("*"))).cast("int").alias("rank"))
        .toArrow()
    )
    rarity = np.zeros(slots, dtype=np.int16)
    rarity[counted.column("slot").to_numpy()] = counted.column("rank").to_numpy()
    return rarity


def prefix_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different components that may be similar, all that are.

    ``sets`` has number, component and shingles (distinct), and is read three times.
    """
    postings = staged(
        sets.mapInArrow(
            _postings(_rarity(sets)),
            "token bigint, number bigint, component bigint, n bigint, at bigint, indexed boolean",
        ),
        "postings",
        narrow=True,
    )
    largest = (
        postings.groupBy("token", "component")
        .count()
        .groupBy("token")
        .agg(F.max(F.struct("count", "component")).alias("largest"), F.count("*").alias("several"))
        .filter("several > 1")
        .select("token", F.col("largest.component").alias("largest"))
    )
    rows = postings.join(own_shuffle(largest), "token")
    rest = rows.filter("component <> largest").drop("largest")
    other = rows.select("token", *(F.col(c).alias(f"{c}2") for c in postings.columns[1:]))
    first = F.struct("n", "number") < F.struct("n2", "number2")
    found = F.when(first, F.col("indexed")).otherwise(F.col("indexed2"))
    small, large = F.least("n", "n2"), F.greatest("n", "n2")
    behind = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
    return (
        rest.join(other, "token")
        .filter(F.col("component") != F.col("component2"))
        .filter(found & (100 * small >= SIMILAR * large))
        # What the sets can have in common from their first common shingle on.
        .filter((100 + SIMILAR) * behind >= SIMILAR * (F.col("n") + F.col("n2")))
        .select(
            F.least("number", "number2").alias("a"), F.greatest("number", "number2").alias("b")
        )
        .distinct()
    )


def _still_apart(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Of the rows (band, number) those in buckets of several components, with their component."""
    rows = _in_components(rows.select("band", "number"), components)
    several = (
        rows.groupBy("band")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .filter("least < most")
        .select("band")
    )
    return rows.join(own_shuffle(several), "band")


def _more_pairs(apart: DataFrame) -> DataFrame:
    """Each row with a few others of its bucket, unless they are of one component."""
    drawn = [
        F.min(F.struct(F.xxhash64("number", "band", F.lit(k)), "number", "component"))
        for k in range(MORE_CENTRES)
    ]
    centres = apart.groupBy("band").agg(F.array(*drawn).alias("centres"))
    others = F.filter("centres", lambda c: c["component"] != F.col("component"))
    return (
        apart.join(own_shuffle(centres), "band")
        .select("number", F.explode(F.transform(others, lambda c: c["number"])).alias("other"))
        .select(F.least("number", "other").alias("a"), F.greatest("number", "other").alias("b"))
        .distinct()
    )


def _joined(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links (a, b) between their members."""
    named = _in_components(links.withColumnRenamed("a", "number"), components)
    named = named.select(F.col("component").alias("a"), F.col("b").alias("number"))
    named = _in_components(named, components).select("a", F.col("component").alias("b"))
    further = connected_components(named)
    above = further.select(F.col("node").alias("component"), F.col("component").alias("above"))
    known = components.join(above, "component", "left").select(
        "node", F.coalesce("above", "component").alias("component")
    )
    # A class that had no link so far has no row yet.
    return known.unionByName(further.join(components.select("node"), "node", "left_anti"))


def _found_components(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Node and component of every linked class."""
    members = classes.select("number", "key1", F.explode("bands").alias("band"))
    several = (
        members.groupBy("band")
        .agg(F.min("number").alias("centre"), F.max("number").alias("most"))
        .filter("centre < most")
        .select("band", "centre")
    )
    buckets = staged(members.join(own_shuffle(several), "band"), "buckets")
    sets = staged(
        texts.mapInArrow(
            _sets_of(_bitmap(buckets)),
            "n_shingles bigint, key1 bigint, key2 bigint, shingles array<bigint>",
        )
        .dropDuplicates(_KEYS)
        .join(classes.select(*_KEYS, "number"), _KEYS)
        .select("number", "shingles"),
        "sets",
    )
    centres = (
        buckets.filter("number <> centre")
        .select(F.col("centre").alias("a"), F.col("number").alias("b"))
        .distinct()
    )
    components = connected_components(_confirmed(centres, sets))
    apart = staged(_still_apart(buckets, components), "apart", narrow=True)
    components = _joined(components, _confirmed(_more_pairs(apart), sets))
    components = staged(components, "components", narrow=True)
    apart = _still_apart(apart, components).select("number").distinct()
    few = classes.filter(F.size("small") > 0).select("number", F.col("small").alias("shingles"))
    open_sets = (
        sets.filter(F.size("shingles") > SMALL)
        .join(apart, "number", "left_semi")
        .unionByName(few)
    )
    open_sets = staged(_in_components(open_sets, components), "open-sets")
    components = _joined(components, _confirmed(prefix_pairs(open_sets), open_sets))
    release(buckets, sets)
    return components


def near_duplicates(
    documents: DataFrame, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For every row: id, n_shingles, component_id (the smallest id reachable) and kept."""
    rows = documents.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    found = _classified(rows)
    component = F.coalesce("least", "id")
    return found.select("id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )


def _classified(rows: DataFrame) -> DataFrame:
    """The rows (id, text and others) without the text, but with n_shingles, the component of
    the row's set (null for the empty one) and the component's least id.
    """
    others = [f"`{name}` {kind}" for name, kind in rows.dtypes if name != "text"]
    signed = staged(
        rows.mapInArrow(
            _sign,
            f"{', '.join(others)}, n_shingles bigint, key1 bigint, key2 bigint, "
            "bands array<bigint>, small array<bigint>",
        ),
        "signatures",
    )
    # A class goes by a number, as ids can be null or be repeated with other texts. Its
    # bands depend on its set alone.
    classes = staged(
        signed.filter("n_shingles > 0")
        .groupBy(*_KEYS)
        .agg(
            F.min("id").alias("class"),
            F.first("bands").alias("bands"),
            F.first("small").alias("small"),
        )
        .withColumn("number", F.monotonically_increasing_id()),
        "classes",
    )
    components = _found_components(classes, rows.select("text"))
    numbered = _in_components(classes.select(*_KEYS, "number", "class"), components)
    least = numbered.groupBy("component").agg(F.min("class").alias("least"))
    named = numbered.join(own_shuffle(least), "component").select(*_KEYS, "component", "least")
    return signed.drop("bands", "small").join(named, _KEYS, "left")


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each component, with the smallest id there, with all its columns."""
    named, names = rows_with_names(documents)
    at = documents.columns.index
    rows = named.select(
        F.col(f"c{at('doc_id')}").alias("id"), F.col(f"c{at('text')}").alias("text"), *names
    )
    found = staged(_classified(rows).select("component", "id", *names), "near-rows")
    linked = found.filter(F.col("component").isNotNull())
    stays = (
        linked.groupBy("component")
        .agg(F.min(F.struct(F.col("id").isNull(), "id", *names)).alias("row"))
        .select(*(F.col(f"row.{name}") for name in names))
    )
    gone = linked.join(own_shuffle(stays), names, "left_anti").select(*names)
    kept = named.join(gone, names, "left_anti")
    return kept.select(*(F.col(f"c{k}").alias(name) for k, name in enumerate(documents.columns)))
