"""SimHash near-dedup by meet-in-the-middle ball hashing.

A document's fingerprint has 64 bits; a bit is set if it is set in more than half of the
hashes of its four-word shingles, repeats included. Fingerprints that differ in `RADIUS` bits at
most are linked. Two such have a variant in common that is no more than half the radius
from either, and whatever shares a variant is no more than the radius apart. So every distinct
fingerprint emits all its variants within half the radius (2,081 of them), and the holders of one
variant are linked one to the next, not each to each.

Variants are dealt by their leading bits. A variant that only differs in later bits stays
at its fingerprint's own place, so a fingerprint is sent once to each place where it has
variants (154 of 131,072 at 17 bits), with the number of bits it may still flip there, and the variants are
listed at that place, some at a time. A place that gets too many fingerprints is divided
by further bits. Each place returns a spanning forest of its links.

Defined cases: a text of fewer than four words has its whole sequence, joined by
spaces, as its one shingle; a text without words and a null have fingerprint zero, which is linked
like any other; rows that repeat an id are fingerprinted one by one; a null id is linked like
others but never names a component, unless there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.graph import connected_components, smallest_reachable
from tillscope.llm.staging import release, staged
from tillscope.llm.textblocks import LOWER, blocks, spread_starts, word_lists

SHINGLE_WORDS = 4
SEED = 42
BITS = 64
RADIUS = 4
HALF = RADIUS // 2
PLACE_CLASSES = 1 << 12
PLACE_ROWS = 1 << 20
_MORE_BITS = 8
_LISTED = 1 << 18
_KEPT_LINKS = 1 << 20


def shingle_hashes(text: bytes) -> list[int]:
    """XXH64 of every shingle of a text in lower case, repeats included."""
    hashes: list[int] = []
    last: list[bytes] = []
    for words in word_lists(text):
        words = last + words
        joined = b" ".join(words)
        begins = list(accumulate((len(word) + 1 for word in words), initial=0))
        hashes += [
            xxhash.xxh64_intdigest(joined[a : b - 1], SEED)
            for a, b in zip(begins, begins[SHINGLE_WORDS:], strict=False)
        ]
        last = words[1 - SHINGLE_WORDS :]
    if last and not hashes:
        hashes.append(xxhash.xxh64_intdigest(b" ".join(last), SEED))
    return hashes


def majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits that more than half of them have; none of an empty run."""
    out = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    # Eight counters of a byte each in one integer, so at most 255 hashes are summed at once.
    pieces = -(-counts[some] // 255)
    first = spread_starts(pieces)[:-1]
    begin = spread_starts(counts[some])[:-1]
    piece = np.arange(pieces.sum()) - np.repeat(first, pieces)
    cuts = np.repeat(begin, pieces) + 255 * piece
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        sums = np.add.reduceat(lanes, cuts).astype("<u8").view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(sums.astype(np.int64), first, axis=0)
        for lane in range(8):
            high = 2 * totals[:, lane] > counts[some]
            out[some] |= high.astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        data, bounds = LOWER[block.data].tobytes(), block.starts.tolist()
        found = [shingle_hashes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        counts = np.array([len(one) for one in found], dtype=np.int64)
        hashes = np.fromiter((h for one in found for h in one), np.uint64, counts.sum())
        signed = majorities(hashes, counts).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [block.rows.column("id"), pa.array(signed)], names=["id", "fingerprint"]
        )


@cache
def _flips(bits: int, most: int) -> np.ndarray:
    """All integers of so many bits with at most ``most`` ones, those with fewer first."""
    chosen = [c for n in range(most + 1) for c in combinations(range(bits), n)]
    return np.array([sum(1 << bit for bit in c) for c in chosen], dtype=np.uint64)


def _low(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _shift(values: np.ndarray, bits: int) -> np.ndarray:
    """Values moved left, or right by a negative number of bits; 64 leaves nothing."""
    if abs(bits) >= BITS:
        return np.zeros_like(values)
    return values << np.uint64(bits) if bits >= 0 else values >> np.uint64(-bits)


def _deal(bits: int):
    """Rows (depth, place, fingerprint, left), dealt by that many more bits where ``deeper``.

    A place is the leading ``depth`` bits of variants, of which ``left`` more may be flipped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, place, fingerprint, left = (
                batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)
            )
            deeper = batch.column(4).to_numpy(zero_copy_only=False)
            yield _rows(*(x[~deeper] for x in (depth, place, fingerprint, left)))
            for level in np.unique(depth[deeper]).tolist():
                more = min(bits, BITS - level)
                here = deeper & (depth == level)
                own = _shift(place[here].view(np.uint64), more)
                own |= _shift(fingerprint[here].view(np.uint64), level + more - BITS) & _low(more)
                for flip in _flips(more, HALF):
                    rest = left[here] - int(flip).bit_count()
                    able = rest >= 0
                    moved = (own[able] ^ flip).view(np.int64)
                    depths = np.full(len(moved), level + more, dtype=np.int32)
                    yield _rows(depths, moved, fingerprint[here][able], rest[able])

    return run


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    names = ["depth", "place", "fingerprint", "left"]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32())
    arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


class _Forest:
    """Links, contracted whenever they are many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, one: np.ndarray, other: np.ndarray) -> None:
        self.parts.append((one, other))
        self.size += len(one)
        if self.size > _KEPT_LINKS:
            self.parts = [self.links()]
            self.size = len(self.parts[0][0]) // 2

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        empty = np.zeros(0, dtype=np.int64)
        sides = list(zip((empty, empty), *self.parts, strict=True))
        nodes, roots = smallest_reachable(*(np.concatenate(side) for side in sides))
        return nodes[nodes != roots], roots[nodes != roots]


def collisions(
    fingerprints: np.ndarray, variants: np.ndarray, left: np.ndarray, depth: int, forest: _Forest
) -> None:
    """Link the holders of equal variants, which agree in the leading ``depth`` bits so far.

    ``variants`` are the fingerprints with the flips so far, ``left`` how many more they may have.
    """
    if len(fingerprints) < 2:
        return
    free = BITS - depth
    sizes = [len(_flips(free, n)) for n in range(HALF + 1)]
    listed = sum(sizes[n] * int((left == n).sum()) for n in range(HALF + 1))
    if listed > _LISTED and free:
        bit = np.uint64(free - 1)
        high = ((variants >> bit) & np.uint64(1)).astype(bool)
        for value in (True, False):
            stay, flip = high == value, (high != value) & (left > 0)
            collisions(
                np.concatenate((fingerprints[stay], fingerprints[flip])),
                np.concatenate((variants[stay], variants[flip] ^ (np.uint64(1) << bit))),
                np.concatenate((left[stay], left[flip] - 1)),
                depth + 1,
                forest,
            )
        return
    every, holders = [], []
    for n in range(HALF + 1):
        own = left == n
        every.append((variants[own, None] ^ _flips(free, n)).ravel())
        holders.append(np.repeat(np.flatnonzero(own), sizes[n]))
    variant, holder = np.concatenate(every), np.concatenate(holders)
    order = np.argsort(variant)
    variant = variant[order]
    same = np.flatnonzero(variant[1:] == variant[:-1])
    one, other = holder[order[same]], holder[order[same + 1]]
    forest.add(fingerprints[one], fingerprints[other])


def _links_of_place(rows: pa.Table) -> pa.Table:
    depth = rows.column("depth")[0].as_py()
    place = np.uint64(rows.column("place")[0].as_py() & (1 << BITS) - 1)
    fingerprints = rows.column("fingerprint").to_numpy()
    variants = fingerprints.view(np.uint64) & _low(BITS - depth)
    variants |= _shift(np.array([place]), BITS - depth)
    forest = _Forest()
    collisions(fingerprints, variants, rows.column("left").to_numpy(), depth, forest)
    one, other = forest.links()
    return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(other, pa.int64())})


def _links(classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever fingerprints are near each other."""
    schema = "depth int, place bigint, fingerprint bigint, left int"
    bits = max(6, (classes.count() // PLACE_CLASSES).bit_length())
    start = classes.select(
        F.lit(0).alias("depth"),
        F.lit(0).cast("long").alias("place"),
        "fingerprint",
        F.lit(HALF).alias("left"),
        F.lit(True).alias("deeper"),
    )
    dealt, written = start.mapInArrow(_deal(bits), schema), None
    while True:
        sizes = dealt.groupBy("depth", "place").count()
        large = staged(sizes.filter(f"count > {PLACE_ROWS} and depth < {BITS}"), "large", True)
        if large.isEmpty():
            break
        marked = dealt.join(
            large.select("depth", "place", F.lit(True).alias("deeper")), ["depth", "place"], "left"
        ).select(*dealt.columns, F.coalesce("deeper", F.lit(False)).alias("deeper"))
        deeper = staged(marked.mapInArrow(_deal(_MORE_BITS), schema), "dealt")
        if written is not None:
            release(written)
        dealt = written = deeper
    return dealt.groupBy("depth", "place").applyInArrow(_links_of_place, "a bigint, b bigint")


def near_fingerprints(
    documents: DataFrame, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For every row: id, fingerprint (hexadecimal) and component_id (the smallest id reachable)."""
    rows = documents.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    signed = staged(rows.mapInArrow(_sign, f"id {kind}, fingerprint bigint"), "fingerprints")
    classes = staged(
        signed.groupBy("fingerprint").agg(F.min("id").alias("least")), "classes", narrow=True
    )
    components = connected_components(_links(classes))
    linked = classes.join(
        components.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("component", F.coalesce("component", "fingerprint"))
    linked = staged(linked, "linked", narrow=True)
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    # Written, so that the join below has shuffles of its own and a hot fingerprint is divided.
    named = staged(
        linked.join(names, "component").select("fingerprint", "component_id"), "named", narrow=True
    )
    release(linked, classes)
    return signed.join(named, "fingerprint").select(
        "id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
