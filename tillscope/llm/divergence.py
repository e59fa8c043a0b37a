"""Source divergence audit: what each source of a language says more than the language does.

A block of texts in one Arrow buffer gets a pointer at the start of every term. The pointers
are sorted by a multikey quicksort of eight bytes a step: pointers that agree so far and
have bytes left go on to the next step. Runs of equal terms then give document
frequencies and counts of every source at once, for the pointers are in the order of sources and
documents before they are sorted, and the sort is stable. Spark sums the blocks' rows up, map-side first.

Each language keeps the terms of at least `LEAST_DOCUMENTS` of its documents. Shares are integers
in billionths, p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)), and a divergence is
floor((p - q)^2 / (p + q)).

For the comparison of sources with each other only the terms that one of the two has are looked at: all
others of the V terms add the same amount. Terms are dealt over pieces of bounded size, and a
piece returns one sum for each two sources, whatever its number of terms. The result has a row for
each two sources of a language, so a language has some thousand sources at most, and what is held of them
at once (their totals, and one sum for each two) is less than that result.

Defined cases: null texts, languages and sources are empty strings; a row is a document,
whether or not it repeats an id; a language without kept terms has value 0 for each two of its
sources; a language of one source has no such rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.staging import staged
from tillscope.llm.textblocks import LOWER, Block, blocks, words

LEAST_DOCUMENTS = 10
RANKS = 10
BLOCK_BYTES = 4 << 20
PIECE_CELLS = 1 << 21
_BILLION = 1_000_000_000

_APART = np.ones(256, dtype=bool)
_APART[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
#: The leading bytes of a big-endian integer that belong to a term with so many left.
_HEADS = np.array([(1 << 64) - (1 << 64 - 8 * n) for n in range(9)], dtype=np.uint64)


def sort_pointers(
    data: np.ndarray, begins: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of the terms at the pointers, and where in it each run of equal ones begins."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray(len(data) + 1, dtype=">u8", buffer=padded, strides=(1,))
    order = np.arange(len(begins))
    new = np.zeros(len(begins), dtype=bool)
    new[:1] = True
    active, run = np.arange(len(begins)), np.zeros(len(begins), dtype=np.int64)
    depth = 0
    while len(active):
        pointers = order[active]
        left = np.clip(lengths[pointers] - depth, 0, 8)
        at = np.minimum(begins[pointers] + depth, len(data))
        keys = eight[at].astype(np.uint64) & _HEADS[left]
        moved = np.lexsort((keys, run)) if depth else np.argsort(keys, kind="stable")
        keys, left, pointers = keys[moved], left[moved], pointers[moved]
        order[active] = pointers
        step = np.ones(len(active), dtype=bool)
        step[1:] = (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])
        new[active] |= step
        # No term has a zero byte, so equal keys of fewer than eight bytes are whole terms.
        run = np.cumsum(step)
        several = np.bincount(run)[run] > 1
        deeper = several & (left == 8)
        active, run = active[deeper], run[deeper]
        depth += 8
    return order, np.flatnonzero(new)


def count_block(block: Block) -> pa.RecordBatch:
    """Rows (lang, source, term, documents, n) of one block."""
    langs, sources = (block.rows.column(name) for name in ("lang", "source"))
    kinds = pa.StructArray.from_arrays([langs, sources], ["lang", "source"])
    names, group = np.unique(
        np.array([f"{x['lang']}\0{x['source']}" for x in kinds.to_pylist()], dtype=object),
        return_inverse=True,
    )
    first_row = np.zeros(len(names), dtype=np.int64)
    first_row[group] = np.arange(len(group))
    data = LOWER[block.data]
    begins, ends, counts = words(data, block.starts, _APART)
    document = np.repeat(np.arange(len(counts)), counts)
    by_group = np.argsort(group[document], kind="stable")
    begins, ends, document = begins[by_group], ends[by_group], document[by_group]
    order, runs = sort_pointers(data, begins, ends - begins)
    document = document[order]
    of = group[document]
    cell = np.zeros(len(order), dtype=bool)
    cell[runs] = True
    cell[1:] |= of[1:] != of[:-1]
    once = cell.copy()
    once[1:] |= document[1:] != document[:-1]
    cells = np.flatnonzero(cell)
    raw, heads = data.tobytes(), order[cells]
    spans = zip(begins[heads].tolist(), ends[heads].tolist(), strict=True)
    terms = pa.array([raw[a:b] for a, b in spans], pa.binary()).cast(pa.string())
    row = pa.array(first_row[of[cells]])
    documents = np.add.reduceat(once.astype(np.int64), cells) if len(cells) else cells
    sizes = np.diff(np.append(cells, len(order)))
    return pa.RecordBatch.from_arrays(
        [langs.take(row), sources.take(row), terms, pa.array(documents), pa.array(sizes)],
        names=["lang", "source", "term", "documents", "n"],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", BLOCK_BYTES):
        yield count_block(block)


def _share(count: str, total: str, terms: str) -> Column:
    """p; in decimals, for the product leaves 64 bits."""
    share = f"(CAST({count} AS DECIMAL(38, 0)) + 2) * {_BILLION} div ({total} + 2 * {terms})"
    return 1 + F.expr(share)


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """As `_share`; without leaving 64 bits, as long division."""
    whole, rest = np.divmod(counts + 2, totals)
    out = whole * _BILLION
    if len(rest) and totals.max() < (1 << 63) // _BILLION:
        return 1 + out + rest * _BILLION // totals
    return 1 + out + (rest.astype(object) * _BILLION // totals.astype(object)).astype(np.int64)


def pair_sums(held: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each two columns: summed divergence and number of the rows that one of them holds.

    ``shares`` has a share in every cell, ``held`` tells the cells that are counted ones.
    """
    sources = held.shape[1]
    sums, rows = (np.zeros((sources, sources), dtype=np.int64) for _ in range(2))
    for g in range(sources):
        own = held[:, g]
        mine, theirs, lone = shares[own, g, None], shares[own], ~held[own]
        apart = (mine - theirs) ** 2 // (mine + theirs)
        sums[g] += apart.sum(axis=0)
        rows[g] += own.sum()
        # What the other lacks is seen from this side only.
        sums[:, g] += (apart * lone).sum(axis=0)
        rows[:, g] += lone.sum(axis=0)
    return sums, rows


def _sums_of_piece(terms: pa.Table, groups: pa.Table) -> pa.Table:
    names = groups.column("source").combine_chunks()
    totals = groups.column("total").to_numpy() + 2 * groups.column("terms").to_numpy()
    lists = terms.column("holders").combine_chunks()
    cells = lists.flatten()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    column = pc.index_in(cells.field("source"), names).to_numpy()
    shares = np.tile(_shares(np.zeros_like(totals), totals), (len(lists), 1))
    held = np.zeros(shares.shape, dtype=bool)
    held[row, column] = True
    shares[row, column] = _shares(cells.field("n").to_numpy(), totals[column])
    sums, rows = pair_sums(held, shares)
    one, other = np.nonzero(~np.eye(len(names), dtype=bool))
    return pa.table(
        {
            "lang": groups.column("lang").combine_chunks().take(pa.array(one)),
            "source": names.take(pa.array(one)),
            "item": names.take(pa.array(other)),
            "apart": pa.array(sums[one, other]),
            "seen": pa.array(rows[one, other]),
        }
    )


def _ranked(rows: DataFrame, part: str, most: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit_sources(documents: DataFrame, text: str = "text") -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of the parts ``pair`` and ``term``."""
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    rows = documents.select(*named, F.col(text).alias("text"))
    counted = (
        rows.mapInArrow(
            _count, "lang string, source string, term string, documents bigint, n bigint"
        )
        .groupBy("lang", "source", "term")
        .agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"))
    )
    terms = staged(
        counted.groupBy("lang", "term")
        .agg(
            F.sum("documents").alias("documents"),
            F.sum("n").alias("n"),
            F.collect_list(F.struct("source", "n")).alias("holders"),
        )
        .filter(F.col("documents") >= LEAST_DOCUMENTS)
        .drop("documents"),
        "terms",
    )
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    totals = (
        terms.select("lang", F.inline("holders"))
        .groupBy("lang", "source")
        .agg(F.sum("n").alias("total"))
    )
    zero = F.lit(0).cast("long")
    groups = staged(
        rows.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            *(F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")),
        ),
        "groups",
        narrow=True,
    )
    p, q = _share("n", "total", "terms"), _share("lang_n", "lang_total", "terms")
    above = (
        terms.select("lang", "term", F.col("n").alias("lang_n"), F.inline("holders"))
        .join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .filter("p > q")
        .withColumn("value", _divergence(F.col("p"), F.col("q")))
    )
    top = _ranked(above, "term", RANKS)

    # A piece has as many terms as fit into its cells, one for each source.
    sources = Window.partitionBy("lang")
    pieces = F.ceil(F.col("terms") * F.count("*").over(sources) / PIECE_CELLS)
    dealt = staged(
        groups.withColumn("pieces", F.greatest(pieces, F.lit(1))), "dealt", narrow=True
    )
    per_lang = dealt.select("lang", "pieces").distinct()
    left = (
        terms.join(per_lang, "lang")
        .select("lang", "holders", F.pmod(F.xxhash64("term"), "pieces").alias("piece"))
        .groupBy("lang", "piece")
    )
    right = dealt.select(
        "lang", "source", "total", "terms", F.explode(F.sequence(zero, F.col("pieces") - 1))
    ).withColumnRenamed("col", "piece")
    sums = (
        left.cogroup(right.groupBy("lang", "piece"))
        .applyInArrow(
            _sums_of_piece,
            "lang string, source string, item string, apart bigint, seen bigint",
        )
        .groupBy("lang", "source", "item")
        .agg(F.sum("apart").alias("apart"), F.sum("seen").alias("seen"))
    )
    nothing = _share("0", "total", "terms")
    one = groups.filter("terms > 0").select("lang", "source", "terms", nothing.alias("p"))
    one = one.unionByName(
        groups.filter("terms = 0").select("lang", "source", "terms", F.lit(1).cast("long").alias("p"))
    )
    other = one.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    unseen = F.col("terms") - F.coalesce("seen", zero)
    pairs = (
        one.join(other, "lang")
        .filter("source <> item")
        .join(sums, ["lang", "source", "item"], "left")
        .withColumn(
            "value",
            F.coalesce("apart", zero) + unseen * _divergence(F.col("p"), F.col("q")),
        )
    )
    return _ranked(pairs, "pair", None).unionByName(top)
