"""Connected components in few rounds, each one written table.

A round first joins, by union-find in each partition and without a shuffle, what the
partition's own links connect; so a node has one row at most in each partition, whatever its
number of links. The rows are then summed up by node, which gives every node one
parent and links its other parents to that one. At last each parent is replaced by its own
parent, in a join whose one side has a row for each node, so that adaptive execution can
divide the rows of a hot root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillscope.llm.staging import release, staged


def smallest_reachable(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the links, ascending, and the smallest node each is connected to."""
    nodes, position = np.unique(np.concatenate((one, other)), return_inverse=True)
    x, y = position[: len(one)], position[len(one) :]
    parent = np.arange(len(nodes))
    while len(x):
        of_x, of_y = parent[x], parent[y]
        apart = of_x != of_y
        x, y, of_x, of_y = x[apart], y[apart], of_x[apart], of_y[apart]
        np.minimum.at(parent, np.maximum(of_x, of_y), np.minimum(of_x, of_y))
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    return nodes, nodes[parent]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if parts:
        one, other = (np.concatenate(side) for side in zip(*parts, strict=True))
        nodes, roots = smallest_reachable(one, other)
        low = nodes != roots
        columns = [pa.array(nodes[low]), pa.array(roots[low])]
        yield pa.RecordBatch.from_arrays(columns, ["node", "to"])


def connected_components(links: DataFrame) -> DataFrame:
    """Node and component (its smallest node) of every node of the links (a, b), both bigint.

    Nodes without links are in no row; links with a null are left out. A round that finds
    a single parent for every node, and no parent that has one itself, is the last.
    """
    lower = F.least("a", "b").alias("to")
    rows = staged(
        links.filter("a != b").select(F.greatest("a", "b").alias("node"), lower),
        "links",
        narrow=True,
    )
    if rows.isEmpty():
        return rows.withColumnRenamed("to", "component")
    while True:
        parents = (
            rows.mapInArrow(_contract, "node bigint, to bigint")
            .groupBy("node")
            .agg(F.min("to").alias("least"), F.collect_set("to").alias("every"))
        )
        above = parents.select(F.col("node").alias("to"), F.col("least").alias("above"))
        edge = F.transform(
            "every",
            lambda to: F.struct(
                F.when(to > F.col("least"), to).otherwise(F.col("node")).alias("node"),
                F.col("least").alias("to"),
                (to > F.col("least")).alias("more"),
            ),
        )
        edges = parents.select(F.inline(edge))
        jumped = edges.join(above, "to", "left")
        seen = Observation()
        unsettled = F.count(F.when(F.col("more") | F.col("above").isNotNull(), 1))
        settled = staged(
            jumped.observe(seen, unsettled.alias("rows")).select(
                "node", F.coalesce("above", "to").alias("to")
            ),
            "components",
            narrow=True,
        )
        release(rows)
        rows = settled
        if not seen.get["rows"]:
            break
    roots = rows.select(F.col("to").alias("node"), F.col("to").alias("component")).distinct()
    return rows.select("node", F.col("to").alias("component")).union(roots)
