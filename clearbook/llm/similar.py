"""Exact Jaccard similarity inside groups of nodes: components of all pairs of a group, without listing the pairs.

First each node is compared with the smallest and the largest node of its group. Groups that this leaves in more than one
component are cut into tiles: the nodes outside the group's most frequent component meet all nodes of the group, so every
pair of different components is compared, a pair of tiles in one task. Only links that join components leave a task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.components import components
from clearbook.llm.shared import apart, back, batches, keep, keep_counted

#: Nodes of a tile, and shingles of a tile on average: long sets make smaller tiles.
TILE_ROWS, TILE_SHINGLES = 128, 128 * 1024
#: Distinct shingles that are counted at once.
COLUMNS = 4096


def root_links(
    left: list[np.ndarray], left_roots: np.ndarray, right: list[np.ndarray], right_roots: np.ndarray, similarity: float
) -> list[tuple[int, int]]:
    """Links (root, root) that join the components of all pairs of a left and a right set similar enough."""
    roots, places = np.unique(np.concatenate((left_roots, right_roots)), return_inverse=True)
    if len(roots) < 2:
        return []
    sets = left + right
    lengths = np.array([len(s) for s in sets])
    known, columns = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), lengths)
    order = np.argsort(columns, kind="stable")
    columns, owners = columns[order], owners[order]
    both = np.zeros((len(left), len(right)), np.float64)
    edges = np.searchsorted(columns, np.arange(0, len(known) + COLUMNS, COLUMNS))
    for part, (start, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owners[start:end], columns[start:end] - part * COLUMNS] = 1
        both += held[: len(left)] @ held[len(left) :].T
    either = lengths[: len(left), None] + lengths[None, len(left) :] - both
    alike = both / np.maximum(either, 1) >= similarity
    apart_now = places[: len(left), None] != places[None, len(left) :]
    parent = list(range(len(roots)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    links = []
    for i, j in np.argwhere(alike & apart_now).tolist():
        if (a := find(places[i])) != (b := find(places[len(left) + j])):
            parent[max(a, b)] = min(a, b)
            links.append((int(roots[a]), int(roots[b])))
    return links


def _tiled_links(rooted: DataFrame, sets: DataFrame, similarity: float, tile_rows: int) -> DataFrame:
    """(a, b) between roots of ``rooted`` (key, node, root): all links of groups that hold more than one root."""
    counts = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    groups = counts.groupBy("key").agg(
        F.max(F.struct("n", "root"))["root"].alias("main"), F.sum("n").alias("n"), F.count("*").alias("roots")
    )
    mixed, several = keep_counted(groups.where("roots > 1").drop("roots"), "mixed")
    side = F.broadcast(mixed) if several <= 100_000 else mixed
    members = keep(rooted.join(side, "key").join(sets, "node"), "members")
    # The number of tiles of either side follows its nodes and their shingles.
    measured = members.groupBy("key").agg(
        *(
            F.ceil(F.greatest(rows / tile_rows, shingles / TILE_SHINGLES, F.lit(1))).cast("int").alias(name)
            for name, rows, shingles in (
                ("all_tiles", F.count("*"), F.sum(F.size("shingles"))),
                (
                    "rest_tiles",
                    F.count_if(F.col("root") != F.col("main")),
                    F.coalesce(F.sum(F.when(F.col("root") != F.col("main"), F.size("shingles"))), F.lit(0)),
                ),
            )
        )
    )
    measured, tiled = keep_counted(measured, "tiles")
    side = F.broadcast(measured) if tiled <= 100_000 else measured
    sized = members.join(side, "key")
    value = F.struct("root", "shingles")

    def dealt(rows: DataFrame, own: str, other: str, tile: str, met: str, name: str) -> DataFrame:
        return rows.select(
            "key",
            F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(tile),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(met),
            value.alias(name),
        )

    left = dealt(sized.where("root <> main"), "rest_tiles", "all_tiles", "low", "high", "left")
    right = dealt(sized, "all_tiles", "rest_tiles", "high", "low", "right")
    sides = (
        left.unionByName(right, allowMissingColumns=True)
        .groupBy("key", "low", "high")
        .agg(F.collect_list("left").alias("left"), F.collect_list("right").alias("right"))
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def unpacked(side: pa.ListScalar) -> tuple[list[np.ndarray], np.ndarray]:
        roots, shingles = side.values.flatten()
        return [s.values.to_numpy() for s in shingles], roots.to_numpy()

    def link(batch: pa.RecordBatch) -> dict:
        pairs = [
            pair
            for a, b in zip(batch.column(0), batch.column(1))
            if len(a.values) and len(b.values)
            for pair in root_links(*unpacked(a), *unpacked(b), similarity)
        ]
        return {"a": [a for a, _ in pairs], "b": [b for _, b in pairs]}

    return sides.select("left", "right").mapInArrow(batches(link, schema), "a long, b long")


def similar_components(
    members: DataFrame,
    shingle_sets: Callable[[DataFrame], DataFrame],
    similarity: float,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(node, root) of nodes linked to another: root is the smallest node of the component.

    ``members`` (key, node: long, distinct) says which nodes are in a group together; ``shingle_sets`` gives (node,
    shingles: sorted distinct) of a table of nodes. Two nodes are linked if they share a group and the Jaccard similarity
    of their shingles is at least ``similarity``. A node may have several sets; each of them is compared.
    """
    grouped = apart(members, "key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
    ends = grouped.where("low <> high").select(back("key"), "low", "high", "n")
    shared = keep(members.join(ends, "key"), "shared")
    met = shared.select("node", F.explode(F.array("low", "high")).alias("other")).where("node <> other")
    pairs = keep(met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "pairs")
    sets = keep(shingle_sets(shared.select("node").distinct()), "shingles")
    left, right = (sets.select(F.col("node").alias(n), F.col("shingles").alias(f"of_{n}")) for n in "ab")
    compared = pairs.join(left, "a").join(right, "b")
    both = F.size(F.array_intersect("of_a", "of_b"))
    exact = both / (F.size("of_a") + F.size("of_b") - both)
    first = keep(components(compared.where(exact >= similarity).select("a", "b").distinct()), "first")
    # In groups of up to three nodes every pair has been compared.
    crowded = shared.where("n > 3").select("key", "node").join(first, "node", "left")
    rooted = keep(crowded.select("key", "node", F.coalesce("root", "node").alias("root")), "rooted")
    further = _tiled_links(rooted, sets, similarity, tile_rows)
    return components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(further))
