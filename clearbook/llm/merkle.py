"""Merkle manifest of a data set: a tree of digests per source, a tree over the sources, and a proof for every row.

The rows of a source are its leaves, in order. While several nodes remain, every ``arity`` consecutive ones become the
digest of their concatenation; what remains is the source's subroot, and the subroots, in order of their sources, give the
root in the same way. A node that is alone in the last run of a level is hashed too.

Leaves are numbered by a range shuffle, whatever the sizes of the sources, and cut into superblocks of ``arity ** height``
consecutive leaves of a source. A superblock is reduced in one task; the tops of a large source's superblocks are the
leaves of the next round, until one superblock is left. On the way back every superblock needs the path of its top node
only: leaves and these outer nodes are cogrouped, and one function reduces the superblock again, joins the inner and the
outer part of each proof, and folds it. Small sources share a task: a bundle holds all superblocks that begin within the
same ``arity ** height`` rows of the whole order, so its rows are
bounded, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbook.llm.shared import columns_of, keep

#: Nodes of a run, and levels of a superblock.
ARITY, HEIGHT = 16, 3
#: Makes a row of a node's row, the siblings left and right on its path, its subroot and the root.
Finish = Callable[[tuple, list[str], list[str], str, str], tuple]
_PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def row_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values: each as ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    texts = [value.cast("string") for value in values]
    sized = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*sized), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(level: list[str], arity: int, height: int | None) -> list[list[str]]:
    """The levels of a tree from its leaves up: until one node is left, or ``height`` levels more."""
    levels = [level]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    return levels


def siblings(levels: list[list[str]], place: int, arity: int) -> Iterator[tuple[str, str]]:
    """What stands left and right of a leaf's ancestors in their runs, from the leaf to below the top node."""
    for level in levels[:-1]:
        start = place - place % arity
        yield "".join(level[start:place]), "".join(level[place + 1 : start + arity])
        place //= arity


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows``, as a written table, with ``pos`` in its tree, the tree's ``size`` and ``place`` in the whole order (by tree, null first).

    The rows are sorted by a range shuffle; rows equal in all of ``order`` are interchangeable. Only counts by partition
    and tree are added up, and of these only the counts by partition in one task.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [tree, *order, "_tie"]
    dealt = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    kept = keep(dealt.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_row", 33)
    counted = kept.groupBy(F.col(tree).alias("_tree"), part.alias("_part")).agg(F.count("*").alias("n"), F.min("_row").alias("first"))
    counted = keep(counted, "counts")
    starts = counted.groupBy("_part").agg(F.sum("n").alias("rows"))
    starts = starts.select("_part", (F.sum("rows").over(Window.orderBy("_part")) - F.col("rows")).alias("start"))
    whole = Window.partitionBy("_tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select(
        "_tree", "_part", "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("size"),
    ).join(F.broadcast(starts), "_part")
    joined = kept.join(placed, kept[tree].eqNullSafe(placed["_tree"]) & (part == placed["_part"]))
    row = F.col("_row") - F.shiftleft(F.col("_part"), 33)
    return keep(
        joined.select(
            *columns_of(rows),
            (F.col("_row") - F.col("first") + F.col("before")).alias("pos"),
            "size",
            (F.col("start") + row).alias("place"),
        ),
        "numbered",
    )


class _Forest:
    """The rounds of superblocks over trees of nodes (tree, pos, size, place, node, and what else a leaf holds)."""

    def __init__(self, leaves: DataFrame, arity: int, height: int):
        self.arity, self.height, self.block = arity, height, arity**height
        self.rounds = [self._bundled(leaves)]
        roots = []
        while True:
            tops = keep(self._tops(self.rounds[-1]), "tops")
            roots.append(tops.where("done").select("tree", "node"))
            following = tops.where("not done").drop("done")
            if following.isEmpty():
                break
            self.rounds.append(self._bundled(following))
        self.roots = roots[0]
        for more in roots[1:]:
            self.roots = self.roots.unionByName(more)

    def _bundled(self, nodes: DataFrame) -> DataFrame:
        first = F.col("place") - F.col("pos") % self.block
        return nodes.withColumn("bundle", F.floor(first / self.block).cast("long"))

    def _tops(self, nodes: DataFrame) -> DataFrame:
        """The top node of every superblock, placed for the next round; it is done if it is its tree's root."""
        arity, height, block = self.arity, self.height, self.block

        def reduce(rows: pd.DataFrame) -> pd.DataFrame:
            out = []
            for place, pos, part in _blocks(rows, block):
                size, tree = int(part["size"].iloc[0]), _plain(part["tree"].iloc[0])
                top = climb(part["node"].tolist(), arity, None if size <= block else height)[-1][0]
                out.append((tree, pos // block, -(-size // block), place // block, top, size <= block))
            return pd.DataFrame(out, columns=["tree", "pos", "size", "place", "node", "done"])

        narrow = nodes.select("bundle", "tree", "pos", "size", "place", "node")
        return narrow.groupBy("bundle").applyInPandas(
            reduce, "tree string, pos long, size long, place long, node string, done boolean"
        )

    def paths(self, outer: DataFrame, finish: Finish, schema: str) -> DataFrame:
        """What ``finish`` makes of every leaf's row and its path, as rows of ``schema``.

        ``outer`` (tree, lefts, rights, subroot, root) has the paths of the trees' roots.
        """
        of_trees = outer.withColumn("block", F.lit(0).cast("long"))
        for index in range(len(self.rounds) - 1, -1, -1):
            nodes = self.rounds[index]
            ends = nodes.where(f"size <= {self.block} and pos = 0")
            ends = ends.select(F.col("tree").alias("_tree"), F.col("bundle").alias("_bundle"))
            above = of_trees.join(ends, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
            above = above.withColumnRenamed("_bundle", "bundle")
            if index < len(self.rounds) - 1:
                above = above.unionByName(inner)
            if index == 0:
                return self._cogrouped(nodes, above, finish, schema)
            # A node of this round is the top of superblock ``pos`` below, whose bundle is its place.
            inner = keep(self._cogrouped(nodes, above, _as_outer, f"tree string, block long, bundle long, {_PATH}"), "outer")
        raise AssertionError("a forest has a round")

    def _cogrouped(self, nodes: DataFrame, above: DataFrame, finish: Finish, schema: str) -> DataFrame:
        arity, height, block = self.arity, self.height, self.block

        def prove(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            known = {(_plain(o.tree), o.block): o for o in outer.itertuples(index=False)}
            found = []
            for _, pos, part in _blocks(rows, block):
                size, tree = int(part["size"].iloc[0]), _plain(part["tree"].iloc[0])
                levels = climb(part["node"].tolist(), arity, None if size <= block else height)
                top = known[tree, pos // block]
                lefts, rights = list(top.lefts), list(top.rights)
                subroot = top.subroot if top.subroot is not None else levels[-1][0]
                for place, row in enumerate(part.itertuples(index=False)):
                    own = list(siblings(levels, place, arity))
                    found.append(
                        finish(row, [a for a, _ in own] + lefts, [b for _, b in own] + rights, subroot, top.root)
                    )
            names = [field.split()[0] for field in schema.split(", ")]
            return pd.DataFrame(found, columns=names)

        # Both sides may come from one table: the outer one gets columns of its own.
        above = above.select(*(F.col(name).alias(name) for name in above.columns))
        return nodes.groupBy("bundle").cogroup(above.groupBy("bundle")).applyInPandas(prove, schema)


def _plain(tree: object) -> str | None:
    return tree if isinstance(tree, str) else None


def _blocks(rows: pd.DataFrame, block: int) -> Iterator[tuple[int, int, pd.DataFrame]]:
    """(place, position of the first node, nodes in order) of each superblock of a bundle.

    From the second round on, the last superblock of a tree and the first of the next may have one place.
    """
    rows = rows.sort_values("place", kind="stable")
    first = rows["place"] - rows["pos"] % block
    for _, part in rows.groupby([first, rows["tree"]], sort=False, dropna=False):
        yield int(part["place"].iloc[0]), int(part["pos"].iloc[0]), part


def _as_outer(row, lefts: list[str], rights: list[str], subroot: str, root: str) -> tuple:
    return _plain(row.tree), row.pos, row.place, lefts, rights, subroot, root


def _of_tree(row, lefts: list[str], rights: list[str], subroot: str, root: str) -> tuple:
    return _plain(row.name), lefts, rights, row.node, root


def _proved(row, lefts: list[str], rights: list[str], subroot: str, root: str) -> tuple:
    """A leaf's row with its proof, folded from the claim."""
    at = row.node if row.claim is None else row.claim
    for left, right in zip(lefts, rights):
        at = digest(left + at + right)
    proof = digest("".join(left + right for left, right in zip(lefts, rights)))
    return row.id, _plain(row.tree), row.node, subroot, root, proof, at, at == root, lefts, rights


def _proved_narrow(row, lefts: list[str], rights: list[str], subroot: str, root: str) -> tuple:
    return _proved(row, lefts, rights, subroot, root)[:-2]


def manifest(leaves: DataFrame, arity: int = ARITY, height: int = HEIGHT, paths: bool = False) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``leaves``.

    ``leaves`` has (doc_id: long, source: string, leaf: hex digest, claim: hex digest to be checked, null for the leaf
    itself). Leaves ascend by doc_id within their source, a null doc_id first, rows with one doc_id by leaf and claim; equal
    rows are interchangeable. A null source is a source of its own and the first. With ``paths`` there are two more columns:
    ``lefts`` and ``rights`` hold, level by level from the leaf via the subroot to the root, the siblings that stand left and
    right of the node in its run, joined. ``proof_sha256`` is the digest of all siblings in that order, ``folded_root`` is
    what the proof makes of the claim, and ``verified`` says whether that is the root. Other columns are ignored; an empty
    table gives no rows.
    """
    # Ids travel as text: pandas has no whole numbers that may be missing.
    plain = leaves.select(
        F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("long").alias("id"),
        F.col("leaf").alias("node"), "claim",
    )
    ordered = numbered(keep(plain, "digests"), "tree", ["id", "node", "claim"])
    forest = _Forest(ordered.withColumn("id", F.col("id").cast("string")), arity, height)
    named = forest.roots.select(F.lit("all").alias("tree"), F.col("tree").alias("name"), "node")
    crown = _Forest(numbered(named, "tree", ["name"]), arity, height)
    nothing = F.array().cast("array<string>")
    root = crown.roots.select(
        "tree", nothing.alias("lefts"), nothing.alias("rights"), F.lit(None).cast("string").alias("subroot"),
        F.col("node").alias("root"),
    )
    outer = keep(crown.paths(root, _of_tree, f"tree string, {_PATH}"), "subroots")
    schema = (
        "doc_id string, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean"
    )
    if paths:
        proved = forest.paths(outer, _proved, f"{schema}, lefts array<string>, rights array<string>")
    else:
        proved = forest.paths(outer, _proved_narrow, schema)
    return proved.withColumn("doc_id", F.col("doc_id").cast("long"))


def document_leaves(docs: DataFrame, changed: Column | None = None, text: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, claim) of every row of a documents table.

    Where ``changed`` holds, the claim is the digest with another ``text``; elsewhere it is null.
    """

    def of(value: Column) -> Column:
        return row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), value)

    claim = F.lit(None).cast("string") if changed is None or text is None else F.when(changed, of(text))
    return docs.select("doc_id", "source", of(F.col("text")).alias("leaf"), claim.alias("claim"))
