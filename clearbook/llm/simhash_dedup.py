"""Near-duplicate documents by SimHash: sharded BK-trees find all fingerprints within a Hamming radius.

A fingerprint is the bitwise majority of the XXH64 values of a text's word shingles. Equal fingerprints are one node.
The nodes are sharded so that two within the radius always meet in a shard: of ``radius + agree`` blocks of bits, two
codes within ``radius`` agree on at least ``agree``, so every choice of ``agree`` blocks makes a shard key. Each shard is a
BK-tree whose children are keyed by their integer Hamming distance to the parent; a search follows only edges within the
radius of the distance it has just measured. A shard tree goes to the one task that holds its queries: together the trees
hold every fingerprint, so none is broadcast to all executors.

A shard with more than ``shard_rows`` fingerprints is dealt anew, without losing a pair. For a radius of at most 2 the
finer key is every code within one flip of a fingerprint: two within the radius share such a code, and no shard has more
than the 65 members of the ball around its key. For a larger radius the shard is cut into tiles of ``shard_rows``; each
pair of tiles is compared in one task.

Documents are dropped only after their five-word shingles have been compared exactly inside the SimHash components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearbook.llm.components import components
from clearbook.llm.shared import (
    apart, back, batches, columns_of, keep, keep_counted, rolled, settled, shingle_hashes, word_hashes, words_of,
)
from clearbook.llm.similar import similar_components

BITS = 64
SEED = 42
_ALL = (1 << BITS) - 1
#: Words of the shingles that near copies are verified by.
EXACT_SHINGLE = 5


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash: a bit is 1 if it is set in over half of the shingles' hashes; 0 for a text without words."""
    hashes = shingle_hashes(words_of(text), shingle, SEED)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start : start + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, code) of every row; a null text counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("code", pa.int64())])

    def mark(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "code": [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]}

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches(mark, schema), "doc_id long, code long")


class Rooted:
    """Codes in order, each with the root of the component it is known to be in; joining codes joins their roots."""

    def __init__(self, codes: list[int], roots: list[int]):
        of_code = dict(zip(codes, roots))
        self.codes = sorted(of_code)
        self.roots = sorted(set(roots))
        place = {root: i for i, root in enumerate(self.roots)}
        self.place = [place[of_code[code]] for code in self.codes]
        self.parent = list(range(len(self.roots)))

    def find(self, at: int) -> int:
        parent = self.parent
        while parent[at] != at:
            parent[at] = at = parent[parent[at]]
        return at

    def join(self, i: int, j: int) -> None:
        if (a := self.find(self.place[i])) != (b := self.find(self.place[j])):
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> list[tuple[int, int]]:
        """One link per root that is not the smallest of its component."""
        return [(root, self.roots[top]) for i, root in enumerate(self.roots) if (top := self.find(i)) != i]


def bk_links(codes: list[int], radius: int, roots: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between the roots of all codes connected by steps of at most ``radius`` bits; a code is its own root by default."""
    codes = [c & _ALL for c in codes]
    rooted = Rooted(codes, codes if roots is None else [r & _ALL for r in roots])
    codes = rooted.codes
    children: list[dict[int, int]] = [{} for _ in codes]
    for i, code in enumerate(codes[1:], 1):
        stack = [0]
        while stack:
            at = stack.pop()
            distance = (codes[at] ^ code).bit_count()
            if distance <= radius:
                rooted.join(at, i)
            stack.extend(child for edge, child in children[at].items() if abs(edge - distance) <= radius)
        at = 0
        while (following := children[at].get(distance := (codes[at] ^ code).bit_count())) is not None:
            at = following
        children[at][distance] = i
    return rooted.links()


def _signed(code: int) -> int:
    return code - (1 << 64) if code >> 63 else code


def _shard_links(shards: DataFrame, radius: int) -> DataFrame:
    """BK-tree links of each row of ``shards`` (codes: array of (code, root))."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batch: pa.RecordBatch) -> dict:
        found = []
        for shard in batch.column(0):
            codes, roots = (side.to_pylist() for side in shard.values.flatten())
            found.extend(bk_links(codes, radius, roots))
        return {"a": [_signed(a) for a, _ in found], "b": [_signed(b) for _, b in found]}

    return shards.select("codes").mapInArrow(batches(link, schema), "a long, b long")


def block_choices(radius: int, agree: int) -> list[tuple[int, ...]]:
    """All choices of ``agree`` of the blocks, those that have no block in common first."""
    count = radius + agree
    apart_ones = [tuple(range(i, i + agree)) for i in range(0, count - agree + 1, agree)]
    return [*apart_ones, *(x for x in combinations(range(count), agree) if x not in apart_ones)]


def _block_keys(radius: int, agree: int, choices: list[tuple[int, ...]]) -> F.Column:
    """One key per choice of blocks: the number of the choice and the bits of its blocks."""
    count = radius + agree
    edges = [BITS * i // count for i in range(count + 1)]
    masks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(count)]
    chosen = [_signed(sum(masks[i] for i in choice)) for choice in choices]
    picked = F.transform(F.array(*map(F.lit, chosen)), lambda mask, n: F.struct(n, F.col("code").bitwiseAND(mask)))
    return picked.cast("array<struct<pair:int,bits:bigint>>")


def tile_links(
    left: np.ndarray, right: np.ndarray, radius: int, roots: tuple[np.ndarray, np.ndarray] | None = None
) -> list[tuple[int, int]]:
    """Links between the roots of the codes of two tiles within ``radius``: a spanning forest, not all pairs."""
    codes = np.concatenate((left, right)).tolist()
    rooted = Rooted(codes, codes if roots is None else np.concatenate(roots).tolist())
    known = np.array(rooted.codes, left.dtype)
    place = np.searchsorted(known, right)
    for i, code in zip(np.searchsorted(known, left).tolist(), left):
        for j in place[np.bitwise_count(right ^ code) <= radius].tolist():
            rooted.join(i, j)
    return rooted.links()


def _dense_links(dense: DataFrame, radius: int, rows: int) -> DataFrame:
    """Links within shards of many codes (key, n, code, root): each code meets every tile of its shard once."""
    tiles = F.ceil(F.col("n") / rows).cast("int")
    dealt = dense.select(
        "key", F.struct("code", "root").alias("code"), tiles.alias("tiles"),
        F.pmod(F.xxhash64("code"), tiles).cast("int").alias("tile"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    met = dealt.select("key", "code", "tile", other).select(
        "key", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "code"
    )
    sides = met.groupBy("key", "low", "high").agg(
        F.collect_list(F.when(F.col("tile") == F.col("low"), F.col("code"))).alias("left"),
        F.collect_list(F.when(F.col("tile") == F.col("high"), F.col("code"))).alias("right"),
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batch: pa.RecordBatch) -> dict:
        found = []
        for left, right in zip(batch.column(0), batch.column(1)):
            a, b = ([part.to_numpy() for part in side.values.flatten()] for side in (left, right))
            found.extend(tile_links(a[0], b[0], radius, (a[1], b[1])))
        return {"a": [a for a, _ in found], "b": [b for _, b in found]}

    return sides.select("left", "right").mapInArrow(batches(link, schema), "a long, b long")


def links(
    codes: DataFrame, radius: int = 2, agree: int = 2, shard_rows: int = 512, choices: list[tuple[int, ...]] | None = None
) -> DataFrame:
    """(a, b) over distinct fingerprints (code, root: long) that joins the roots of all within ``radius``, not by all pairs.

    Without ``root`` a code is its own. ``choices`` are the choices of blocks to look at, all by default. Shards whose codes
    have one root already give nothing.
    """
    if "root" not in codes.columns:
        codes = codes.withColumn("root", F.col("code"))
    # One code becomes many rows here: they are made by as many tasks as a shuffle has, however small the table is. The codes
    # may be dealt by themselves already, so they are dealt by something else.
    tasks = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = codes.repartition(tasks, F.xxhash64("code"))
    keys = _block_keys(radius, agree, choices or block_choices(radius, agree))
    keyed = spread.select(F.explode(keys).alias("key"), "code", "root").select("key.*", "code", "root")
    # Counted by another form of the bits, so that a join by the key deals both sides anew and may split a dense shard.
    counted = keyed.groupBy("pair", F.bitwise_not("bits").alias("_bits")).agg(
        F.count("*").alias("n"), (F.min("root") < F.max("root")).alias("mixed")
    )
    crowded = counted.where(F.col("n") > shard_rows).select("pair", F.bitwise_not("_bits").alias("bits"), "n", "mixed")
    hot, shards = keep_counted(crowded, "crowded")
    side = F.broadcast(hot) if shards <= 100_000 else hot
    key = F.struct("pair", "bits").alias("key")
    small = keyed.join(side, ["pair", "bits"], "left_anti").groupBy(key)
    small = small.agg(
        F.collect_list(F.struct("code", "root")).alias("codes"), (F.min("root") < F.max("root")).alias("mixed")
    ).where("mixed")
    dense = keyed.join(side, ["pair", "bits"]).where("mixed").select(key, "n", "code", "root")
    if radius > 2:
        return _shard_links(small, radius).unionByName(_dense_links(dense, radius, 4 * shard_rows))
    flips = F.array(*(F.lit(_signed(mask)) for mask in (0, *(1 << bit for bit in range(BITS)))))
    around = F.explode(F.transform(flips, lambda mask: F.col("code").bitwiseXOR(mask))).alias("key")
    balls = dense.select("code", "root").distinct().select(around, "code", "root").groupBy("key")
    fine = balls.agg(F.collect_list(F.struct("code", "root")).alias("codes")).where(F.size("codes") > 1)
    return _shard_links(small.select("codes").unionByName(fine.select("codes")), radius)


def code_components(codes: DataFrame, radius: int = 2, agree: int = 2, shard_rows: int = 512) -> DataFrame:
    """(node, root) of the distinct fingerprints (code: long) that are linked to another; root is the smallest reached.

    Over a radius of 2 there are many choices of blocks, and a large group would get other links from each of them. So the
    choices that have no block in common come first; what they join is one root for the others, which only add links
    between different roots.
    """
    if radius <= 2:
        return components(links(codes, radius, agree, shard_rows))
    choices = block_choices(radius, agree)
    ahead = (radius + agree) // agree
    first = components(links(codes, radius, agree, shard_rows, choices[:ahead]))
    rooted = codes.join(first.withColumnRenamed("node", "code"), "code", "left")
    rooted = keep(rooted.select("code", F.coalesce("root", "code").alias("root")), "rooted")
    further = components(links(rooted, radius, agree, shard_rows, choices[ahead:]))
    moved = further.select(F.col("node").alias("root"), F.col("root").alias("_root"))
    return rooted.join(moved, "root", "left").select(F.col("code").alias("node"), F.coalesce("_root", "root").alias("root"))


def simhash_components(
    docs: DataFrame, shingle: int = 3, radius: int = 2, agree: int = 2, shard_rows: int = 512
) -> DataFrame:
    """(doc_id, code, component_id) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that can be reached by links of at most ``radius`` bits. Null, empty and
    white-space texts have code 0 and are linked like any other; repeated rows stay; a null doc_id never names a component
    that has another; other columns are ignored; an empty table gives an empty result.
    """
    marked = keep(fingerprints(docs, shingle), "codes")
    nodes = marked.groupBy("code").agg(F.min("doc_id").alias("first"))
    roots = code_components(nodes.select("code"), radius, agree, shard_rows)
    placed = nodes.join(roots.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "first", F.coalesce("root", "code").alias("root")
    )
    named = apart(placed, "root").agg(F.min("first").alias("component_id"))
    of_code = placed.join(named.select(back("root"), "component_id"), "root").select("code", "component_id")
    return marked.join(of_code, "code", "left").select("doc_id", "code", "component_id")


def hex_code(code: F.Column) -> F.Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, node) of every row: a node is a set of five-word shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64())])

    def mark(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "node": [_node(_shingles(t)) for t in batch.column(1).to_pylist()]}

    return docs.mapInArrow(batches(mark, schema), "doc_id long, node long")


def _shingles(text: str | None) -> np.ndarray:
    return np.unique(rolled(word_hashes(words_of(text)), EXACT_SHINGLE)).view(np.int64)


def _node(shingles: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(shingles.tobytes()))


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles: sorted distinct) of the texts in ``wanted`` (doc_id, node)."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def sets(batch: pa.RecordBatch) -> dict:
        # A doc_id may have other rows, which are not those asked for.
        made = [(node, _shingles(t)) for t, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        made = [(node, own.tolist()) for node, own in made if _node(own) == node]
        return {"node": [node for node, _ in made], "shingles": [own for _, own in made]}

    texts = docs.join(wanted, "doc_id").select("text", "node")
    return texts.mapInArrow(batches(sets, schema), "node long, shingles array<long>").dropDuplicates(["node"])


def exact_components(docs: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, root) of every row of ``docs`` (doc_id, text) that is in one of ``groups`` (key, doc_id).

    Rows of one root are joined by links between documents of a group whose five-word shingles have at least the Jaccard
    similarity.
    """
    asked = docs.join(groups.select("doc_id").distinct(), "doc_id")
    nodes = keep(_marked(asked.select("doc_id", "text")).distinct(), "nodes")
    places = nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    members = keep(groups.join(nodes, "doc_id").select("key", "node").distinct(), "members")
    roots = similar_components(members, lambda some: _shingle_sets(docs, places.join(some, "node")), similarity)
    return nodes.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))


def drop_near_copies(
    docs: DataFrame, shingle: int = 3, radius: int = 6, agree: int = 3, similarity: float = 0.8
) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest doc_id, and all its columns.

    The SimHash components only say which documents are compared; links between them are those whose exact Jaccard
    similarity of five-word shingles is at least ``similarity``, and components of these links are the groups.

    Of rows that repeat a doc_id the one with the smallest text stays. Rows with a null doc_id cannot be named as copies
    or originals and all stay; they link nothing.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")

    def near() -> DataFrame:
        found = simhash_components(docs, shingle, radius, agree).where("doc_id is not null")
        return found.select(F.col("component_id").alias("key"), "doc_id").distinct()

    def staying() -> DataFrame:
        placed = settled(near, "placed")
        several = keep(apart(placed, "key").agg(F.count("*").alias("n")).where("n > 1").select(back("key")), "several")
        exact = exact_components(texts, keep(placed.join(several, "key"), "candidates"), similarity)
        firsts = apart(exact, "root").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
        alone = placed.join(several, "key", "left_anti").select("doc_id")
        return firsts.unionByName(alone).distinct()

    kept = docs.join(settled(staying, "staying"), "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy("text")
    once = kept.withColumn("__clearbook_row", F.row_number().over(order)).where("__clearbook_row = 1")
    return once.select(columns_of(docs)).unionByName(docs.where("doc_id is null"))
