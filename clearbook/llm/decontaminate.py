"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming lookup, exact weighted similarity.

Every window of a document that is as long as a benchmark item can be a leak of it. A window's SimHash over its word
shingles, weighted by how often they occur, is looked up in an index of the items' SimHashes: eight blocks of eight bits,
each with the items whose block is within ``radius // 8`` flips, so that every item within ``radius`` is found. The exact
weighted Jaccard similarity of the shingles, sum of minima over sum of maxima, decides.

A document with fewer shingles than an item is one window, the whole of it. As it is looked up once, its items are found
exactly by the shingles they share, without SimHash.

A window can only reach the wanted similarity if nearly all its shingles occur in some item; windows that cannot are not
hashed. That test is exact and loses nothing.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import batches, columns_of, rolled, word_hashes, words_of

SHINGLE = 5
BLOCKS = 8
#: Slots of the table that tells shingles of no item at once.
SLOTS = 1 << 20


def weighted_simhash(hashes: np.ndarray) -> int:
    """64-bit majority of the hashes, each as often as it occurs."""
    ones = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little").sum(0)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = (a & b).total()
    return both / (a.total() + b.total() - both) if a or b else 0.0


@dataclass
class ItemIndex:
    """Index of one bounded part of the benchmark, built on the driver and sent with the function."""

    radius: int
    similarity: float
    ids: list[int] = field(default_factory=list)
    shingles: list[Counter] = field(default_factory=list)
    codes: list[int] = field(default_factory=list)
    sizes: dict[int, dict[int, list[int]]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple[int, str]], radius: int, similarity: float) -> ItemIndex:
        index = cls(radius, similarity)
        for item_id, text in items:
            words = word_hashes(words_of(text))
            if not len(words):
                continue
            hashes = rolled(words, SHINGLE)
            # Items of fewer words than a shingle have one shingle of their own width.
            index.sizes.setdefault(min(SHINGLE, len(words)), {}).setdefault(len(hashes), []).append(len(index.ids))
            index.ids.append(item_id)
            index.shingles.append(Counter(hashes.tolist()))
            index.codes.append(weighted_simhash(hashes))
        return index

    def __post_init__(self) -> None:
        self._ready = False
        self._owners: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _prepare(self) -> None:
        codes = np.array(self.codes, np.uint64)
        flips = np.array([v.bit_count() for v in range(256)])
        near = flips[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= self.radius // BLOCKS
        self.code_array = codes
        blocks = codes.view(np.uint8).reshape(len(codes), BLOCKS)
        #: For each block and value: which items have the block within the flips that one block may differ by.
        self.table = [[np.flatnonzero(near[value][blocks[:, b]]) for value in range(256)] for b in range(BLOCKS)]
        #: Sorted shingles of the items of each width and size, and which slots those of a width fall in; size 0 has all.
        self.known, self.slots = {}, {}
        for width, sizes in self.sizes.items():
            self.slots[width] = np.zeros(SLOTS, bool)
            for count, of in sizes.items():
                known = np.unique(np.array([h for i in of for h in self.shingles[i]], np.uint64))
                self.slots[width][known & np.uint64(SLOTS - 1)] = True
                self.known[width, count] = known
            self.known[width, 0] = np.unique(np.concatenate([self.known[width, count] for count in sizes]))
        self._ready = True

    def near(self, code: int) -> list[int]:
        """Items whose SimHash is within the radius."""
        parts = np.array([code], np.uint64).view(np.uint8)
        found = np.unique(np.concatenate([self.table[b][parts[b]] for b in range(BLOCKS)]))
        return found[np.bitwise_count(self.code_array[found] ^ np.uint64(code)) <= self.radius].tolist()

    def sharing(self, width: int, count: int, hashes: np.ndarray) -> list[int]:
        """Items of a width and size that have any of the shingles."""
        if (width, count) not in self._owners:
            of = self.sizes[width][count]
            held = np.array([h for i in of for h in self.shingles[i]], np.uint64)
            owners = np.repeat(of, [len(self.shingles[i]) for i in of])
            order = np.argsort(held)
            self._owners[width, count] = held[order], owners[order]
        held, owners = self._owners[width, count]
        asked = np.unique(hashes)
        spans = zip(np.searchsorted(held, asked).tolist(), np.searchsorted(held, asked, "right").tolist())
        return np.unique(np.concatenate([owners[a:b] for a, b in spans])).tolist()

    def leaks(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item_id, similarity, first word, words) of the best window of each item found in the text."""
        if not self.ids:
            return []
        if not self._ready:
            self._prepare()
        words = word_hashes(words_of(text))
        best: dict[int, tuple[float, int, int]] = {}
        for width, sizes in self.sizes.items():
            # Without a shingle of the width, nothing is shared with its items.
            if len(words) < width:
                continue
            hashes = rolled(words, width)
            places = np.flatnonzero(self.slots[width][hashes & np.uint64(SLOTS - 1)])
            if not len(places):
                continue
            seen_hashes = hashes[places]
            every = self.known[width, 0]
            real = every[np.minimum(np.searchsorted(every, seen_hashes), len(every) - 1)] == seen_hashes
            if not real.any():
                continue
            places, seen_hashes = places[real], seen_hashes[real]
            for count in sizes:
                known = self.known[width, count]
                at = np.minimum(np.searchsorted(known, seen_hashes), len(known) - 1)
                own_places = places[known[at] == seen_hashes]
                # Overlap / (size + count - overlap) >= similarity needs at least this overlap; a window has count shingles.
                size = min(len(hashes), count)
                least = max(1, math.ceil(self.similarity * (size + count) / (1 + self.similarity) - 1e-9))
                if len(own_places) < least:
                    continue
                if size < count:
                    own = Counter(hashes.tolist())
                    for i in self.sharing(width, count, hashes):
                        score = weighted_jaccard(own, self.shingles[i])
                        if score >= self.similarity and score > best.get(i, (0.0,))[0]:
                            best[i] = (score, 0, len(words))
                    continue
                hit = np.zeros(len(hashes) + 1, np.int32)
                hit[own_places + 1] = 1
                seen = np.cumsum(hit)
                for at in np.flatnonzero(seen[count:] - seen[:-count] >= least).tolist():
                    window = hashes[at : at + count]
                    own = None
                    for i in self.near(weighted_simhash(window)):
                        own = own or Counter(window.tolist())
                        score = weighted_jaccard(own, self.shingles[i])
                        if score >= self.similarity and score > best.get(i, (0.0,))[0]:
                            best[i] = (score, at, count + width - 1)
        return [(self.ids[i], *found) for i, found in sorted(best.items())]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    radius: int = 20,
    part_bytes: int = 16 << 20,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the best window of each item in each document that leaks it.

    Words are split at ASCII white space, A-Z in lower case. The items travel to the tasks in parts of about
    ``part_bytes`` of text; a larger benchmark takes one pass over the documents for each part, so nothing of unbounded
    size is broadcast. Null or empty texts and items have no windows; repeated rows give repeated results; a null doc_id
    or item_id is reported as such; an empty table gives no rows; other columns are ignored.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("item_id", pa.int64()),
            ("similarity", pa.float64()),
            ("first_word", pa.int32()),
            ("n_words", pa.int32()),
        ]
    )
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long"), "text")
    found = None
    for part in range(parts):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        asked = sorted(((r.item_id, r.text) for r in chosen.collect()), key=lambda item: (str(item[0]), item[1]))
        index = ItemIndex.of(asked, radius, similarity)

        def scan(batch: pa.RecordBatch, index: ItemIndex = index) -> dict:
            rows = [
                (doc, *leak)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for leak in index.leaks(text)
            ]
            return {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}

        leaks = texts.mapInArrow(
            batches(scan, schema), "doc_id long, item_id long, similarity double, first_word int, n_words int"
        )
        found = leaks if found is None else found.unionByName(leaks)
    return found


def drop_leaking(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = 20) -> DataFrame:
    """``docs`` without the documents that leak an item; rows with a null doc_id stay, since no result can name them."""
    leaking = find_leaks(docs, benchmark, similarity, radius).where("doc_id is not null").select("doc_id").distinct()
    return docs.join(leaking, "doc_id", "left_anti").select(columns_of(docs))
