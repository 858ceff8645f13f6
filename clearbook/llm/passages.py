"""Repeated passages: paragraph MinHash banding with exact verification, and anchored windows for embedded passages.

Paragraphs are the lines of a text with at least ``least_words`` words. Equal paragraphs are one node. Each node has a
MinHash signature of its word shingles in ``bands`` bands of ``rows`` rows: with 8 x 3, two paragraphs of similarity 0.8
meet in some band with a probability of 99.7 %. Pairs of nodes that collide and have an exact Jaccard similarity of their
shingles of at least ``similarity`` are clustered by components, see ``similar``; no pair of a bucket is left out.

A passage can also stand inside different paragraphs. For these, each text has windows of ``window`` words: one at the
smallest shingle of every ``step`` shingles in a row, and one at the beginning and end of each paragraph. Texts that share
``window + step + 4`` words share a window, whatever stands around it. Equal windows are a class of their own.

In a class that occurs in several documents, the document with the smallest doc_id keeps its copy; the others lose theirs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import apart, back, batches, columns_of, keep, rolled, settled, word_hashes
from clearbook.llm.similar import similar_components

SHINGLE = 5
BANDS, ROWS = 8, 3
WINDOW, STEP, LEAST_WORDS = 32, 15, 50
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_RNG = np.random.default_rng(20240)
MULTIPLIERS = _RNG.integers(1, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)
UNITS = pa.schema(
    [
        ("node", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int32()),
        ("n_words", pa.int32()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def band_keys(shingles: np.ndarray) -> list[int]:
    """One key a band from the smallest of the shingles under ``BANDS * ROWS`` hash functions."""
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = MULTIPLIERS[:, None] * shingles[None, start : start + 4096]
        part ^= part >> np.uint64(29)
        least = np.minimum(least, part.min(axis=1))
    keys = rolled(least, 1).reshape(BANDS, ROWS)
    mixed = keys[:, 0]
    for row in range(1, ROWS):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + keys[:, row]
    return (mixed + np.arange(BANDS, dtype=np.uint64)).view(np.int64).tolist()


def anchors(shingles: np.ndarray, step: int) -> np.ndarray:
    """Places of the smallest value of every ``step`` in a row; of equal values the leftmost, so that runs stay sparse."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    step = min(step, len(shingles))
    views = np.lib.stride_tricks.sliding_window_view(shingles, step)
    return np.unique(views.argmin(axis=1) + np.arange(len(views)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def units_of(text: str | None, window: int, step: int, least_words: int) -> list[tuple[int, int, int, list[int] | None]]:
    """(node, first word, words, band keys) of the paragraphs of a text, and of its windows, which have no band keys."""
    if not text:
        return []
    lines = [line.split() for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]
    words = word_hashes([word for line in lines for word in line])
    if len(words) < min(window, least_words):
        return []
    shingles = rolled(words, SHINGLE)
    units, at, places = [], 0, anchors(shingles, step)
    edges = []
    for line in lines:
        if len(line) >= least_words:
            own = shingles[at : at + len(line) - SHINGLE + 1]
            node = _signed(xxhash.xxh3_64_intdigest(own.tobytes()))
            units.append((node, at, len(line), band_keys(own)))
        if len(line) >= window:
            edges += [at, at + len(line) - window]
        at += len(line)
    starts = np.unique(np.concatenate((places, edges)).astype(np.int64))
    starts = starts[starts <= len(words) - window]
    if len(starts):
        data = words.tobytes()
        for start in starts.tolist():
            node = _signed(xxhash.xxh3_64_intdigest(data[8 * start : 8 * (start + window)]))
            units.append((node, start, window, None))
    return units


def _units(docs: DataFrame, window: int, step: int, least_words: int) -> DataFrame:
    def cut(batch: pa.RecordBatch) -> dict:
        rows = [
            (node, doc, start, count, bands)
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for node, start, count, bands in units_of(text, window, step, least_words)
        ]
        return {name: [row[i] for row in rows] for i, name in enumerate(UNITS.names)}

    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), "text")
    kind = "node long, doc_id long, start int, n_words int, bands array<long>"
    return keep(texts.mapInArrow(batches(cut, UNITS), kind), "units")


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles: sorted distinct) of the paragraphs in ``wanted`` (node, doc_id, start, n_words)."""
    places = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("node", "start", "n_words")).alias("places"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(places, "doc_id").select("text", "places")
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def sets(batch: pa.RecordBatch) -> dict:
        nodes, out = [], []
        for text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower().split())
            for place in asked:
                own = rolled(words[place["start"] : place["start"] + place["n_words"]], SHINGLE)
                nodes.append(place["node"])
                out.append(np.unique(own).view(np.int64).tolist())
        return {"node": nodes, "shingles": out}

    made = texts.mapInArrow(batches(sets, schema), "node long, shingles array<long>")
    # Rows that repeat a doc_id with another text give other sets for a node; each pair is compared with all of them.
    return made.distinct()


def paragraph_classes(docs: DataFrame, paragraphs: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of paragraphs linked to another: root is the smallest node of the component."""
    nodes = paragraphs.groupBy("node").agg(
        F.min(F.struct("doc_id", "start", "n_words")).alias("place"), F.first("bands").alias("bands")
    )
    banded = nodes.select("node", F.explode("bands").alias("key"))

    def sets(asked: DataFrame) -> DataFrame:
        return _shingle_sets(docs, nodes.join(asked, "node").select("node", "place.*"))

    return similar_components(banded, sets, similarity)


def repeated_passages(
    docs: DataFrame,
    similarity: float = 0.8,
    least_words: int = LEAST_WORDS,
    window: int = WINDOW,
    step: int = STEP,
) -> DataFrame:
    """(doc_id, kept_doc_id, class_id, kind, first_word, n_words, node): every paragraph or window that another document keeps.

    Words are split at ASCII white space, A-Z in lower case; first_word counts from 0; node is the hash of what stands there. Null or empty texts, and rows with a
    null doc_id, have no passages. Rows that repeat a doc_id are one document: they never repeat each other. Other columns
    are ignored, and an empty table gives no rows.
    """
    units = _units(docs, window, step, least_words)
    paragraphs, windows = units.where("bands is not null"), units.where("bands is null").drop("bands")
    classes = settled(lambda: paragraph_classes(docs, paragraphs, similarity), "classes")
    sums = (F.min("doc_id").alias("kept_doc_id"), F.max("doc_id").alias("last"))
    of_node = paragraphs.groupBy("node").agg(*sums).join(classes, "node", "left")
    rooted = of_node.withColumn("root", F.coalesce("root", "node"))
    spread = (
        rooted.groupBy("root")
        .agg(F.min("kept_doc_id").alias("kept_doc_id"), F.max("last").alias("last"))
        .where("kept_doc_id <> last")
    )
    repeated = rooted.select("node", "root").join(spread, "root").select("node", F.col("root").alias("class_id"), "kept_doc_id")
    whole = paragraphs.drop("bands").join(repeated, "node").withColumn("kind", F.lit("paragraph"))
    twice = apart(windows, "node").agg(*sums).where("kept_doc_id <> last").select(back("node"), "kept_doc_id")
    parts = windows.join(twice, "node").withColumn("class_id", F.col("node")).withColumn("kind", F.lit("window"))
    columns = ["doc_id", "kept_doc_id", "class_id", "kind", F.col("start").alias("first_word"), "n_words", "node"]
    return whole.select(*columns).unionByName(parts.select(*columns)).where("doc_id <> kept_doc_id")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans (first, count); white space around a cut shrinks to one run."""
    data = text.encode("utf-8", "surrogatepass")
    places = [match.span() for match in _WORD.finditer(data)]
    merged: list[list[int]] = []
    for first, end in sorted((first, first + count) for first, count in spans):
        end = min(end, len(places))
        if first >= end:
            continue
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    out, at = [], 0
    for first, end in merged:
        start = places[first][0]
        out.append(data[at:start])
        at = places[end - 1][1]
        if start == 0 or data[start - 1 : start].isspace():
            following = places[end][0] if end < len(places) else len(data)
            gap = data[at:following]
            if b"\n" in gap and out[-1] and not out[-1].endswith(b"\n"):
                out[-1] = out[-1].rstrip(b" \t\x0b\x0c\r") + b"\n"
            at = following
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def standing(text: str | None, places: Iterable[Mapping]) -> list[tuple[int, int]]:
    """(first word, words) of the places whose text stands there: another row with this doc_id may have been meant."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower().split())
    found = []
    for place in places:
        first, count = place["first_word"], place["n_words"]
        own = words[first : first + count]
        if not place["is_window"]:
            own = rolled(own, SHINGLE)
        if first + count <= len(words) and _signed(xxhash.xxh3_64_intdigest(own.tobytes())) == place["node"]:
            found.append((first, count))
    return found


def drop_repeated(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, and ``n_chars``, where there is one, counted anew.

    Every row stays, with an empty text if nothing of it is left. Texts without repeated passages are unchanged. Of rows that
    repeat a doc_id each loses what stands in it.
    """
    def places() -> DataFrame:
        found = repeated_passages(docs, similarity).select("doc_id", "first_word", "n_words", "node", "kind").distinct()
        place = F.struct("first_word", "n_words", "node", (F.col("kind") == "window").alias("is_window"))
        return found.groupBy("doc_id").agg(F.collect_list(place).alias("__clearbook_spans"))

    spans = settled(places, "spans")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, standing(t, of)) for t, of in zip(texts, spans)], dtype=object)

    joined = docs.join(spans, "doc_id", "left")
    hit = joined.where("__clearbook_spans is not null").withColumn("text", cut("text", "__clearbook_spans"))
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.where("__clearbook_spans is null").select(columns_of(docs)).unionByName(hit.select(columns_of(docs)))
