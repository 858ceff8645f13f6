"""Line deduplication: lines that many documents share are dropped everywhere.

Each line is normalised to a key, hashed to 128 bits, and the distinct documents of every hash are counted. The hashes over
the threshold are dropped from the texts by position. Only hashes are shuffled for the count, first by hash and document, so
that a very common line is spread. The hashes to drop go to every task while there are at most ``broadcast_keys`` of them;
more are joined to the lines' hashes, the commonest by broadcast and the rest by shuffle, and each text then meets the
positions of its own dropped lines. Both ways give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import batches, keep

SPACE = b" \t\n\x0b\x0c\r"
#: Hashes of 16 bytes that are sent to every task at most: 4 MB.
BROADCAST_KEYS = 1 << 18
_HASHES = "doc_id long, text_hash long, high long, low long"


def line_keys(text: str | None) -> list[bytes]:
    """The key of each line: split at \\n only, no ASCII white space at its ends, A-Z in lower case. None has one empty line."""
    return [line.strip(SPACE) for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]


def _long_enough(key: bytes, least_chars: int) -> bool:
    if len(key) < least_chars:
        return False
    return least_chars <= 1 or len(key) - sum(byte & 0xC0 == 0x80 for byte in key) >= least_chars


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _text_hash(text: str | None) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest((text or "").encode("utf-8", "surrogatepass")), "big", signed=True)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, text_hash, high, low): the distinct keys of each row's lines, as two halves of their hash."""
    schema = pa.schema([(name, pa.int64()) for name in ("doc_id", "text_hash", "high", "low")])

    def cut(batch: pa.RecordBatch) -> dict:
        docs, texts, found, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], []
        for text in texts:
            own = {_hash(key) for key in set(line_keys(text)) if _long_enough(key, least_chars)}
            found.extend(own)
            counts.append(len(own))
        halves = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, 2)
        rows = np.repeat(np.arange(len(texts)), counts)
        marks = np.array([_text_hash(text) for text in texts], np.int64)
        return {
            "doc_id": pa.array(docs, pa.int64()).take(pa.array(rows)),
            "text_hash": marks[rows],
            "high": halves[:, 0],
            "low": halves[:, 1],
        }

    return _texts(docs).mapInArrow(batches(cut, schema), _HASHES)


def common_lines(hashes: DataFrame, least_docs: int) -> DataFrame:
    """(high, low, n_docs) of the hashes that at least ``least_docs`` distinct documents have."""
    # Rows without a doc_id count as one document.
    once = hashes.select("high", "low", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"))
    counted = once.groupBy("high", "low").agg(F.count_distinct("doc_id").alias("n_docs"))
    return counted.where(F.col("n_docs") >= least_docs)


def _cut(text: str | None, dropped) -> tuple[str, int, int]:
    """(kept text, lines, dropped lines); ``dropped`` says of a list of keys which of them go."""
    lines = (text or "").split("\n")
    gone = dropped(line_keys(text))
    kept = [line for line, out in zip(lines, gone) if not out]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])
_OUT_SQL = "doc_id long, text string, n_lines long, n_dropped long"


def drop_common_lines(
    docs: DataFrame, least_docs: int = 10, least_chars: int = 1, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row of ``docs`` (doc_id, text), without the lines that are common.

    A line's key is the line without ASCII white space at its ends, with A-Z in lower case. Lines whose key has at least
    ``least_chars`` code points and stands in at least ``least_docs`` documents go, all of them; other lines stay as they
    are, joined by \\n. Null and empty texts have one empty line. Rows that repeat a doc_id are one document in the count and
    rows without a doc_id together another; each row keeps its own text. Other columns are ignored; an empty table gives no
    rows.
    """
    hashes = line_hashes(docs, least_chars)
    common = keep(common_lines(hashes, least_docs), "lines")
    schema = _OUT

    def columns(batch: pa.RecordBatch, kept: list[tuple[str, int, int]]) -> dict:
        texts, lines, gone = zip(*kept) if kept else ((), (), ())
        return {"doc_id": batch.column(0), "text": texts, "n_lines": lines, "n_dropped": gone}

    if common.count() <= broadcast_keys:
        table = common.select("high", "low").toArrow()
        halves = np.stack([table.column(i).to_numpy() for i in range(2)], axis=1).astype(">i8")
        sent = docs.sparkSession.sparkContext.broadcast(frozenset(row.tobytes() for row in halves))

        def cut(batch: pa.RecordBatch) -> dict:
            out = sent.value
            return columns(
                batch,
                [
                    _cut(text, lambda keys: [_long_enough(k, least_chars) and _hash(k) in out for k in keys])
                    for text in batch.column(1).to_pylist()
                ],
            )

        return _texts(docs).mapInArrow(batches(cut, schema), _OUT_SQL)

    # The commonest keys, whose lines would crowd a partition, are few enough for a broadcast.
    hot = common.orderBy(F.desc("n_docs"), "high", "low").limit(max(1, broadcast_keys // 16))
    hot = keep(hot.select("high", "low"), "hot")
    rest = common.select("high", "low").join(F.broadcast(hot), ["high", "low"], "left_anti")
    own = ["doc_id", "text_hash", "high", "low"]
    met = hashes.join(F.broadcast(hot), ["high", "low"]).select(own).unionByName(hashes.join(rest, ["high", "low"]).select(own))
    by_text = met.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("high", "low")).alias("gone"))
    by_text = by_text.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_mark"), "gone")

    @F.udf("long", useArrow=True)
    def mark(text: str | None) -> int:
        return _text_hash(text)

    marked = _texts(docs).withColumn("_text", mark("text"))
    joined = marked.join(by_text, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_mark")), "left")

    def cut_own(batch: pa.RecordBatch) -> dict:
        kept = []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            out = {b"".join(x.to_bytes(8, "big", signed=True) for x in pair.values()) for pair in gone or ()}
            kept.append(_cut(text, lambda keys: [_long_enough(k, least_chars) and _hash(k) in out for k in keys]))
        return columns(batch, kept)

    return joined.select("doc_id", "text", "gone").mapInArrow(batches(cut_own, schema), _OUT_SQL)
