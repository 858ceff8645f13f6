"""Token counts of texts: a broadcast table of frequent words in front of a cache in every worker.

The tokenizer's normalizer and pre-tokenizer never join or look across the white space used here to split, so the tokens of
a text are those of its words. One pass over all texts counts words in each task, keeps those that are frequent there
(space-saving: rare words are dropped whenever a task has seen many) and adds up what the tasks kept; the most frequent
become a table word -> tokens of fixed size, sent to all tasks. A word that is not in it is encoded by the worker that meets it,
once, and kept in that worker's cache. No word of a text is ever shuffled; the table only saves work, so a count never
depends on what it holds.
"""

from __future__ import annotations

import functools
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clearbook.llm.shared import batches

#: Words longer than this are encoded each time: they rarely come again, and would fill the caches.
LONGEST = 64
CACHE_WORDS = 400_000


@functools.cache
def _tokenizer(path: str) -> Tokenizer:
    """The tokenizer of this process, without truncation and padding."""
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def count_direct(texts: list[str], path: str) -> list[int]:
    return [len(e.ids) for e in _tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def split_words(text: str | None) -> list[str]:
    """Pieces of a text between blanks and line ends; some are empty. Other white space stays within a piece."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if text else []


class WordCounter:
    """Tokens of texts by table, then cache, then tokenizer; table and cache are one mapping, of which the table stays."""

    def __init__(self, table: dict[str, int], path: str) -> None:
        self.table, self.path = table | {"": 0}, path
        self.known = dict(self.table)

    def count(self, texts: list[str | None]) -> list[int]:
        if len(self.known) > len(self.table) + CACHE_WORDS:
            self.known = dict(self.table)
        look = self.known.__getitem__
        words = [split_words(text) for text in texts]
        totals, waiting = [0] * len(words), []
        for i, own in enumerate(words):
            try:
                totals[i] = sum(map(look, own))
            except KeyError:
                waiting.append(i)
        fresh = list({word for i in waiting for word in words[i]} - self.known.keys())
        found = dict(zip(fresh, count_direct(fresh, self.path)))
        self.known.update((word, n) for word, n in found.items() if len(word) <= LONGEST)
        for i in waiting:
            totals[i] = sum(found[word] if word in found else look(word) for word in words[i])
        return totals


_COUNTERS: dict[str, WordCounter] = {}


def worker_counter(key: str, path: str, table: Callable[[], dict[str, int]]) -> WordCounter:
    """The counter of this worker process for one job: the tasks that it runs one after the other share what it knows."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = WordCounter(table(), path)
    return _COUNTERS[key]


def frequent_words(texts: DataFrame, words: int, per_task: int = 4096) -> list[str]:
    """The ``words`` most frequent words of all ``texts`` (text), from at most ``per_task`` words of each task."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def local(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in stream:
            for start in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(start, 256).to_pylist():
                    seen.update(split_words(text))
                if len(seen) > 16 * per_task:
                    seen = Counter(dict(seen.most_common(4 * per_task)))
        top = [(w, n) for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if 0 < len(w) <= LONGEST][:per_task]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], schema=schema
        )

    parts = texts.select("text").mapInArrow(local, "word string, n long")
    top = parts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return [r.word for r in top.collect()]


def count_tokens(docs: DataFrame, path: str, table_words: int = 20_000) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text).

    ``path`` is a tokenizer file at the same place on every machine. Whole texts are counted, without begin, end or added
    special tokens; special strings in a text count as the library has them by default. A null text counts as empty, an
    empty one has no bytes and tokens; repeated rows stay; other columns are ignored.
    """
    names = frequent_words(docs.where("text is not null"), table_words)
    table = dict(zip(names, count_direct(names, path))) if names else {}
    sent = docs.sparkSession.sparkContext.broadcast(table)
    key = uuid.uuid4().hex
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batch: pa.RecordBatch) -> dict:
        counter = worker_counter(key, path, lambda: sent.value)
        texts = batch.column(2).to_pylist()
        return {"doc_id": batch.column(0), "n_bytes": batch.column(1), "n_tokens": counter.count(texts)}

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("long"), size, "text")
    return rows.mapInArrow(batches(count, schema), "doc_id long, n_bytes long, n_tokens long")
