"""Helpers the operators share: written intermediate tables, words of a text, typed Arrow output."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, GroupedData, Observation, SparkSession
from pyspark.sql import functions as F

from clearbook.session import shared_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/clearbook-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_counted(df: DataFrame, name: str, which: Column | None = None) -> tuple[DataFrame, int]:
    """``keep``, and the number of its rows, or of those ``which`` holds for: counted while they are written, by no job more."""
    seen = Observation()
    table = keep(df.observe(seen, F.count_if(F.lit(True) if which is None else which).alias("n")), name)
    return table, seen.get["n"]


#: Folders written by ``keep`` in each of the open calls of ``settled``, the innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def settled(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` gives, as a written table; every other table that is kept on the way is removed."""
    outer, made = _scopes.get(), []
    _scopes.set((*outer, made))
    try:
        frame = build()
    finally:
        _scopes.set(outer)
    table = keep(frame, name)
    for path in made:
        _remove(frame.sparkSession, path)
    return table


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_kept(df: DataFrame) -> None:
    """Remove the files of a table written by ``keep`` that no later step reads."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of a table, whatever their names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def apart(df: DataFrame, key: str) -> GroupedData:
    """Rows grouped by the complement of a long ``key``, called ``_apart``; ``back(key)`` turns it into the key again.

    A join by the key then deals both of its sides anew instead of taking over the partitions of the grouped side, and so
    adaptive execution may split a key with very many rows.
    """
    return df.groupBy(F.bitwise_not(F.col(key)).alias("_apart"))


def back(key: str) -> Column:
    return F.bitwise_not(F.col("_apart")).alias(key)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, split at space and \\x09-\\x0D only, with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by a space; fewer words give the whole sequence, none give nothing."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - size + 1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def batches(
    function: Callable[[pa.RecordBatch], dict], schema: pa.Schema, rows: int = 512
) -> Callable[[Iterator], Iterator]:
    """An Arrow batch function for ``mapInArrow`` out of one that turns a batch into columns.

    A batch is worked on in slices of ``rows``, so that memory follows the longest texts and not the size of a batch.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, rows):
                columns = function(batch.slice(start, rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[field.name], type=field.type) for field in schema], schema=schema
                )

    return run


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A mixed hash of each run of ``size`` values; a shorter sequence gives one hash of all of it."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(32))
