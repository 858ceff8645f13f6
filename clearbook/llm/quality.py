"""Quality classifier by compression: zstandard dictionaries of good and of bad text, and the difference they make.

Two dictionaries are built from labelled texts. A text is compressed in pieces with each of them; the difference of the
two sizes, over their sum, says which kind of text it is more like; the logarithm of the compressed share of the text tells
text that repeats itself, which both dictionaries shrink alike. A logistic curve fitted on labelled rows that the
dictionaries have not seen turns the two into a probability that the label is 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import batches

LEVEL = 3
#: Bytes of a text that are compressed at once: small, so that the dictionary and not the text itself is what is matched.
PIECE = 1024


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and curve; a few hundred kilobytes, sent to the tasks with the function."""

    good: bytes
    bad: bytes
    center: tuple[float, float]
    slope: tuple[float, float]
    offset: float


def _tools(model: QualityModel) -> list[zstandard.ZstdCompressor]:
    """Compressors of this process, kept for all batches of a model."""
    if _tools.__dict__.get("model") != model:
        kinds = [zstandard.ZstdCompressionDict(data) for data in (model.good, model.bad)]
        for kind in kinds:
            kind.precompute_compress(level=LEVEL)
        made = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=kind, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            for kind in kinds
        ]
        _tools.__dict__.update(model=model, made=made)
    return _tools.__dict__["made"]


def shrinkage(text: str | None, model: QualityModel) -> tuple[float, float]:
    """Of the whole text: (bad - good) / (bad + good) of the compressed sizes, and the log of their share of the text.

    A null or empty text is at the center of the model.
    """
    data = text.encode("utf-8", "surrogatepass") if text else b""
    if not data:
        return model.center
    good, bad = (
        sum(len(tool.compress(data[i : i + PIECE])) for i in range(0, len(data), PIECE)) for tool in _tools(model)
    )
    return (bad - good) / (good + bad), math.log((good + bad) / (2 * len(data)))


def probabilities(texts: list[str | None], model: QualityModel) -> np.ndarray:
    raw = np.array([shrinkage(t, model) for t in texts], float).reshape(-1, 2)
    at = (raw - model.center) @ np.array(model.slope) + model.offset
    return 1 / (1 + np.exp(-np.clip(at, -35, 35)))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, piece: int) -> list:
    """Up to ``rows`` labelled texts a class, in the order of a hash of doc_id, each cut to pieces of at most ``piece``.

    The sample bounds what the driver reads: ``rows`` x 2 classes x ``piece`` characters. A doc_id with several labels
    takes the smallest; labels other than 0 and 1, null texts and null ids teach nothing.
    """
    marks = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    order = F.xxhash64("doc_id")
    chosen = None
    for label in (0, 1):
        some = marks.where(F.col("label") == label).orderBy(order, "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    size = F.length("text")
    # Of a longer text, the part that is read starts at a place given by its id.
    start = F.pmod(order, F.greatest(F.lit(1), size - piece)) + 1
    part = F.substring(F.col("text"), F.when(size > piece, start).otherwise(F.lit(1)).cast("int"), F.lit(piece))
    picked = texts.select("doc_id", "label", part.alias("part"))
    return sorted((r.doc_id, r.label, r.part) for r in picked.collect())


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = 3000, piece: int = 2000, dictionary: int = 64 * 1024
) -> QualityModel:
    """Dictionaries from half of the sample, the curve from the other half."""
    sample = training_rows(docs, labels, rows, piece)
    taught = [r for i, r in enumerate(sample) if i % 2 == 0]
    made = [_dictionary([t for _, y, t in taught if y == label], dictionary) for label in (1, 0)]
    bare = QualityModel(made[0], made[1], (0.0, 0.0), (0.0, 0.0), 0.0)
    rest = [r for i, r in enumerate(sample) if i % 2]
    x = np.array([shrinkage(t, bare) for _, _, t in rest], float).reshape(-1, 2)
    y = np.array([label for _, label, _ in rest], float)
    share = labels.where("quality in (0, 1)").agg(F.avg("quality")).first()[0]
    return QualityModel(made[0], made[1], *_curve(x, y, 0.5 if share is None else share))


def _dictionary(texts: list[str], size: int) -> bytes:
    """A raw-content dictionary is used where the library's trainer finds too little text."""
    samples = [data for t in texts if (data := t.encode("utf-8", "surrogatepass"))]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b"\n" * 8


def _curve(x: np.ndarray, y: np.ndarray, share: float) -> tuple[tuple[float, float], tuple[float, float], float]:
    """Center, slopes and offset of a ridge logistic regression of y on x, by Newton steps.

    Rows are weighted so that label 1 has the ``share`` it has among all labels.
    """
    share = min(max(share, 0.001), 0.999)
    ones = y.sum()
    if ones in (0, len(y)):
        return (0.0, 0.0), (0.0, 0.0), math.log(share / (1 - share))
    weight = np.where(y == 1, share / ones, (1 - share) / (len(y) - ones)) * len(y)
    center = np.average(x, axis=0, weights=weight)
    scale = x.std(axis=0) + 1e-9
    design = np.column_stack(((x - center) / scale, np.ones(len(x))))
    ridge = np.array((0.5, 0.5, 1e-6))
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -35, 35)))
        bend = (design.T * (weight * p * (1 - p))) @ design + np.diag(ridge)
        step = np.linalg.solve(bend, design.T @ (weight * (y - p)) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = beta[:2] / scale
    return (float(center[0]), float(center[1])), (float(slopes[0]), float(slopes[1])), float(beta[2])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` (text and any other columns) with ``quality_score``: 0 to 1, higher where label 1 is likelier.

    The whole text counts. Null and empty texts get the score at the center of the model. Repeated rows stay. A column of
    that name is replaced.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(probabilities(texts.tolist(), model))

    return docs.drop("quality_score").withColumn("quality_score", score("text"))


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, quality_score) only, so that no text comes back from Python."""
    schema = pa.schema([("doc_id", pa.int64()), ("quality_score", pa.float64())])

    def score(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "quality_score": probabilities(batch.column(1).to_pylist(), model)}

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        batches(score, schema), "doc_id long, quality_score double"
    )
