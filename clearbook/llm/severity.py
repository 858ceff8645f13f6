"""Toxicity as ordered grades: cumulative-link (proportional odds) regression on the words of a text.

P(grade > k) = sigmoid(score - threshold_k): one weight per word, shared by all thresholds, and thresholds in ascending
order. The expected severity is the sum of these probabilities over k. The words, and beginnings of words, are those that
tell toxic from other labelled texts significantly; one counts by log(1 + occurrences).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import batches, keep

#: Letters of a word's beginnings that count as features of their own, for words the labels do not have.
STEMS = (3, 4, 5)
#: Words that a worker remembers before it begins anew.
CACHE_WORDS = 300_000
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class SeverityModel:
    """Weights of at most ``most_words`` words and the thresholds between grades; sent with the function."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]


def features_of(word: str) -> list[str]:
    """The word itself, and its first letters with a star where it is longer."""
    return [word, *[word[:size] + "*" for size in STEMS if len(word) > size]]


def word_counts(text: str | None) -> Counter:
    """Features of the runs of letters in lower case, with their number."""
    found: Counter = Counter()
    for word, n in Counter(_WORDS.findall(text.lower()) if text else ()).items():
        for feature in features_of(word):
            found[feature] += n
    return found


class Scorer:
    """Scores of texts. What the words of earlier texts are worth is remembered; most are worth nothing."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.known: set[str] = set()
        self.worth: dict[str, list[str]] = {}

    def score(self, text: str | None) -> float:
        words = _WORDS.findall(text.lower()) if text else []
        if not self.known.issuperset(words):
            if len(self.known) > CACHE_WORDS:
                self.known, self.worth = set(), {}
            fresh = set(words) - self.known
            for word in fresh:
                if own := [feature for feature in features_of(word) if feature in self.weights]:
                    self.worth[word] = own
            self.known |= fresh
        found: Counter = Counter()
        for word, n in Counter(filter(self.worth.__contains__, words)).items():
            for feature in self.worth[word]:
                found[feature] += n
        return sum(self.weights[feature] * np.log1p(n) for feature, n in sorted(found.items()))


def training_words(docs: DataFrame, grades: DataFrame, rows: int) -> DataFrame:
    """(doc_id, grade, words, counts) of up to ``rows`` graded and as many ungraded (0) texts, by a hash of doc_id.

    A doc_id with several grades takes the largest; null grades and ids teach nothing.
    """
    marks = grades.where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    parts = [marks.where(rule).orderBy(*order).limit(rows) for rule in ("grade > 0", "grade = 0")]
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    chosen = texts.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select("doc_id", "grade", "text")
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("grade", pa.int32()),
            ("words", pa.list_(pa.string())),
            ("counts", pa.list_(pa.int64())),
        ]
    )

    def count(batch: pa.RecordBatch) -> dict:
        counted = [word_counts(t) for t in batch.column(2).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "grade": batch.column(1).cast(pa.int32()),
            "words": [list(c) for c in counted],
            "counts": [list(c.values()) for c in counted],
        }

    counted = chosen.mapInArrow(
        batches(count, schema, 64), "doc_id long, grade int, words array<string>, counts array<long>"
    )
    # Read by several steps of the fit: written once, so that the documents are scanned once.
    return keep(counted, "words")


def telling_words(table: DataFrame, least_texts: int = 5, least_z: float = 5.0, most_words: int = 20_000) -> list[str]:
    """Words in a larger share of graded texts than of others, by ``least_z`` standard errors; most telling first."""
    toxic, clean = (table.where(rule).count() for rule in ("grade > 0", "grade = 0"))
    if not toxic or not clean:
        return []
    seen = table.select(F.explode("words").alias("word"), (F.col("grade") > 0).cast("int").alias("bad")).groupBy("word")
    shares = seen.agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).where(F.col("n") >= least_texts)
    both = F.col("n") / (toxic + clean)
    error = F.sqrt(both * (1 - both) * (1 / toxic + 1 / clean) + 1e-12)
    z = (F.col("bad") / toxic - (F.col("n") - F.col("bad")) / clean) / error
    top = shares.select("word", z.alias("z")).where(F.col("z") >= least_z).orderBy(F.desc("z"), "word").limit(most_words)
    return [r.word for r in top.collect()]


def fit(
    docs: DataFrame, grades: DataFrame, rows: int = 5000, steps: int = 400, share: float | None = None
) -> SeverityModel:
    """Model from a bounded sample of graded rows (doc_id, grade: 0, 1, 2, ...); see ``training_words``.

    ``share`` is that of grades above 0 among all texts, where ``grades`` is not drawn evenly from them.
    """
    table = training_words(docs, grades, rows)
    vocabulary = telling_words(table)
    at = {word: i for i, word in enumerate(vocabulary)}
    schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])

    def narrow(batch: pa.RecordBatch) -> dict:
        pairs = [
            [(at[w], n) for w, n in zip(words, counts) if w in at]
            for words, counts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        return {
            "doc_id": batch.column(0),
            "grade": batch.column(1),
            "at": [[i for i, _ in p] for p in pairs],
            "n": [[n for _, n in p] for p in pairs],
        }

    sample = sorted(
        (r.doc_id, r.grade, r.at, r.n)
        for r in table.mapInArrow(batches(narrow, schema), "doc_id long, grade int, at array<int>, n array<long>").collect()
    )
    shares = {r.grade: r["count"] for r in grades.where("grade is not null").groupBy("grade").count().collect()}
    toxic = sum(n for g, n in shares.items() if g > 0)
    if share is not None and 0 < toxic < sum(shares.values()):
        clean = sum(shares.values()) - toxic
        shares = {g: n * (share / toxic if g > 0 else (1 - share) / clean) for g, n in shares.items()}
    weights, thresholds = _cumulative_link([r[1:] for r in sample], len(vocabulary), shares, steps)
    return SeverityModel(dict(zip(vocabulary, weights.tolist())), thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _cumulative_link(
    rows: list[tuple[int, list[int], list[int]]], words: int, shares: dict[int, float], steps: int, ridge: float = 1e-5
) -> tuple[np.ndarray, tuple[float, ...]]:
    """Weights and ascending thresholds by Adam on the mean log-likelihood; rows count by the share of their grade."""
    grades = sorted(shares)
    top = max(grades, default=0)
    if not rows or not top:
        return np.zeros(words), tuple(5.0 for _ in range(top))
    y = np.array([g for g, _, _ in rows])
    seen = np.bincount(y, minlength=top + 1)
    total = sum(shares.values())
    weight = np.array([shares.get(g, 0) / total / seen[g] for g in y])
    row = np.repeat(np.arange(len(rows)), [len(i) for _, i, _ in rows])
    col = np.array([i for _, at, _ in rows for i in at], np.int64)
    value = np.log1p(np.array([n for _, _, ns in rows for n in ns], float))
    # Thresholds are a first one and the logs of the gaps, so that they stay in order.
    share_above = [max(1e-4, sum(shares.get(g, 0) for g in range(k + 1, top + 1)) / total) for k in range(top)]
    start = np.log((1 - np.array(share_above)) / np.array(share_above))
    gaps = np.maximum(np.diff(start), 0.1)
    params = np.concatenate((np.zeros(words), [start[0]], np.log(gaps)))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        beta, first, logs = params[:words], params[words], params[words + 1 :]
        theta = first + np.concatenate(([0.0], np.cumsum(np.exp(logs))))
        score = np.bincount(row, value * beta[col], len(rows)) if words else np.zeros(len(rows))
        above = np.concatenate((np.ones((len(rows), 1)), _sigmoid(score[:, None] - theta), np.zeros((len(rows), 1))), axis=1)
        slope = above * (1 - above)
        at = np.arange(len(rows))
        chance = np.maximum(above[at, y] - above[at, y + 1], 1e-9)
        d_score = weight * (slope[at, y] - slope[at, y + 1]) / chance
        d_theta = np.zeros(top)
        np.add.at(d_theta, y[y > 0] - 1, -(weight * slope[at, y] / chance)[y > 0])
        np.add.at(d_theta, y[y < top], (weight * slope[at, y + 1] / chance)[y < top])
        d_beta = np.bincount(col, value * d_score[row], words) - ridge * beta if words else np.zeros(0)
        tail = np.cumsum(d_theta[::-1])[::-1]
        gradient = np.concatenate((d_beta, [tail[0]], tail[1:] * np.exp(logs)))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        params = params + 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    theta = params[words] + np.concatenate(([0.0], np.cumsum(np.exp(params[words + 1 :]))))
    return params[:words], tuple(theta.tolist())


def score_severity(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """(doc_id, expected_severity, severity, toxic) for every row of ``docs`` (doc_id, text).

    severity is the likeliest grade, toxic whether a grade above 0 is at least as likely as not. The whole text counts;
    null and empty texts have no words and the severity of such a text. Repeated rows stay; other columns are ignored.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("expected_severity", pa.float64()), ("severity", pa.int32()), ("toxic", pa.bool_())]
    )
    theta = np.array(model.thresholds)
    scorer = Scorer(model.weights)

    def score(batch: pa.RecordBatch) -> dict:
        sums = [scorer.score(text) for text in batch.column(1).to_pylist()]
        above = _sigmoid(np.array(sums, float)[:, None] - theta)
        edges = np.concatenate((np.ones((len(sums), 1)), above, np.zeros((len(sums), 1))), axis=1)
        return {
            "doc_id": batch.column(0),
            "expected_severity": above.sum(axis=1),
            "severity": (edges[:, :-1] - edges[:, 1:]).argmax(axis=1).astype(np.int32),
            "toxic": above[:, 0] >= 0.5 if len(theta) else np.zeros(len(sums), bool),
        }

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        batches(score, schema), "doc_id long, expected_severity double, severity int, toxic boolean"
    )


def graded(docs: DataFrame, labels: DataFrame, rows: int = 5000, levels: int = 3) -> DataFrame:
    """(doc_id, grade) from labels that only say toxic or not: toxic texts are graded 1 to ``levels`` by how much of the
    words that tell toxic texts they hold, in about equal parts; other labelled texts have grade 0.
    """
    yes_no = labels.select("doc_id", F.col("toxic").cast("int").alias("grade"))
    table = training_words(docs, yes_no, rows)
    telling = table.sparkSession.createDataFrame([(w,) for w in telling_words(table)], "word string")
    listed = table.where("grade > 0").select("doc_id", F.explode(F.arrays_zip("words", "counts")).alias("pair"))
    counted = listed.select("doc_id", F.col("pair.words").alias("word"), F.col("pair.counts").alias("n"))
    held = counted.join(F.broadcast(telling), "word").groupBy("doc_id").agg(F.sum(F.log1p("n")).alias("amount"))
    toxic = table.where("grade > 0").select("doc_id").join(held, "doc_id", "left").fillna(0.0, "amount")
    cuts = toxic.agg(F.percentile_approx("amount", [i / levels for i in range(1, levels)], 10_000)).first()[0] or []
    grade = F.lit(1)
    for cut in cuts:
        grade = grade + (F.col("amount") > cut).cast("int")
    clean = table.where("grade = 0").select("doc_id", F.lit(0).alias("grade"))
    return toxic.select("doc_id", grade.alias("grade")).unionByName(clean)
