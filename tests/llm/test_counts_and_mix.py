"""Token counts, the mix of sources, neighbours."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearbook.llm.mixing import mix, source_targets, word_count
from clearbook.llm.neighbours import chi_square_quantile, nearest
from tests.llm.helpers import docs, prose, words

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " \n\t\r ", "it's <|endoftext|>x<|startoftext|> 'RE é ́x", "z\x85q\x1cw  　y", "ΑΣ ΣΑΣ. ß İ ǅ",
    "日本語 テキスト 😀😀 \U0010ffff", "x" * 30000, "a1b22c 3.5% ...!?" * 50, prose(1, 3000),
]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    from clearbook.llm.token_counts import count_tokens

    rows = [*enumerate(TEXTS), (50, None), (None, "a b"), (7, "again")]
    found = count_tokens(docs(spark, rows, "n_bytes int, `a.b` int"), TOKENIZER, 5).collect()
    tool = Tokenizer.from_file(TOKENIZER)
    wanted = [(i, len((t or "").encode()), len(tool.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert count_tokens(docs(spark, rows).where("false"), TOKENIZER).collect() == []


def test_word_counter_forgets_and_counts_on(monkeypatch):
    from clearbook.llm import token_counts

    monkeypatch.setattr(token_counts, "CACHE_WORDS", 10)
    counter = token_counts.WordCounter({}, TOKENIZER)
    for start in range(0, 5):
        texts = [prose(start * 10 + i, 40) for i in range(3)] + TEXTS
        assert counter.count(texts) == token_counts.count_direct(texts, TOKENIZER)


def test_tasks_of_a_worker_share_a_counter():
    from clearbook.llm import token_counts

    made = []
    first = token_counts.worker_counter("job", TOKENIZER, lambda: made.append(1) or {"a": 1})
    assert token_counts.worker_counter("job", TOKENIZER, lambda: made.append(1) or {}) is first and made == [1]
    other = token_counts.worker_counter("next", TOKENIZER, lambda: {})
    assert other is not first and list(token_counts._COUNTERS) == ["next"]


def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, open_names, left = {}, set(names), sum(sizes.values())
    while open_names:
        level = left / sum(weight[n] for n in open_names)
        full = {n for n in open_names if level * weight[n] > epochs * sizes[n]}
        if not full:
            target |= {n: level * weight[n] for n in open_names}
            break
        for n in full:
            target[n] = epochs * sizes[n]
            left -= target[n]
        open_names -= full
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_resharing(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i}": int(rng.integers(0, 1000) ** (1 + i % 2)) for i in range(int(rng.integers(1, 12)))} | {None: 17}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(frame).collect()}
    wanted = brute_targets(sizes)
    assert found.keys() == wanted.keys()
    assert all(math.isclose(found[n], wanted[n], rel_tol=1e-9, abs_tol=1e-9) for n in wanted)


@pytest.mark.parametrize("bins", [1, 4, 4096])
def test_mix_is_the_sorted_prefix(spark, bins):
    rows = [(i, prose(i, 5 + 37 * i % 200), f"s{i % 4}") for i in range(200)]
    rows += [(300, None, "s1"), (301, "", None), (302, "a b", None), (302, "a b", None), (None, "c d e", "s2"), (303, "x", "S")]
    table = docs(spark, rows, "size int, taken int, `a.b` int")
    weights = [(i, 2.0) for i in range(0, 310, 3)] + [(3, 5.0), (None, 9.0), (4, None)]
    found = mix(table, spark.createDataFrame(weights, "doc_id long, weight double"), bins).collect()
    assert len(found) == len(rows)
    by_source = {}
    for r in found:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 3 * r.size
    import hashlib

    def key(r):
        u = (int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:12], 16) + 1) / 2**48
        weight = 2.0 if r.doc_id is not None and r.doc_id % 3 == 0 else 1.0
        return -math.log(u) / weight

    sizes = {s: sum(r.size for r in of) for s, of in by_source.items()}
    wanted = brute_targets(sizes)
    for source, of in by_source.items():
        assert all(r.source_size == sizes[source] and math.isclose(r.target, wanted[source]) for r in of)
        whole, budget = divmod(math.floor(wanted[source]), sizes[source]) if sizes[source] else (0, 0)
        assert sum(r.taken for r in of) == math.floor(wanted[source])
        for r in sorted(of, key=lambda r: (key(r), r.doc_id is not None, r.doc_id or 0, r.size)):
            part = min(r.size, budget)
            budget -= part
            assert r.taken == whole * r.size + part
    assert sorted(map(tuple, mix(table, bins=bins).collect()), key=str) == sorted(map(tuple, mix(table, bins=bins).collect()), key=str)
    assert mix(table.where("false")).collect() == []


def test_word_count(spark):
    texts = [*TEXTS, "\x01 \x01a\x0b\x0cb", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = {r.i: r.n for r in frame.select("i", word_count(F.col("text")).alias("n")).collect()}
    assert found == {i: len(words(t)) for i, t in enumerate(texts)}


def test_chi_square_quantile():
    assert math.isclose(chi_square_quantile(0.95, 8), 15.507, abs_tol=1e-3)
    assert math.isclose(chi_square_quantile(0.5, 2), 2 * math.log(2), abs_tol=1e-6)


@pytest.mark.parametrize("shard_rows, block_rows", [(65536, 4096), (150, 7)])
def test_neighbours_against_brute_force(spark, shard_rows, block_rows):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((12, 16))
    vectors = (base[rng.integers(0, 12, 900)] + 0.3 * rng.standard_normal((900, 16))) * rng.uniform(0.5, 2, (900, 1))
    vectors[100:400] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(900, None), (920, [0.0] * 16), (940, [math.nan] + [1.0] * 15), (960, [None] + [1.0] * 15), (980, [math.inf] * 16)]
    odd = [(None, vectors[0].tolist()), (20, rows[20][1]), (1000, [1.0, 2.0]), (1001, [2.0, 1.0])]
    table = spark.createDataFrame(rows + bad + odd, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    found = nearest(table, F.col("vec_id") % 20 == 0, 20, 0.9, shard_rows, block_rows).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = 0
    for q in range(0, 900, 20):
        scores = vectors @ vectors[q]
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-round(scores[i], 9), i))[:20]
        got = sorted(by_query[q])
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(math.isclose(s, scores[v], rel_tol=1e-12) for _, v, s in got)
        assert got == sorted(got, key=lambda g: (-g[2], g[1]))
        hit += len({g[1] for g in got} & set(order))
    assert hit >= 0.95 * 45 * 20
    assert by_query.keys() == {*range(0, 900, 20), 1000} and [g[1] for g in by_query[1000]] == [1001]
    assert nearest(table.where("false"), F.lit(True)).collect() == []


def test_recall_on_the_sample_table(spark):
    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("sample tables not present")
    table = spark.read.parquet(f"{path}/embeddings.parquet")
    rows = table.collect()
    vectors = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    found = {}
    for r in nearest(table, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hit, total = hit + len(best & found[int(ids[q])]), total + 20
    assert hit / total >= 0.9
