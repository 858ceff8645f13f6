from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearbook.llm.components import components
from clearbook.llm.simhash_dedup import (
    bk_links, block_choices, code_components, drop_near_copies, fingerprint, links, simhash_components, tile_links,
)
from tests.llm.helpers import docs, groups, prose, simhash

EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "ONE two"), (7, "a b c d"), (7, "a b c d"),
    (8, "A B C D"), (9, "ÉTÉ été É"), (None, "a b c d"), (10, "x " * 30000),
]


def test_fingerprint_equals_bit_counts():
    for text in [t for _, t in EDGES] + [prose(i) for i in range(5)]:
        assert fingerprint(text) & (2**64 - 1) == simhash(text)


def test_components_of_a_long_path(spark):
    path = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components(path).collect()} == {(n, 0) for n in range(61)}
    assert components(path.where("a < 0")).collect() == []


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_bk_tree_and_tiles_find_all_links(radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(20)]
    codes = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for b in base for _ in range(12)})
    wanted = groups(codes, lambda a, b: (a ^ b).bit_count() <= radius)
    for found in (bk_links(codes, radius), tile_links(*[np.array(codes, np.uint64)] * 2, radius)):
        pairs = {(min(a & (2**64 - 1), b & (2**64 - 1)), max(a & (2**64 - 1), b & (2**64 - 1))) for a, b in found}
        assert groups(codes, lambda a, b: (min(a, b), max(a, b)) in pairs) == wanted


@pytest.mark.parametrize("radius, agree, shard_rows", [(2, 2, 512), (2, 2, 3), (6, 3, 512), (6, 3, 4)])
def test_links_in_small_and_dense_shards(spark, radius, agree, shard_rows):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(6)]
    codes = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for b in base for _ in range(15)}
    signed = sorted(c - (1 << 64) if c >> 63 else c for c in codes)
    frame = spark.createDataFrame([(c,) for c in signed], "code long")
    found = {(min(r), max(r)) for r in links(frame, radius, agree, shard_rows).collect()}
    wanted = groups(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
    assert groups(signed, lambda a, b: (min(a, b), max(a, b)) in found) == wanted


@pytest.mark.parametrize("radius, agree, shard_rows", [(2, 2, 512), (6, 3, 512), (6, 3, 4), (5, 2, 16)])
def test_components_of_codes_in_two_rounds(spark, radius, agree, shard_rows):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(8)]
    codes = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1) for b in base for _ in range(12)}
    signed = sorted(c - (1 << 64) if c >> 63 else c for c in codes)
    found = code_components(spark.createDataFrame([(c,) for c in signed], "code long"), radius, agree, shard_rows).collect()
    wanted = groups(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
    of = {r.node: r.root for r in found}
    assert len(of) == len(found)
    assert groups(signed, lambda a, b: of.get(a, a) == of.get(b, b)) == wanted


def test_a_large_group_gets_few_links(spark):
    rng = random.Random(3)
    base = rng.getrandbits(62)
    codes = set()
    while len(codes) < 3200:
        codes.add(base ^ sum(1 << b for b in rng.sample(range(62), 3)))
    frame = spark.createDataFrame([(c,) for c in codes], "code long")
    choices = block_choices(6, 3)
    first = links(frame, 6, 3, 512, choices[:3]).distinct()
    roots = components(first).withColumnRenamed("node", "code")
    rooted = frame.join(roots, "code", "left").select("code", F.coalesce("root", "code").alias("root"))
    further = links(rooted, 6, 3, 512, choices[3:]).distinct()
    assert first.count() + further.count() < 4 * len(codes)
    assert {r.root for r in code_components(frame, 6, 3).collect()} == {min(codes)}


def test_components_with_odd_rows(spark):
    table = docs(spark, EDGES, "code int, component_id int, first int, `a.b` int")
    found = simhash_components(table).collect()
    codes = {i: simhash(t) for i, t in EDGES if i is not None}
    wanted = groups(codes, lambda a, b: (codes[a] ^ codes[b]).bit_count() <= 2)
    assert sorted((r.doc_id or 0, r.component_id) for r in found) == sorted(
        (i or 0, wanted[7] if i is None else wanted[i]) for i, _ in EDGES
    )
    assert simhash_components(table.where("false")).collect() == []


def test_one_of_each_group_stays(spark):
    near = prose(1, 400)
    rows = [(5, near), (3, near), (4, near.replace(" w", " v", 1)), (9, prose(2)), (9, prose(2)), (None, near), (12, None)]
    kept = drop_near_copies(docs(spark, rows, "__row int, `a.b` int"))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 9, 12]
    assert kept.columns[-1] == "a.b"
    assert drop_near_copies(docs(spark, rows).where("false")).count() == 0
