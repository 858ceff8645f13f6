"""Groups of edited copies against brute-force Jaccard components."""

from __future__ import annotations

import random

import numpy as np
import pytest

from clearbook.llm.passages import SHINGLE, repeated_passages
from clearbook.llm.shared import rolled, word_hashes, words_of
from clearbook.llm.similar import similar_components
from tests.llm.helpers import docs, groups, prose


def shingles(text):
    return set(rolled(word_hashes(words_of(text)), SHINGLE).view(np.int64).tolist())


def jaccard(a, b):
    return len(a & b) / (len(a | b) or 1)


def star(count, size=200, edits=3, seed=1):
    """A text and variants of it: each is within 0.8 of the text, hardly any two variants are of each other."""
    rng, base = random.Random(seed), prose(seed, size).split()
    texts = [" ".join(base)]
    for i in range(count):
        own = list(base)
        for n, at in enumerate(rng.sample(range(10, size - 10, 12), edits)):
            own[at + rng.randrange(5)] = f"edit{i}x{n}"
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("tile_rows", [7, 128])
def test_components_of_groups_against_all_pairs(spark, tile_rows):
    texts = star(60, 100, 2) + star(20, 80, 1, seed=2) + [prose(i, 70) for i in range(20, 40)]
    rng = random.Random(3)
    sets = {i: shingles(t) for i, t in zip(rng.sample(range(-500, 500), len(texts)), texts)}
    members = [(7, i) for i in sets] + [(8, i) for i in list(sets)[::9]] + [(9, next(iter(sets)))]
    rows = [(i, sorted(s)) for i, s in sets.items()]
    table = spark.createDataFrame(rows, "node long, shingles array<long>")
    keyed = spark.createDataFrame(members, "key long, node long")
    found = similar_components(keyed, lambda asked: table.join(asked, "node"), 0.8, tile_rows).collect()
    wanted = groups(sets, lambda a, b: jaccard(sets[a], sets[b]) >= 0.8)
    linked = {n for n, root in wanted.items() if list(wanted.values()).count(root) > 1}
    assert {r.node: r.root for r in found} == {n: wanted[n] for n in linked}
    empty = similar_components(keyed.where("false"), lambda asked: table.join(asked, "node"), 0.8)
    assert empty.collect() == []


def test_star_of_edited_paragraphs_is_one_class(spark):
    texts = star(250, 600, 9)
    # The base is neither the first nor the last document.
    rows = [(i, t) for i, t in enumerate(texts[1:120] + texts[:1] + texts[120:])] + [(900, prose(77, 90)), (901, prose(78, 90))]
    found = repeated_passages(docs(spark, rows)).where("kind = 'paragraph'").collect()
    sets = {i: shingles(t) for i, t in rows}
    wanted = groups(sets, lambda a, b: jaccard(sets[a], sets[b]) >= 0.8)
    assert {(r.doc_id, r.kept_doc_id) for r in found} == {(i, first) for i, first in wanted.items() if i != first}
