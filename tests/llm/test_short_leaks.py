"""Documents that are shorter than the benchmark items they leak."""

from __future__ import annotations

from collections import Counter

from clearbook.llm.decontaminate import drop_leaking, find_leaks
from clearbook.llm.shared import rolled, word_hashes, words_of
from tests.llm.helpers import docs, prose


def whole_similarity(text, item):
    """Weighted Jaccard of all shingles of both; windows do not matter where the text is the shorter one."""
    a, b = (Counter(rolled(word_hashes(words_of(t)), 5).tolist()) for t in (text, item))
    both = (a & b).total()
    return both / (a.total() + b.total() - both)


def test_truncated_items_against_whole_documents(spark):
    items = [(i, prose(600 + i, 16 + 6 * i)) for i in range(8)] + [(20, "a b c d e f"), (21, "one two three"), (22, "a b c d e")]
    texts = [(0, "one two"), (1, "a b c d e"), (2, "a b c d"), (3, prose(3, 10))]
    for i, item in items[:8]:
        own = item.split()
        for cut in range(1, 12):
            texts.append((100 * (i + 1) + 2 * cut, " ".join(own[: len(own) - cut])))
            texts.append((100 * (i + 1) + 2 * cut + 1, " ".join([*own[cut:-1], "other"])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = {
        (d, i): round(score, 9)
        for d, text in texts
        for i, item in items
        if len(text.split()) < len(item.split()) and (score := whole_similarity(text, item)) >= 0.8
    }
    assert len(wanted) > 40
    table = docs(spark, texts)
    sizes = {i: len(item.split()) for i, item in items}
    lengths = {d: len(text.split()) for d, text in texts}
    for part in (16 << 20, 200):
        found = [r for r in find_leaks(table, bench, part_bytes=part).collect() if lengths[r.doc_id] < sizes[r.item_id]]
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == wanted
        assert all((r.first_word, r.n_words) == (0, lengths[r.doc_id]) for r in found)
    assert {d for d, _ in wanted}.isdisjoint(r.doc_id for r in drop_leaking(table, bench).collect())
