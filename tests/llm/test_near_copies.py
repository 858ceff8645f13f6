"""Near copies are dropped by exact similarity, not by SimHash alone."""

from __future__ import annotations

from clearbook.llm.simhash_dedup import drop_near_copies
from tests.llm.helpers import docs, groups, jaccard, prose, simhash


def test_documents_of_close_codes_and_other_words_stay(spark):
    notice = " ".join(["all rights reserved"] * 300)
    rows = [(i, f"{notice} {prose(i, 60)}") for i in range(8)]
    rows += [(20, prose(30, 400)), (21, prose(30, 400) + " end"), (22, rows[2][1] + " end"), (23, rows[2][1])]
    texts = dict(rows)
    codes = {i: simhash(t) for i, t in rows}
    near = groups(codes, lambda a, b: (codes[a] ^ codes[b]).bit_count() <= 6)
    alike = groups(texts, lambda a, b: (codes[a] ^ codes[b]).bit_count() <= 6 and jaccard(texts[a], texts[b]) >= 0.8)
    assert len(set(near.values())) == 2 and set(alike.values()) == {*range(8), 20}
    assert {r.doc_id for r in drop_near_copies(docs(spark, rows)).collect()} == set(alike.values())
