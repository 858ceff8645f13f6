"""The mixing stage of the pipeline takes documents in the order of keys scaled by their quality scores."""

from __future__ import annotations

import math
import os
from collections import defaultdict

import pytest

import corpus_pipeline
from clearbook.llm.mixing import unit_hash
from clearbook.llm.quality import fit, quality_scores
from clearbook.llm.shared import read_table

SF_DIR = os.environ.get("CLEARBOOK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


def test_fraction_goes_by_quality_keys(spark):
    docs, labels = read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "labels")
    taken = {r.doc_id: r.taken for r in corpus_pipeline.mixing_stage(spark, docs, SF_DIR).collect()}
    scored = quality_scores(docs, fit(docs, labels)).join(docs.select("doc_id", "source", "text"), "doc_id")
    keys = defaultdict(list)
    for r in scored.withColumn("u", unit_hash(scored["doc_id"])).collect():
        if size := len(r.text.encode().split()):
            keys[r.source].append((-math.log(r.u) / r.quality_score, r.doc_id, size))
    split = 0
    for rows in keys.values():
        rows.sort()
        shares = [taken.get(i, 0) / size for _, i, size in rows]
        assert shares == sorted(shares, reverse=True)
        split += shares[0] - shares[-1] >= 1
    assert split
