from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from clearbook.llm.merkle import document_leaves, manifest
from clearbook.llm.registry import op12_merkle
from tests.llm.helpers import docs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    parts = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def brute_tree(nodes, arity):
    """(root, proofs): of each node the levels' (left siblings, right siblings), by following one level after the other."""
    proofs, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + arity, len(nodes))) for i in range(0, len(nodes), arity)]
        for run in runs:
            for at in run:
                for i in members[at]:
                    proofs[i].append(("".join(nodes[j] for j in run if j < at), "".join(nodes[j] for j in run if j > at)))
        nodes, members = ["".join(nodes[j] for j in run) for run in runs], [[i for j in run for i in members[j]] for run in runs]
        nodes = [sha(n) for n in nodes]
    return nodes[0], proofs


def brute(rows, arity=16):
    """Sorted rows of the query op12."""
    sources = {}
    for row in rows:
        sources.setdefault(row.source, []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        leaves = sorted(
            ((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r) for r in sources[source]), key=lambda x: x[:3]
        )
        trees[source] = (leaves, *brute_tree([x[2] for x in leaves], arity))
    root, above = brute_tree([trees[s][1] for s in order], arity)
    out = []
    for source, outer in zip(order, above):
        leaves, subroot, proofs = trees[source]
        for (_, _, leaf, row), own in zip(leaves, proofs):
            path = own + outer
            text = row.text
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            at = leaf_of(row, text)
            for left, right in path:
                at = sha(left + at + right)
            out.append((row.doc_id, leaf, subroot, root, sha("".join(a + b for a, b in path)), at, at == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return [
        (i, rng.choice([None, "", "Text É", "plain", f"Number {i}"]), rng.choice([None, "", "é", "web", "web", "web", "Z"]))
        for i in range(n)
    ]


@pytest.mark.parametrize("arity, height", [(16, 3), (2, 1), (3, 2), (16, 1)])
def test_proofs_equal_one_big_tree(spark, tmp_path, arity, height):
    table = docs(spark, [*texts(150), (None, "A", "web"), (7, "again", "web"), (7, "again", "web"), (999, "A", "alone")])
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = manifest(document_leaves(table, marked, lower), arity, height).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=str) == brute(table.collect(), arity)


def test_query_on_odd_tables(spark, tmp_path):
    def run(table):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        table.write.parquet(f"{path}/documents.parquet")
        found = op12_merkle(spark, path)
        assert found.columns == COLUMNS
        return sorted(map(tuple, found.collect()), key=str)

    odd = docs(spark, [*texts(40, 2), (None, None, None)], "tree int, node int, pos int, `a.b` int, claim int")
    odd = odd.withColumn("n_chars", F.when(F.col("doc_id") % 3 > 0, F.col("n_chars"))).withColumn("lang", F.lit(None).cast("string"))
    assert run(odd) == brute(odd.collect())
    one = docs(spark, [(5, "Alone " * 30000)])
    assert run(one) == brute(one.collect())
    assert run(one.where("false")) == []


def test_paths_lead_to_the_root(spark):
    table = docs(spark, texts(60, 3))
    for row in manifest(document_leaves(table), 4, 1, paths=True).collect():
        at = row.leaf
        for left, right in zip(row.lefts, row.rights):
            at = sha(left + at + right)
        assert at == row.root and row.verified and len(row.lefts) == len(row.rights)
