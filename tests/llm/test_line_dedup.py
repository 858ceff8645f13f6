from __future__ import annotations

import hashlib
import random
import re

import pytest

from clearbook.llm.line_dedup import drop_common_lines, line_keys
from clearbook.llm.registry import op13_line_dedup
from tests.llm.helpers import docs

SPACE = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in SPACE.sub("", line))


def brute(rows, least_docs, least_chars=1):
    """Sorted (doc_id, kept text, lines, dropped) of (doc_id, text) rows."""
    owners = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            owners.setdefault(key_of(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key_of(x)) >= least_chars and len(owners[key_of(x)]) >= least_docs)]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def table(seed=3, n=40):
    rng = random.Random(seed)
    pool = ["Cookie notice", " cookie NOTICE\t", "", "  ", "É", "é", "\x0bpage 1\x0c", "page 1\r", "x ", "x", "日本", "a\x85"]
    rows = [(i, "\n".join(rng.choice([*pool, f"own {i}"]) for _ in range(rng.randrange(12)))) for i in range(n)]
    return [*rows, (None, "É\nx"), (None, "É\ny"), (5, "again\nÉ"), (5, "again\nÉ"), (90, None), (91, ""), (92, "long " * 20000)]


def test_keys_are_those_of_single_characters():
    for _, text in table():
        assert line_keys(text) == [key_of(line).encode() for line in (text or "").split("\n")]


@pytest.mark.parametrize("broadcast_keys", [1 << 18, 3, 0])
@pytest.mark.parametrize("least_docs, least_chars", [(1, 1), (3, 0), (10, 1), (4, 2)])
def test_common_lines_go_either_way(spark, broadcast_keys, least_docs, least_chars):
    found = drop_common_lines(docs(spark, table(), "high int, low int, `a.b` int"), least_docs, least_chars, broadcast_keys)
    assert sorted(map(tuple, found.collect()), key=str) == brute(table(), least_docs, least_chars)


@pytest.mark.parametrize("broadcast_keys", [10, 0])
def test_empty_table(spark, broadcast_keys):
    assert drop_common_lines(docs(spark, [(1, "a")]).where("false"), broadcast_keys=broadcast_keys).collect() == []


def test_query(spark, tmp_path):
    docs(spark, table(), "n_lines int").write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_line_dedup(spark, str(tmp_path))
    wanted = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, kept, n, gone in brute(table(), 10)]
    assert sorted(map(tuple, found.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str) == sorted(
        wanted, key=str
    )
