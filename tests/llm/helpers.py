"""Small tables and brute-force versions for the tests of the corpus operators."""

from __future__ import annotations

import random
import re

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=""):
    """Documents from (doc_id, text) or (doc_id, text, source), with any further columns of ``extra`` filled by 1."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    names = [x.split()[0] for x in extra.split(",") if x]
    return spark.createDataFrame([(*r, *[1] * len(names)) for r in full], DOCS + (", " + extra if extra else ""))


def prose(seed, words=120, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(words))


def words(text):
    return [w.lower() for w in WORD.findall((text or "").encode())]


def simhash(text, size=3):
    found = words(text)
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def jaccard(a, b):
    """Similarity of the sets of five-word shingles."""
    one, two = (
        {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} for own in (words(a), words(b))
    )
    return len(one & two) / len(one | two)


def groups(nodes, linked):
    """{node: smallest node of its component} by comparing all pairs."""
    nodes = sorted(nodes)
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
