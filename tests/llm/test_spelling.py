from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from clearbook.llm.registry import op11_spelling
from clearbook.llm.spelling import END, START, frequent_grams, near_pairs, near_words, one_edit, variable_grams, variant_groups
from tests.llm.helpers import docs


def vocabulary(seed, n=400, letters="abé", sizes=(6, 9)):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(n)})


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters if c != word[i])


def near_of(words):
    known, out = set(words), {}
    for word in words:
        letters = {c for w in words for c in w}
        out[word] = {w for w in edits(word, letters) if w in known and w != word}
    return out


def counted(words, longest, more_than):
    found = Counter()
    for word in words:
        marked = START + word + END
        found.update({marked[i:j] for i in range(len(marked)) for j in range(i + 2, min(len(marked), i + longest) + 1)})
    return {gram: n for gram, n in found.items() if n > more_than}


@pytest.mark.parametrize("letters, least, more_than", [("ab", 6, 3), ("abé", 6, 20), ("abcdef", 8, 1), ("a", 6, 0), ("abc", 5, 8)])
def test_an_edit_changes_no_more_grams_than_the_bound(letters, least, more_than):
    words = vocabulary(5, 300, letters, (least, least + 4))
    longest = (least + 1) // 2
    frequent = counted(words, longest, more_than)
    for word in words[:60]:
        grams, bound = variable_grams(word, frequent, longest)
        assert bound < len(grams)
        for other in edits(word, letters):
            if len(other) < least or other == word:
                continue
            theirs = set(variable_grams(other, frequent, longest)[0])
            step = len(other) - len(word)
            kept = sum((p, g) in theirs or (p + step, g) in theirs for p, g in grams)
            assert kept >= len(grams) - bound


def test_one_edit():
    for a in ("", "ab", "aab", "abc", "bab", "é"):
        for b in ("", "ab", "aab", "abc", "bab", "é", "abab", "ba"):
            assert one_edit(a, b) == (b in set(edits(a, "abcé")) - {a})


@pytest.mark.parametrize("n", [20, 300])
def test_lists_short_and_long(n):
    words = [w for w in vocabulary(2, n * 4, "ab", (8, 9))]
    own, others = [w for w in words if len(w) == 9][:n], [w for w in words if len(w) == 8]
    frequent = counted(words, 3, 2)
    found = set(near_pairs(own, others, frequent, 3))
    near = near_of(own + others)
    assert found == {(min(a, b), max(a, b)) if len(a) == len(b) else tuple(sorted((a, b), key=len)) for a in own for b in near[a]}


@pytest.mark.parametrize("list_rows, threshold, dictionary_rows", [(4096, 5, 200_000), (7, 5, 200_000), (40, 2, 30)])
def test_near_words_equal_all_pairs(spark, list_rows, threshold, dictionary_rows):
    words = vocabulary(11, 500)
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    found = [tuple(r) for r in near_words(frame, 6, threshold, dictionary_rows, list_rows).collect()]
    assert len(found) == len({frozenset(p) for p in found})
    assert {frozenset(p) for p in found} == {frozenset((a, b)) for a, others in near_of(words).items() for b in others}
    assert len(frequent_grams(frame, 3, threshold, dictionary_rows)) <= dictionary_rows


def brute_groups(n):
    near, form = near_of(list(n)), {}
    for word in n:
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        form[word] = best if best is not None and n[best] >= 5 * n[word] else None
    out = []
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n[word], len(near[word]), None if form[word] is None else n[form[word]]))
    return sorted(out)


def test_groups_with_odd_rows(spark):
    rng = random.Random(1)
    rows = [(w, 5 ** rng.randrange(1, 6)) for w in vocabulary(4, 200, "ab", (6, 8))]
    rows += [(rows[0][0], 3), (None, 10**6), ("", 9), ("short", 99), ("rareword", 4), ("x" * 70000, 8), ("x" * 70001, 50)]
    total = Counter()
    for word, n in rows:
        if word is not None and len(word) >= 6:
            total[word] += n
    total = {w: n for w, n in total.items() if n >= 5}
    frame = spark.createDataFrame([(*r, 1, 1) for r in rows], "word string, n long, form int, `a.b` int")
    found = variant_groups(frame)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    long = {w: n for w, n in total.items() if len(w) > 100}
    rest = brute_groups({w: n for w, n in total.items() if w not in long})
    assert sorted(tuple(r) for r in found.where("length(word) < 100").collect()) == rest
    assert {(r.n, r.n_near, r.form_n) for r in found.where("length(word) > 100").collect()} == {(8, 1, 50), (50, 1, None)}
    assert variant_groups(frame.where("false")).collect() == []


def test_query(spark, tmp_path):
    pool = vocabulary(9, 60, "abÉé", (5, 7))
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(pool).title() for _ in range(200)) + "×1") for i in range(30)]
    rows += [(None, "missing " * 7 + "missin1missin " * 6), (50, None), (51, ""), (3, "repeat row " * 9), (3, "repeat row " * 9)]
    docs(spark, rows, "word int, n int").write.parquet(f"{tmp_path}/documents.parquet")
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    wanted = brute_groups({w: c for w, c in n.items() if len(w) >= 6 and c >= 5})
    assert len(wanted) > 20
    assert sorted(tuple(r) for r in op11_spelling(spark, str(tmp_path)).collect()) == wanted
