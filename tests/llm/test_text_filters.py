"""Quality, toxicity, repeated passages and benchmark leaks."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from clearbook.llm import quality, severity
from clearbook.llm.decontaminate import ItemIndex, drop_leaking, find_leaks
from clearbook.llm.passages import anchors, cut_words, drop_repeated, repeated_passages, units_of
from clearbook.llm.shared import rolled, word_hashes, words_of
from tests.llm.helpers import docs, prose, words

LABELS = "doc_id long, quality int, toxic int"
ODD = [(None, "x"), (1, None), (2, ""), (3, " \n"), (4, "a b"), (4, "a b"), (5, "y" * 200_000)]


def labelled(spark, count=300):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(count):
        bad, toxic = i % 4 == 0, i % 5 == 0
        text = " ".join(f"{rng.choice('ABC')}{rng.randrange(90)}!!" for _ in range(80)) if bad else prose(i, 80)
        if toxic:
            text += " " + " ".join(rng.choices(["vile", "nasty", "awful"], k=rng.randrange(2, 9)))
        rows.append((i, text))
        marks.append((i, int(not bad), int(toxic)))
    return rows, marks


def test_quality_tells_held_out_texts(spark):
    rows, marks = labelled(spark)
    model = quality.fit(docs(spark, rows), spark.createDataFrame([m for m in marks if m[0] % 3], LABELS))
    found = {r.doc_id: r.quality_score for r in quality.quality_scores(docs(spark, rows), model).collect()}
    held = [(found[i] >= 0.3, bool(good)) for i, good, _ in marks if i % 3 == 0]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= s <= 1 for s in found.values())


def test_quality_of_odd_rows(spark):
    table = docs(spark, ODD, "quality_score int, label int, `a.b` int")
    marks = spark.createDataFrame([(4, 1, 0), (4, None, 0), (None, 0, 0), (9, 7, 0)], LABELS)
    model = quality.fit(table, marks)
    scored = quality.score_quality(table, model)
    assert scored.count() == len(ODD) and scored.columns[-1] == "quality_score"
    assert quality.quality_scores(table, quality.fit(table, marks.where("false"))).count() == len(ODD)
    assert quality.score_quality(table.where("false"), model).collect() == []


def test_severity_orders_held_out_texts(spark):
    rows, marks = labelled(spark)
    table, labels = docs(spark, rows), spark.createDataFrame([m for m in marks if m[0] % 3], LABELS)
    grades = severity.graded(table, labels)
    assert {r.grade for r in grades.collect()} <= {0, 1, 2, 3}
    model = severity.fit(table, grades, share=0.2)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = {r.doc_id: r for r in severity.score_severity(table, model).collect()}
    held = [(found[i].toxic, bool(toxic)) for i, _, toxic in marks if i % 3 == 0]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    amount = [sum(text.count(w) for w in ("vile", "nasty", "awful")) for _, text in rows]
    expected = [found[i].expected_severity for i, _ in rows]
    assert np.corrcoef(amount, expected)[0, 1] > 0.8


def test_cumulative_link_recovers_grades():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(3000):
        n = int(rng.integers(0, 6))
        grade = int(np.searchsorted([0.8, 1.4], np.log1p(n) + 0.1 * rng.logistic()))
        rows.append((grade, [0] if n else [], [n] if n else []))
    weights, theta = severity._cumulative_link(rows, 1, Counter(g for g, _, _ in rows), 2000, 0.0)
    assert theta[0] < theta[1]
    assert np.allclose(np.array(theta) / weights[0], [0.8, 1.4], atol=0.1)


def test_severity_of_odd_rows(spark):
    table = docs(spark, ODD, "grade int, words int, `a.b` int")
    grades = spark.createDataFrame([(4, 1), (4, 0), (None, 2), (3, None)], "doc_id long, grade int")
    assert severity.score_severity(table, severity.fit(table, grades)).count() == len(ODD)
    empty = severity.fit(table, grades.where("false"))
    assert not any(r.toxic for r in severity.score_severity(table, empty).collect())
    assert severity.score_severity(table.where("false"), empty).collect() == []


def test_anchors_are_the_smallest_of_each_run():
    values = np.random.default_rng(0).integers(0, 50, 400).astype(np.uint64)
    wanted = {i + int(values[i : i + 15].argmin()) for i in range(400 - 14)}
    assert set(anchors(values, 15).tolist()) == wanted


def test_every_long_shared_passage_shares_a_window():
    for seed in range(40):
        passage = prose(seed, 51)
        texts = [f"{prose(seed + 100 * k, 30)} {passage} {prose(seed + 100 * k + 50, 25)}" for k in (1, 2)]
        nodes = [{node for node, _, _, bands in units_of(t, 32, 15, 50) if bands is None} for t in texts]
        assert nodes[0] & nodes[1]


def test_repeated_passages_against_all_windows(spark):
    shared, line = prose(1, 69), prose(2, 60)
    edited = line.split()
    edited[-1] = "changed"
    rows = [(i, f"{prose(10 + i, 40)}\n{prose(40 + i, 90)}") for i in range(10)]
    rows[3] = (3, prose(90, 20) + " " + shared + " " + prose(91, 20))
    rows[6] = (6, prose(92, 33) + " " + shared + " " + prose(93, 9))
    rows += [(20, prose(94) + "\n" + line), (21, prose(95) + "\n" + line.upper()), (22, prose(96) + "\n" + " ".join(edited))]
    rows += [(30, rows[0][1]), (31, line.replace("w", "v") + "\n" + line.replace("w", "v"))]
    rows += [(i and 100 + i, text) for i, text in ODD]
    found = repeated_passages(docs(spark, rows, "node int, start int, bands int, root int, `a.b` int")).collect()
    seen, brute = {}, set()
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        own = words(text)
        for at in range(len(own) - 50):
            key = tuple(own[at : at + 51])
            if seen.setdefault(key, i) != i:
                brute.add((i, seen[key]))
    pairs = {(r.doc_id, r.kept_doc_id) for r in found}
    assert brute <= pairs
    assert {a for a, _ in pairs} == {6, 21, 22, 30}
    assert all(r.doc_id != r.kept_doc_id for r in found)
    assert repeated_passages(docs(spark, rows).where("false")).collect() == []
    cut = {r.doc_id: r for r in drop_repeated(docs(spark, rows, "__spans int, `a.b` int")).where("doc_id <> 104").collect()}
    assert cut[6].text.split()[0] == rows[6][1].split()[0] and shared not in cut[6].text
    assert cut[6].n_chars == len(cut[6].text) < len(rows[6][1])
    assert cut[21].text.rstrip() == rows[11][1].split("\n")[0]
    assert cut[3].text == rows[3][1] and cut[20].text == rows[10][1] and cut[101].text is None


def test_cut_words_leaves_one_separator():
    assert cut_words("a b c d", [(1, 2)]) == "a d"
    assert cut_words("a b\nc d\ne", [(2, 2)]) == "a b\ne"
    assert cut_words("a b\nc", [(0, 2), (1, 2)]) == ""
    assert cut_words("é à\n\nü", [(1, 1)]) == "é\nü"


def brute_leaks(texts, items, similarity):
    out = {}
    for doc, text in texts:
        own = words_of(text)
        for item, body in items:
            asked = words_of(body)
            if not asked:
                continue
            width = min(5, len(asked))
            shingles = Counter(rolled(word_hashes(asked), 5).tolist())
            for at in range(len(own) - len(asked) + 1):
                window = Counter(rolled(word_hashes(own[at : at + len(asked)]), width).tolist())
                both = (window & shingles).total()
                score = both / (window.total() + shingles.total() - both)
                if score >= similarity:
                    out[doc, item] = max(score, out.get((doc, item), 0))
    return out


def test_leaks_against_all_windows(spark):
    items = [(i, prose(500 + i, 12 + 4 * i)) for i in range(8)] + [(20, "just three words"), (21, ""), (22, None), (None, prose(9, 30))]
    texts = [(i, prose(700 + i, 60)) for i in range(12)]
    for i in range(6):
        texts[i] = (i, prose(i, 25) + "\n" + items[i][1].upper().replace("W", "w") + " " + prose(40 + i, 12))
    texts[6] = (6, prose(6, 9) + " " + " ".join(items[7][1].split()[1:]) + " tail " + items[0][1])
    texts[7] = (7, "so just three words here")
    texts[8] = (8, items[4][1] + " " + items[4][1])
    texts += ODD
    bench = spark.createDataFrame(items + [items[2]], "item_id long, text string")
    table = docs(spark, texts, "item_id int, similarity int, `a.b` int")
    wanted = brute_leaks([t for t in texts if t[0] is not None], [x for x in items if x[0] is not None and x[1]], 0.8)
    for part in (16 << 20, 60):
        found = find_leaks(table, bench, part_bytes=part).collect()
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == {k: round(v, 9) for k, v in wanted.items()}
    left = {r.doc_id for r in drop_leaking(table, bench).collect()}
    assert left == {i for i, _ in texts} - {i for i, _ in wanted}
    assert find_leaks(table, bench.where("false")).collect() == find_leaks(table.where("false"), bench).collect() == []


def test_index_finds_all_codes_within_the_radius():
    rng = random.Random(5)
    index = ItemIndex.of([(i, prose(i, 20)) for i in range(60)], 20, 0.8)
    index._prepare()
    for _ in range(300):
        code = rng.choice(index.codes) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(30)))
        assert index.near(code) == [i for i, c in enumerate(index.codes) if (c ^ code).bit_count() <= 20]


@pytest.mark.parametrize("text", ["", None, "a", "a b c d e f"])
def test_units_of_short_texts(text):
    assert units_of(text, 32, 15, 50) == []


def test_rows_of_one_document_lose_only_what_stands_in_them(spark):
    shared, own, other = prose(70, 60), prose(71, 80), prose(72, 90)
    rows = [(1, f"{shared}\n{prose(73, 70)}"), (2, f"{shared}\n{own}"), (2, other), (2, f"{other[:200]}\n{own}")]
    found = [r.text for r in drop_repeated(docs(spark, rows)).where("doc_id = 2").collect()]
    assert sorted(found) == sorted([own, other, f"{other[:200]}\n{own}"])


def test_only_the_settled_table_stays(spark, tmp_path):
    from clearbook.llm.shared import keep, settled

    made = []

    def build():
        made.append(keep(spark.range(5), "inner"))
        made.append(settled(lambda: keep(made[0].where("id > 1"), "deeper").where("id > 2"), "middle"))
        return made[1].where("id > 3")

    table = settled(build, "outer")
    assert [r.id for r in table.collect()] == [4]
    for gone in made:
        with pytest.raises(Exception, match="(?i)exist|not found"):
            gone.collect()
