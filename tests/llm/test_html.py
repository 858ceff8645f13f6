from __future__ import annotations

import functools
import random

import pytest
from pyspark.sql import functions as F

from clearbook.llm import html_text
from clearbook.llm.html_text import extract_text, main_text, parse, tree_match

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
    "<nav><ul><li><a href='/a'>Menu {i}</a></li></ul></nav><!-- ad --><div class='ad'>Buy {i}</div>"
    "<div class='cookie-notice'>We use cookies</div><aside>More {i}</aside>"
    "<article><h1>Head&amp;line {i}</h1><p><b>First\n  {i}.<br>again<p>Second&nbsp; <i>{i}</i>&#33;</p>"
    "<ul><li>one<li>two</ul><p>Read our rules</p><form><input name=q>Search</form>"
    "<div id='comments'><p>Reader {i}</p></div></article><footer>&copy; x</footer></body></html>"
)
TEXT = "Head&line {i}\nFirst {i}. again\nSecond {i}!\none\ntwo\nRead our rules"


def test_article_without_furniture():
    for i in range(3):
        assert main_text(PAGE.replace("{i}", str(i))) == TEXT.replace("{i}", str(i))


@pytest.mark.parametrize(
    "source, wanted",
    [
        (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<p>a &am", "a &am"), ("<p>a &amp b", "a & b"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<p>open <b>bold", "open bold"), ("</div><p>x</p></p>", "x"),
        ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>b</p></main>", "T\nb"),
        ("<div id=menu>m</div><div><p>long paragraph of text</p></div><div>side</div>", "long paragraph of text"),
        ("<article>a<script>if (a<b) {}</script>b</article>", "ab"), ("<p>" + "x" * 100000, "x" * 100000),
        ("<article><pre>a\n  b</pre><!-- <p>no</p> --></article>", "a b"), ("<div>" * 400 + "<p>deep", "deep"),
    ],
)
def test_broken_and_short_pages(source, wanted):
    assert main_text(source) == wanted


def test_tree_matching_counts_the_best_pairs():
    a, b = parse("<div><p>1</p><ul><li>x</ul></div><footer>f</footer>"), parse("<nav>n</nav><div><ul><li>y<li>z</ul></div>")
    size, pairs = tree_match(a, b)
    assert size == 4 and [(x[0].tag, y[0].tag) for x, y in pairs] == [("html", "html"), ("div", "div"), ("ul", "ul"), ("li", "li")]


def brute_match(a, b):
    """Size of the best order-keeping match of two trees, by trying all."""
    if a.tag != b.tag:
        return 0

    @functools.cache
    def best(i, j):
        if i == len(left) or j == len(right):
            return 0
        pair = brute_match(left[i], right[j])
        return max(best(i + 1, j), best(i, j + 1), pair + best(i + 1, j + 1) if pair else 0)

    left, right = a.elements(), b.elements()
    return 1 + best(0, 0)


def random_tree(rng, depth=4):
    tag = rng.choice(["div", "section", "ul"])
    inner = "".join(random_tree(rng, depth - 1) for _ in range(rng.randrange(4))) if depth else ""
    return f"<{tag}>{inner or '<b>x</b>'}</{tag}>"


def test_tree_matching_equals_trying_all(monkeypatch):
    rng = random.Random(4)
    for _ in range(40):
        a, b = parse(random_tree(rng)), parse(random_tree(rng))
        size, pairs = tree_match(a, b)
        assert size == brute_match(a, b) == len(pairs)
        assert all(x[0].tag == y[0].tag for x, y in pairs)
    # Matched by number: still a match that keeps order and ancestry.
    monkeypatch.setattr(html_text, "ALIGNED_PAIRS", 1)
    for _ in range(20):
        a, b = parse(random_tree(rng)), parse(random_tree(rng))
        size, pairs = tree_match(a, b)
        assert size == len(pairs) <= brute_match(a, b) and len({id(y[0]) for _, y in pairs}) == size


@pytest.mark.parametrize(
    "source, wanted",
    [
        ('<body class="no-sidebar"><article><p>kept</p></article></body>', "kept"),
        ('<article class="post has-comments"><p>kept</p></article><p>outside of it</p>', "kept"),
        ('<article><p class="social-history">kept</p><p class="social">gone</p></article>', "kept"),
        ("<article><p>one</p></article><div>between</div><article><p>two</p></article>", "one\ntwo"),
        ('<form><div class="widget"><article><p>kept</p></article></div></form>', "kept"),
        ('<article><p>kept</p><section class="reader-comments"><p>gone</p></section></article>', "kept"),
        ('<article><p>kept</p><section class="post-comments"><article class="comment">gone</article></section></article>', "kept"),
        ("<p>a <b", "a <b"), ('<p title="x>y">a</p><i "z>b</i>', "a\nb"), ("<div>" * 5000 + "deep", "deep"),
        ("<b>" * 2000 + "bold", "bold"), ("<ul><li>" * 3000 + "x", "x"), ('<a "' * 6000, " ".join(['<a "'] * 6000)),
    ],
)
def test_names_regions_and_depth(source, wanted):
    found = main_text(source)
    assert found == wanted if len(source) < 20000 or "<a" not in source else found.count("<a") == 6000


def page_of(i, pages):
    """A page without telling names: a head, an article, a foot, all in divs."""
    notice = "<div><div>This site uses small files to remember you</div></div>" if i % 5 else ""
    byline = f"<div>By author {i % 4}</div>"
    body = "".join(f"<p>Sentence {j} of story {i} with {i * 7 + j} words.</p>" for j in range(2 + i % 3))
    page = f"<div><div>Site name</div><div><b>Menu one</b> two</div></div>{notice}<div><div><h1>Story {i}</h1>{byline}{body}</div></div>"
    wanted = [f"Story {i}", f"By author {i % 4}", *(f"Sentence {j} of story {i} with {i * 7 + j} words." for j in range(2 + i % 3))]
    return f"<body><div>{page}<div><p>All rights reserved here</p></div></div></body>", "\n".join(wanted)


def test_nested_pages_without_names(spark):
    pages = [page_of(i, 25) for i in range(25)]
    pages += [pages[3]] * 5
    frame = spark.createDataFrame([(i, "http://plain.example/", p) for i, (p, _) in enumerate(pages)], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract_text(frame.withColumn("html", F.regexp_replace("html", "<body>", "<body><main>"))).collect()}
    assert found == {i: wanted for i, (_, wanted) in enumerate(pages)}


def test_templates_equal_counting_all_pages(spark):
    sources = sorted({page_of(i, 30)[0].replace("<body>", "<main>") for i in range(30)} | {PAGE.replace("{i}", str(i)) for i in range(9)})
    frame = spark.createDataFrame([("h", s, sources[0]) for s in sources], "host string, html string, model string")
    model, have, whole = html_text.Model(sources[0]), {}, {}
    for source in sources:
        found = html_text.slot_texts(html_text.Page(source), model)
        for slot, mark, _ in found:
            have.setdefault((slot, mark), set()).add(html_text.lead_of(found))
            whole.setdefault(slot, set()).add(html_text.lead_of(found))
    wanted = {key for key, leads in have.items() if len(leads) >= 3 and len(leads) >= 2 / 3 * len(whole[key[0]])}
    rows = html_text.templates(frame, 3, 2 / 3).collect()
    assert {(c.slot, c.mark) for r in rows for c in r.constant} == wanted and wanted


def test_copies_of_one_article_are_no_template(spark):
    copies = [(i, "http://c.example/", f"<article><p>Shared story with many words</p><p>{i}</p></article>") for i in range(6)]
    frame = spark.createDataFrame(copies, "page_id long, url string, html string")
    assert {r.text for r in extract_text(frame).collect()} == {f"Shared story with many words\n{i}" for i in range(6)}


def test_pages_of_a_table(spark):
    story = "<article><h1>{t}</h1><p>Some words about {t} and more of them</p><p>Share this story</p></article>"
    rows = [(i, f"https://Big.example/{i}", story.replace("{t}", f"t{i}")) for i in range(12)]
    rows += [(20, None, story.replace("{t}", "n")), (21, "https://small.example/", None), (22, "nonsense", ""), (0, rows[0][1], rows[0][2])]
    rows += [(None, "http://big.example", "<p>x</p>")]
    frame = spark.createDataFrame([(*r, 1, 1) for r in rows], "page_id long, url string, html string, host int, `a.b` int")
    found = extract_text(frame).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    assert texts[3] == "t3\nSome words about t3 and more of them"
    assert texts[20] == "n\nSome words about n and more of them\nShare this story"
    assert texts[21] == texts[22] == "" and texts[None] == "x"
    assert extract_text(frame.where("false")).collect() == []
