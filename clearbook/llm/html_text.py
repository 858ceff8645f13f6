"""Main text of web pages by wrapper induction: what same-host pages share is template, what varies is content.

Every page is aligned with one page of its host by simple tree matching: the largest set of node pairs with equal tags that
keeps order and ancestry. A node that is matched has the slot of its partner, any other the slot of its nearest matched
ancestor and the tags below it; runs of childless siblings with one tag are one repeated slot. Over all pages of a host,
slots and texts are counted, by articles and not by pages: pages whose longest blocks, half of their text, are the same are
copies of one article. A text that at least ``least`` articles have in a slot, and a share of all articles that have the slot, is constant and belongs to
the template; what varies in a slot is content. Of a page, the content is the varying text of the slots in its main regions,
without the elements that are furniture by their tag or by a whole name of their class, id or role.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import batches, keep

# Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME_LEVEL = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
FURNITURE = frozenset(
    "nav footer aside form script style noscript template iframe button select textarea input svg canvas object menu dialog"
    " head title label fieldset".split()
)
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies"
    " consent disclaimer disqus footer gdpr menu modal nav navbar navigation newsletter notice notices"
    " notification overlay pager pagination popup promo promoted promotion related recommended recommendations replies reply"
    " respond share sharing sidebar sidebars skip social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
_HEADERS = frozenset(("header", "masthead"))
REGION_NAMES = frozenset("article articlebody content entry main post story".split())
#: Parts of a name that say where or how, and not what.
NEUTRAL = frozenset(
    "area article bar block body bottom box center column container content div entry fixed global grid group inner item js"
    " left list main module outer page panel post primary reader readers right row secondary section site slot sticky story"
    " sub text thread top unit user users visitor visitors wrap wrapper zone".split()
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)|<[!?][^>]*>|[^<]+|<", re.S)
_IN_TAG = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+")


#: Templates of up to this many characters are sent to all tasks.
BROADCAST_CHARS = 16 << 20


class Node:
    """An element: tag, names from its class, id, role and itemprop, and children that are nodes or pieces of text."""

    __slots__ = ("tag", "names", "children")

    def __init__(self, tag: str, names: frozenset[str] = frozenset()) -> None:
        self.tag, self.names, self.children = tag, names, []

    def elements(self) -> list[Node]:
        return [child for child in self.children if isinstance(child, Node)]


def _tag_end(text: str, at: int, last: dict[str, int]) -> int:
    """Place after the ``>`` that ends a tag, quoted values aside; -1 if there is none."""
    while True:
        at = _IN_TAG.match(text, at).end()
        if at == len(text):
            return -1
        if text[at] == ">":
            return at + 1
        # A quote that is never closed is a character like others.
        at = text.index(text[at], at + 1) + 1 if last[text[at]] > at else at + 1


def parse(source: str | None) -> Node:
    """Tree of a page; whatever is missing or crossed is closed where the next element needs it."""
    root = Node("html")
    stack, opened = [root], Counter()
    at, text = 0, source or ""
    last = {quote: text.rfind(quote) for quote in "\"'"}
    final = text.rfind(">")
    while match := _TOKEN.match(text, at):
        at = match.end()
        closing, tag = match[1], match[2]
        if tag is None:
            piece = match[0]
            if not piece.startswith("<") or piece == "<":
                stack[-1].children.append(piece)
            continue
        end = _tag_end(text, at, last) if final >= at else -1
        if end < 0:
            # A tag that is never closed is text, and what follows is read on its own.
            stack[-1].children.append("<")
            at = match.start() + 1
            continue
        attributes, at = text[at : end - 1], end
        tag = tag.lower()
        if closing:
            if opened[tag]:
                while True:
                    gone = stack.pop().tag
                    opened[gone] -= 1
                    if gone == tag:
                        break
            continue
        if tag == "html" and len(stack) == 1:
            continue
        if tag in CLOSES_P and opened["p"]:
            _close(stack, opened, ("p",), BLOCK - {"p"})
        if tag in SAME_LEVEL:
            _close(stack, opened, SAME_LEVEL[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        if tag in RAW:
            ending = re.compile(f"</{tag}[^>]*>", re.I).search(text, at)
            at = ending.end() if ending else len(text)
            continue
        node = Node(tag, _names(attributes))
        stack[-1].children.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened[tag] += 1
    return root


def _close(stack: list[Node], opened: Counter, tags: tuple[str, ...], barrier: frozenset[str]) -> None:
    if not any(opened[tag] for tag in tags):
        return
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            opened.subtract(node.tag for node in stack[depth:])
            del stack[depth:]
            if len(tags) < 3:
                return
        elif stack[depth].tag in barrier:
            return


def _names(attributes: str) -> frozenset[str]:
    """Whole names of class, id, role and itemprop, in lower case."""
    if "=" not in attributes:
        return frozenset()
    values = (m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes))
    return frozenset(name for value in values for name in value.lower().split())


@functools.lru_cache(100_000)
def _says(name: str, what: frozenset[str]) -> bool:
    """Whether a name means one of ``what``: it has such a part, and all others only say where (``no-sidebar`` does not)."""
    parts = [part for part in _SPLIT.split(name) if part]
    return any(part in what for part in parts) and all(part in what or part in NEUTRAL for part in parts)


class Page:
    """A parsed page: its order of nodes, and which of them are furniture."""

    def __init__(self, source: str | None):
        self.root = parse(source)
        self.order = [self.root]
        stack = self.root.elements()[::-1]
        while stack:
            node = stack.pop()
            self.order.append(node)
            stack.extend(reversed(node.elements()))
        articles = {id(node) for node in self.order if node.tag in ("article", "main")}
        # Whatever its name, an element around all articles of the page is none of its furniture.
        self.around: set[int] = set()
        if articles:
            held: dict[int, int] = {}
            for node in reversed(self.order):
                held[id(node)] = (id(node) in articles) + sum(held[id(child)] for child in node.elements())
            self.around = {key for key, n in held.items() if n == len(articles) and key not in articles}

    def is_furniture(self, node: Node, inside: bool) -> bool:
        """``inside``: within a main region, where a header belongs to the article."""
        if node.tag in ("html", "body", "main") or id(node) in self.around:
            return False
        if node.tag in FURNITURE:
            return True
        if not inside and (node.tag == "header" or any(_says(name, _HEADERS) for name in node.names)):
            return True
        return any(_says(name, FURNITURE_NAMES) for name in node.names)

    def blocks(self, top: Node, inside: bool = True) -> Iterator[tuple[Node, str]]:
        """(element, text) of every block below ``top`` in page order, without furniture."""
        gathered: list[str] = []

        def text() -> str:
            found = " ".join(html.unescape("".join(gathered)).split())
            gathered.clear()
            return found

        stack = [(iter(top.children), top, True)]
        while stack:
            children, block, own = stack[-1]
            for child in children:
                if isinstance(child, str):
                    gathered.append(child)
                elif self.is_furniture(child, inside):
                    continue
                elif child.tag == "br":
                    gathered.append(" ")
                else:
                    is_block = child.tag in BLOCK
                    if is_block and (found := text()):
                        yield block, found
                    stack.append((iter(child.children), child if is_block else block, is_block))
                    break
            else:
                stack.pop()
                if own and (found := text()):
                    yield block, found

    def regions(self) -> list[Node]:
        """The elements that hold the article, in page order: those of the strongest mark that have text; without a mark the one
        with the most text in paragraphs of its own; else the page.
        """
        seen, stack, inside = [], [(self.root, 0)], {}
        while stack:
            node, level_above = stack.pop()
            if self.is_furniture(node, False):
                continue
            level = 3 if node.tag == "article" else 2 if node.tag == "main" else 1 if any(_says(n, REGION_NAMES) for n in node.names) else 0
            seen.append((node, level, level_above))
            stack.extend((child, max(level, level_above)) for child in reversed(node.elements()))
        for node, _, _ in reversed(seen):
            inside[id(node)] = sum(
                len(child.strip()) if isinstance(child, str) else inside.get(id(child), 0) for child in node.children
            )
        best = max((level for node, level, _ in seen if inside[id(node)]), default=0)
        if best:
            return [node for node, level, above in seen if level == best and above < best and inside[id(node)]]
        own = [(sum(inside.get(id(c), 0) for c in node.elements() if c.tag == "p"), -i, node) for i, (node, _, _) in enumerate(seen)]
        size, _, node = max(own, key=lambda x: x[:2], default=(0, 0, self.root))
        return [node if size else self.root]


#: Child slots of two nodes are aligned by dynamic programming up to this many pairs; above, the n-th with one tag is matched
#: with the n-th.
ALIGNED_PAIRS = 4096
Slot = tuple[str, list[Node]]


def slots(node: Node) -> list[Slot]:
    """Child elements of a node, childless ones of one tag in a row as one repeated slot."""
    found: list[Slot] = []
    for child in node.elements():
        leaf = not any(isinstance(x, Node) for x in child.children)
        if leaf and found and found[-1][0] == child.tag and not any(isinstance(x, Node) for x in found[-1][1][0].children):
            found[-1][1].append(child)
        else:
            found.append((child.tag, [child]))
    return found


def _candidates(left: list[Slot], right: list[Slot]) -> list[tuple[int, int]]:
    if len(left) * len(right) <= ALIGNED_PAIRS:
        return [(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if a[0] == b[0]]
    of_tag: dict[str, list[int]] = {}
    for j, (tag, _) in enumerate(right):
        of_tag.setdefault(tag, []).append(j)
    seen: Counter = Counter()
    found = []
    for i, (tag, _) in enumerate(left):
        if seen[tag] < len(of_tag.get(tag, ())):
            found.append((i, of_tag[tag][seen[tag]]))
        seen[tag] += 1
    return found


def tree_match(a: Node, b: Node) -> tuple[int, list[tuple[list[Node], list[Node]]]]:
    """Simple tree matching of two nodes: size of the best match, and the pairs of slots in it. Works without recursion."""
    # Pairs in the order of their finding: a pair comes before the pairs below it.
    pairs: list[tuple[list[Node], list[Node]]] = [([a], [b])]
    below: list[tuple[list[Slot], list[Slot], dict[tuple[int, int], int]]] = []
    at = 0
    while at < len(pairs):
        left, right = (slots(side[0]) if len(side) == 1 else [] for side in pairs[at])
        children = {}
        if left and right:
            for i, j in _candidates(left, right):
                children[i, j] = len(pairs)
                pairs.append((left[i][1], right[j][1]))
        below.append((left, right, children))
        at += 1
    sizes = [1] * len(pairs)
    chosen: list[list[int]] = [[] for _ in pairs]
    for at in range(len(pairs) - 1, -1, -1):
        left, right, children = below[at]
        if not children:
            continue
        if len(left) * len(right) > ALIGNED_PAIRS:
            # Matched by number: those that keep the order, from the left.
            reached = -1
            for (_, j), pair in children.items():
                if j > reached:
                    reached = j
                    chosen[at].append(pair)
            sizes[at] += sum(sizes[pair] for pair in chosen[at])
            continue
        rows, columns = len(left), len(right)
        score = [[0] * (columns + 1) for _ in range(rows + 1)]
        for i in range(rows):
            above, line = score[i], score[i + 1]
            for j in range(columns):
                pair = children.get((i, j))
                gain = above[j] + sizes[pair] if pair is not None else 0
                line[j + 1] = max(above[j + 1], line[j], gain)
        i, j = rows, columns
        while i and j:
            if score[i][j] == score[i - 1][j]:
                i -= 1
            elif score[i][j] == score[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                chosen[at].append(children[i, j])
        sizes[at] += score[rows][columns]
    matched, stack = [], [0]
    while stack:
        at = stack.pop()
        matched.append(pairs[at])
        stack.extend(chosen[at])
    return sizes[0], matched


class Model:
    """The page that the others of a host are aligned with; its nodes have numbers."""

    def __init__(self, source: str | None):
        page = Page(source)
        self.root = page.root
        self.numbers = {id(node): i for i, node in enumerate(page.order)}

    def slots_of(self, page: Page) -> dict[int, str]:
        """The slot of every element of a page, by the element's id."""
        partner = {}
        for ours, theirs in tree_match(self.root, page.root)[1]:
            for node in theirs:
                partner[id(node)] = str(self.numbers[id(ours[0])])
        named: dict[int, str] = {}
        stack = [(page.root, "")]
        while stack:
            node, above = stack.pop()
            name = partner.get(id(node)) or f"{above}/{node.tag}"
            named[id(node)] = name if len(name) < 200 else hashlib.md5(name.encode()).hexdigest()
            stack.extend((child, named[id(node)]) for child in node.elements())
        return named


def _mark(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def slot_texts(page: Page, model: Model) -> list[tuple[int, int, str]]:
    """(slot, mark of the text, text) of the blocks in the main regions of a page, in order."""
    named = model.slots_of(page)
    return [(_mark(named[id(at)]), _mark(text), text) for region in page.regions() for at, text in page.blocks(region)]


def lead_of(found: list[tuple[int, int, str]]) -> int:
    """A mark of the longest blocks, which are half of a page's text."""
    left, marks = sum(len(text) for _, _, text in found) / 2, []
    for _, mark, text in sorted(found, key=lambda x: (-len(x[2]), x[1])):
        if left <= 0:
            break
        left -= len(text)
        marks.append(mark)
    return _mark(" ".join(map(str, marks)))


def main_text(source: str | None, model: Model | None = None, template: frozenset[tuple[int, int]] = frozenset()) -> str:
    """Blocks of the main regions that are not constant in the host's template, one a line."""
    page = Page(source)
    if model is None or not template:
        return "\n".join(text for region in page.regions() for _, text in page.blocks(region))
    return "\n".join(text for slot, mark, text in slot_texts(page, model) if (slot, mark) not in template)


def host_of(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def models(pages: DataFrame) -> DataFrame:
    """(host, model): of each host's pages (host, html) the one with the smallest hash, found in each task first."""
    first = F.min(F.struct(F.xxhash64("html"), "html"))
    return pages.groupBy("host").agg(first.alias("first")).select("host", F.col("first.html").alias("model"))


def _with(hosted: DataFrame, known: DataFrame, chars: int) -> DataFrame:
    """Pages with what is known of their host; above a size, a join of which adaptive execution may split a host."""
    return hosted.join(F.broadcast(known) if chars <= BROADCAST_CHARS else known, "host", "left")


class _Models:
    """The models that a task has read lately, by their source."""

    def __init__(self):
        self.made: dict[str, Model] = {}

    def of(self, source: str) -> Model:
        if source not in self.made:
            if len(self.made) > 256:
                self.made.clear()
            self.made[source] = Model(source)
        return self.made[source]


def slot_counts(modelled: DataFrame) -> DataFrame:
    """(host, slot, mark, lead): the texts in the slots of all pages (host, html, model), each once a page.

    Pages with one ``lead`` are copies of one article.
    """
    schema = pa.schema([("host", pa.string()), ("slot", pa.int64()), ("mark", pa.int64()), ("lead", pa.int64())])
    known = _Models()

    def count(batch: pa.RecordBatch) -> dict:
        rows = []
        for host, source, model in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = slot_texts(Page(source), known.of(model))
            lead = lead_of(found)
            rows.extend((host, slot, mark, lead) for slot, mark in {x[:2] for x in found})
        return {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}

    made = modelled.select("host", "html", "model").mapInArrow(batches(count, schema), "host string, slot long, mark long, lead long")
    return made


def templates(modelled: DataFrame, least: int, share: float) -> DataFrame:
    """(host, constant: array of (slot, mark)) of every host with a template, from all its pages."""
    counts = keep(slot_counts(modelled), "slots")
    texts = counts.groupBy("host", "slot", "mark").agg(F.count_distinct("lead").alias("n")).where(F.col("n") >= least)
    whole = counts.groupBy("host", "slot").agg(F.count_distinct("lead").alias("n_slot"))
    constant = texts.join(whole, ["host", "slot"]).where(F.col("n") >= share * F.col("n_slot"))
    return constant.groupBy("host").agg(F.collect_list(F.struct("slot", "mark")).alias("constant"))


def extract_text(pages: DataFrame, least: int = 3, share: float = 2 / 3) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space within a block becomes one space, blocks are lines in page order. A null
    or empty page has an empty text; a null url, or one without a host, is a host of its own; repeated rows stay, and copies
    of an article count once for the template; other columns are ignored.
    """
    hosted = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    made = keep(models(hosted), "models")
    chars = made.agg(F.sum(F.length("model"))).first()[0] or 0
    modelled = _with(hosted, made, chars)
    found = keep(made.join(templates(modelled, least, share), "host"), "templates")
    chars = found.agg(F.sum(F.length("model") + 32 * F.size("constant"))).first()[0] or 0
    known = _with(hosted, found, chars).select("page_id", "url", "html", "model", "constant")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    read = _Models()

    def extract(batch: pa.RecordBatch) -> dict:
        texts = []
        for source, model, constant in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            if model is None:
                texts.append(main_text(source))
            else:
                texts.append(main_text(source, read.of(model), frozenset((c["slot"], c["mark"]) for c in constant)))
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts}

    return known.mapInArrow(batches(extract, schema, 128), "page_id long, url string, text string")
