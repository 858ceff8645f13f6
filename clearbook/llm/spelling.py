"""Spelling variants: words within one edit of each other, found by an index of variable-length grams.

**Dictionary.** Grams of ``SHORTEST`` to ``longest`` characters (with a mark at either end of a word) are counted by the words
that hold them. A gram is frequent if more than ``threshold`` words have it; only frequent grams are ever extended, so the
dictionary is the table of frequent grams. The threshold is at least the count of all grams divided by ``dictionary_rows``: by
counting there cannot be more frequent grams than that, which bounds the broadcast whatever the corpus.

**Decomposition.** From every position a word takes the shortest gram that is not frequent (at most ``longest`` characters);
a gram that lies inside the one before it is left out.

**Affected grams.** An edit at a character changes the grams that cover it. Beside these it can only hide the gram that begins
right after it, and only if that is shorter than ``longest``: all that could hide others already did. The largest such number
over a word's characters is its bound: of any ``bound + 1`` grams of a word, one is also a gram of each near word, at the same
place or, in a longer word, one further on. All words of at least ``2 * longest - 1`` characters keep such a gram.

**Merging.** So every word is listed under its ``bound + 1`` rarest grams, by gram, place and length, and meets the words of its
own length and those one shorter. In a list the places of all grams are merged: only words that share as many grams as both
bounds leave are compared. A list of over ``list_rows`` words is cut into tiles, each of which meets all words of the list.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import batches, drop_kept, keep

SHORTEST = 2
START, END = "\x02", "\x03"
#: A list with fewer words is compared word by word: that takes less than taking them apart.
MERGED = 32
#: (place, gram) of a word's grams, and its bound.
Grams = tuple[list[tuple[int, str]], int]


def variable_grams(word: str, frequent: Mapping[str, int], longest: int) -> Grams:
    """A word's grams with their places, and the most of them that one edit can change."""
    marked = START + word + END
    size, covered, grams = len(marked), 0, []
    for start in range(size - SHORTEST + 1):
        end = start + SHORTEST
        while end < size and end - start < longest and marked[start:end] in frequent:
            end += 1
        if end > covered:
            grams.append((start, marked[start:end]))
            covered = end
    changed = [0] * (size + 1)
    for start, gram in grams:
        for place in range(start, start + len(gram)):
            changed[place] += 1
        if start and len(gram) < longest:
            changed[start - 1] += 1
    return grams, max(changed[1 : size - 1])


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def near_pairs(
    listed: list[str], others: list[str], frequent: Mapping[str, int], longest: int, among: bool = True
) -> Iterator[tuple[str, str]]:
    """Pairs of near words in one list: of ``listed``, which have one length, ``among`` them if wanted, and with ``others``, as
    long or one shorter.

    Of two words of one length the smaller comes first; others that follow the listed word in order are left to its tile.
    """
    if len(listed) < MERGED:
        for i, word in enumerate(listed):
            yield from ((min(word, x), max(word, x)) for x in (listed[:i] if among else ()) if one_edit(word, x))
            yield from ((x, word) for x in others if (len(x) < len(word) or x < word) and one_edit(x, word))
        return
    lists: dict[tuple[int, str], list[int]] = defaultdict(list)
    needed = []
    for i, word in enumerate(listed):
        grams, bound = variable_grams(word, frequent, longest)
        needed.append(len(grams) - bound)
        for gram in grams:
            lists[gram].append(i)
    length = len(listed[0])
    for place, word in enumerate([*listed, *others]):
        if place < len(listed) and not among:
            continue
        grams, bound = variable_grams(word, frequent, longest)
        least, shared = len(grams) - bound, Counter()
        for start, gram in grams:
            shared.update(lists.get((start, gram), ()))
            if len(word) < length:
                shared.update(lists.get((start + 1, gram), ()))
        for i, n in shared.items():
            if n < least or n < needed[i]:
                continue
            other = listed[i]
            if (len(word) < length or (i < place if place < len(listed) else word < other)) and one_edit(word, other):
                yield (word, other) if len(word) < length else (min(word, other), max(word, other))


def gram_counts(words: DataFrame, longest: int) -> DataFrame:
    """(gram, n): in how many words of ``words`` (word, distinct) each gram stands."""
    schema = pa.schema([("gram", pa.string()), ("n", pa.int64())])

    def count(batch: pa.RecordBatch) -> dict:
        found: Counter[str] = Counter()
        for word in batch.column(0).to_pylist():
            marked = START + word + END
            found.update(
                {marked[i : i + size] for size in range(SHORTEST, longest + 1) for i in range(len(marked) - size + 1)}
            )
        return {"gram": list(found), "n": list(found.values())}

    made = words.select("word").mapInArrow(batches(count, schema, 8192), "gram string, n long")
    return made.groupBy("gram").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame, longest: int, threshold: int, dictionary_rows: int) -> dict[str, int]:
    """The counts of all grams that more than ``threshold`` words have; the threshold rises as ``dictionary_rows`` asks."""
    counts = keep(gram_counts(words, longest), "grams")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(threshold, -(-total // dictionary_rows))
    return {row.gram: row.n for row in counts.where(F.col("n") > least).toLocalIterator()}


def near_words(
    words: DataFrame, least_chars: int, threshold: int = 32, dictionary_rows: int = 200_000, list_rows: int = 4096
) -> DataFrame:
    """(a, b), each pair once, of words that differ by exactly one code point; ``words`` (word: distinct, a written table)."""
    longest = (least_chars + 1) // 2
    if longest < SHORTEST:
        raise ValueError("words must have at least 3 characters")
    sent = words.sparkSession.sparkContext.broadcast(frequent_grams(words, longest, threshold, dictionary_rows))
    schema = pa.schema(
        [("gram", pa.string()), ("place", pa.int32()), ("length", pa.int32()), ("own", pa.bool_()), ("word", pa.string())]
    )

    def listed(batch: pa.RecordBatch) -> dict:
        frequent, rows = sent.value, []
        for word in batch.column(0).to_pylist():
            grams, bound = variable_grams(word, frequent, longest)
            for _, gram, start in sorted((frequent.get(gram, 0), gram, start) for start, gram in grams)[: bound + 1]:
                rows.append((gram, start, len(word), True, word))
                rows.extend((gram, start + step, len(word) + 1, False, word) for step in (0, 1))
        return {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}

    key = ["gram", "place", "length"]
    kind = "gram string, place int, length int, own boolean, word string"
    rows = keep(words.select("word").mapInArrow(batches(listed, schema, 8192), kind), "lists")
    # A long list becomes a grid: tiles of its own words, and chunks of all that meet them.
    sizes = rows.groupBy(*key).agg(F.count_if("own").alias("n"), F.count("*").alias("n_all"))
    tiles, chunks = F.ceil(F.col("n") / list_rows).cast("int"), F.ceil(F.col("n_all") / (4 * list_rows)).cast("int")
    sizes = sizes.select(*(F.col(name).alias(f"_{name}") for name in key), tiles.alias("tiles"), chunks.alias("chunks"))
    sizes = keep(sizes.where((F.col("tiles") > 1) | (F.col("chunks") > 1)), "long")
    same = F.lit(True)
    for name in key:
        same &= F.col(name) == F.col(f"_{name}")
    tiles, chunks = F.greatest(F.col("tiles"), F.lit(1)), F.coalesce("chunks", F.lit(1))
    cut = rows.join(sizes, same, "left").select(
        *key, "own", "word", tiles.alias("tiles"), chunks.alias("chunks"),
        F.pmod(F.xxhash64("word"), tiles).cast("int").alias("own_tile"),
        F.pmod(F.xxhash64("word", F.lit("chunk")), chunks).cast("int").alias("own_chunk"),
    )
    every_tile = F.sequence(F.lit(0), F.col("tiles") - 1)
    other_tiles = F.filter(every_tile, lambda tile: ~F.col("own") | (tile != F.col("own_tile")))
    as_other = F.transform(other_tiles, lambda tile: F.struct(tile.alias("tile"), F.col("own_chunk").alias("chunk"), F.lit(False).alias("listed")))
    as_listed = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda chunk: F.struct(F.col("own_tile").alias("tile"), chunk.alias("chunk"), F.lit(True).alias("listed")),
    )
    cells = F.when(F.col("own"), F.concat(as_listed, as_other)).otherwise(as_other)
    dealt = cut.select(*key, "word", F.explode(cells).alias("cell")).select(*key, "word", "cell.*")
    lists = (
        dealt.groupBy(*key, "tile", "chunk")
        .agg(
            F.collect_list(F.when(F.col("listed"), F.col("word"))).alias("listed"),
            F.collect_list(F.when(~F.col("listed"), F.col("word"))).alias("others"),
        )
        .where("size(listed) > 0 and size(listed) + size(others) > 1")
    )
    pairs = pa.schema([("a", pa.string()), ("b", pa.string())])

    def merge(batch: pa.RecordBatch) -> dict:
        found = set()
        for own_words, others, chunk in zip(*(batch.column(i).to_pylist() for i in range(3))):
            # Words of one tile meet each other once, not in every chunk.
            found.update(near_pairs(own_words, others, sent.value, longest, among=chunk == 0))
        return {"a": [a for a, _ in found], "b": [b for _, b in found]}

    made = lists.select("listed", "others", "chunk").mapInArrow(batches(merge, pairs, 4096), "a string, b string")
    return made.distinct()


def word_runs(docs: DataFrame, letters: str = r"A-Za-zÀ-ÿ", least_chars: int = 6) -> DataFrame:
    """(doc_id, run): maximal runs of ``letters`` of at least ``least_chars`` in each text, A-Z in lower case; null has none."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{letters}]{{{least_chars},}}"), 0)
    run = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", run.alias("run"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word that following the forms leads to, by doubling the steps."""
    at = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = at.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = at.join(following, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
        )
        after = keep(moved, "roots")
        drop_kept(at)
        at = after
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def variant_groups(
    words: DataFrame, least_chars: int = 6, least_n: int = 5, ratio: int = 5, list_rows: int = 4096
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct words of ``words`` (word: string, n: long).

    Words of at least ``least_chars`` code points and ``least_n`` occurrences overall take part; null words do not, and rows
    that repeat a word are added up. Two words are near if they differ by exactly one inserted, deleted or replaced code
    point, and n_near counts them. A word's form is its near word of largest n (ties: the smaller in code-point order) if that
    is at least ``ratio`` times its own, else null; its root is where following the forms ends, the word itself if it has
    none. Other columns are ignored; an empty table gives no rows.
    """
    if ratio < 2 or least_n < 1:
        raise ValueError("forms must be more frequent than their variants")
    counted = words.where(F.length("word") >= least_chars).groupBy("word").agg(F.sum("n").alias("n"))
    counted = keep(counted.where(F.col("n") >= least_n), "words")
    pairs = keep(near_words(counted, least_chars, list_rows=list_rows), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))
    )
    weighed = both.join(counted.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = weighed.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = counted.join(near, "word", "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    formed = keep(
        joined.select(
            "word",
            F.when(enough, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
