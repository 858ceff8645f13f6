"""Mixing sources to target weights: whole epochs first, then an Efraimidis-Spirakis sample for the rest.

The sources share all words by weight; a target stops at ``epochs`` times its source and what it cannot take is shared
anew. Of a source that is to be taken q + f times, every document is taken q times; the words for f are drawn without
replacement: each document has the key -ln(u) / weight, with u from a hash of its id, and documents are taken in the
order of the keys up to the budget. The document at the edge gives the words that are still missing.

A source is never sorted in one task. The order is cut into ``bins`` ranges of the key and each of those of the edge into
``bins`` more by the hash; sums per range, combined on the map side, say which range holds the edge, and only its
documents are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbook.llm.shared import keep, keep_counted

#: Weights of the sources in their order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
EPOCHS = 3


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and \\x09-\\x0D; 0 for a null text."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+", "\x01")
    return F.length(F.translate(marked, " \t\n\x0b\f\r", "")).cast("long")


def unit_hash(doc_id: Column) -> Column:
    """A number above 0 and at most 1 from the MD5 of the id as text; the same in any engine."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 1) / float(1 << 48)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) a source.

    Targets are min(level * weight, epochs * size) with the level at which they sum to all words. Sources in the order of
    the level at which they stop are full as long as the level for the others is not below theirs.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * epochs).cast("double")
    weighed = ranked.withColumn("_weight", weight).withColumn("_limit", limit).withColumn("_stop", limit / weight)
    full = Window.orderBy("_stop", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("_stop", "_rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("_stop", "_rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The level if the sources before this one are full and this one and all after it are not.
    levels = weighed.withColumn("_total", F.sum("source_size").over(everything).cast("double")).withColumn(
        "_level",
        (F.col("_total") - F.coalesce(F.sum("_limit").over(full), F.lit(0.0))) / F.sum("_weight").over(rest),
    )
    open_level = F.min(F.when(F.col("_level") < F.col("_stop"), F.struct("_stop", "_rank", "_level"))).over(everything)
    target = F.when(
        open_level.isNull() | (F.struct("_stop", "_rank") < F.struct(open_level["_stop"], open_level["_rank"])),
        F.col("_limit"),
    ).otherwise(F.least(F.col("_weight") * open_level["_level"], F.col("_limit")))
    return levels.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: DataFrame | None = None, bins: int = 4096) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, taken.

    ``weights`` (doc_id, weight) are the quality weights: a document of twice the weight is as likely again to come first,
    one of weight 0 or less comes last. Documents without a weight have 1; of several weights the smallest counts. They
    are joined to the sizes, so no text is shuffled. Null texts have size 0 and give nothing. A null source is a source of
    its own, the last. Rows that repeat a doc_id have the same key, and the smaller comes first; reruns agree.
    """
    table = keep(docs.select(F.col("doc_id").cast("long"), "source", word_count(F.col("text")).alias("size")), "sizes")
    chance = F.lit(1.0)
    if weights is not None:
        known = weights.where("doc_id is not null and weight is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        table = table.join(known.agg(F.min("weight").cast("double").alias("weight")), "doc_id", "left")
        chance = F.coalesce("weight", F.lit(1.0))
    key = F.when(chance > 0, -F.log(unit_hash(F.col("doc_id"))) / chance).otherwise(F.lit(float("inf")))
    table = keep(table.select("doc_id", "source", "size", key.alias("key")), "keys")
    sizes = table.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, sources = keep_counted(source_targets(sizes), "targets")
    few = sources <= 100_000  # one row a source is small enough to broadcast
    budgets = targets.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.coalesce(F.floor(F.col("target") / F.col("source_size")), F.lit(0)).alias("whole"),
    ).withColumn("budget", F.floor("target") - F.col("whole") * F.col("source_size"))
    placed = table.join(F.broadcast(budgets) if few else budgets, F.col("source").eqNullSafe(F.col("_source")))
    # exp(-key) spreads the keys over 0 to 1; the finer bins are equal parts of a bin.
    spread = (1 - F.exp(-F.col("key"))) * bins
    coarse = F.least(F.floor(spread), F.lit(bins - 1))
    fine = F.least(F.floor((spread - coarse) * bins), F.lit(bins - 1))
    cut = placed.withColumn("coarse", coarse).withColumn("fine", fine)
    first = _edge(cut.groupBy("_source", "coarse").agg(F.sum("size").alias("sum"), F.first("budget").alias("budget")), "coarse")
    inside = cut.join(first.drop("budget"), F.col("_source").eqNullSafe(F.col("_edge_source"))).drop("_edge_source")
    edge = inside.where("coarse = coarse_edge")
    second = _edge(
        edge.groupBy("_source", "fine").agg(
            F.sum("size").alias("sum"), F.first(F.col("budget") - F.col("coarse_before")).alias("budget")
        ),
        "fine",
    )
    both = first.join(second.drop("budget").withColumnRenamed("_edge_source", "_fine_source"),
                      F.col("_edge_source").eqNullSafe(F.col("_fine_source")), "left")
    both = keep(both.drop("budget", "_fine_source"), "edges")
    dealt = cut.join(F.broadcast(both) if few else both, F.col("_source").eqNullSafe(F.col("_edge_source")), "left")
    place = F.struct("coarse", "fine")
    border = F.struct(F.col("coarse_edge").alias("coarse"), F.col("fine_edge").alias("fine"))
    before = dealt.where(F.col("coarse_edge").isNull() | (place < border)).withColumn(
        "part", F.when(F.col("coarse_edge").isNull(), F.lit(0)).otherwise(F.col("size"))
    )
    after = dealt.where(place > border).withColumn("part", F.lit(0))
    order = Window.partitionBy("_source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.col("coarse_before") - F.col("fine_before") - F.coalesce(F.sum("size").over(order), F.lit(0))
    at = dealt.where(place == border).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    parts = before.unionByName(at).unionByName(after)
    taken = (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken")
    return parts.select("doc_id", "source", "size", "source_size", F.col("target"), taken)


def _edge(sums: DataFrame, name: str) -> DataFrame:
    """Of each source, the first bin at which the running sum passes the budget, and the sum before it."""
    running = F.sum("sum").over(Window.partitionBy("_source").orderBy(name)) - F.col("sum")
    found = sums.withColumn("_before", running).where((F.col("_before") <= F.col("budget")))
    last = found.groupBy("_source").agg(F.max(F.struct(name, "_before", "budget")).alias("_last"))
    return last.select(
        F.col("_source").alias("_edge_source"),
        F.col(f"_last.{name}").alias(f"{name}_edge"),
        F.col("_last._before").alias(f"{name}_before"),
        F.col("_last.budget").alias("budget"),
    )
