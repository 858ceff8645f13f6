"""Named queries of the operators over the sample tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.llm import severity
from clearbook.llm.decontaminate import find_leaks
from clearbook.llm.html_text import extract_text
from clearbook.llm.line_dedup import drop_common_lines
from clearbook.llm.merkle import document_leaves, manifest
from clearbook.llm.mixing import mix
from clearbook.llm.neighbours import nearest
from clearbook.llm.oracles import LINES, MERKLE, MIXING, SPELLING
from clearbook.llm.passages import repeated_passages
from clearbook.llm.quality import fit, quality_scores
from clearbook.llm.shared import read_table
from clearbook.llm.simhash_dedup import hex_code, simhash_components
from clearbook.llm.spelling import variant_groups, word_runs
from clearbook.llm.token_counts import count_tokens
from clearbook.llm.tool_calls import link_calls

Query = Callable[[SparkSession, str], DataFrame]


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    learnt = labels.where(~held_out(F.col("doc_id")))
    share = learnt.agg(F.avg("toxic")).first()[0]
    model = severity.fit(docs, severity.graded(docs, learnt), share=share)
    return severity.score_severity(docs, model)


#: Tools that the turns of a conversation are read as calls of.
TOOL_SCHEMAS = {
    "search": {
        "type": "object",
        "required": ["query", "turn"],
        "properties": {"query": {"type": "string", "minLength": 1, "maxLength": 2000}, "turn": {"type": "integer"}},
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "required": ["query", "turn", "words"],
        "properties": {
            "query": {"type": "string"},
            "turn": {"type": "integer", "minimum": 0},
            "words": {"type": "integer", "minimum": 3},
        },
    },
}


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no tool calls of its own: a user's turn is read as a call whose arguments hold it, building on the
    user's turn before; the assistant's next turn is the result.
    """
    turns = read_table(spark, sf_dir, "conversations")
    name = F.concat_ws("-", F.col("conv_id"), F.col("turn"))
    words = F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), " ")).alias("words")
    plain = F.to_json(F.struct("turn", F.coalesce("text", F.lit("")).alias("query")))
    counted = F.to_json(F.struct(words, "turn", F.coalesce("text", F.lit("")).alias("query")))
    # to_json leaves out what is null, which the schema then finds missing.
    calls = turns.where("role = 'user'").select(
        "conv_id", "turn", name.alias("call_id"), F.when(F.col("turn") % 2 == 0, "search").otherwise("translate").alias("name"),
        F.when(F.col("turn") % 2 == 0, plain).otherwise(counted).alias("arguments"),
        F.concat_ws("-", F.col("conv_id"), F.col("turn") - 2).alias("parent_id"),
    )
    asked = F.concat_ws("-", F.col("conv_id"), F.col("turn") - 1).alias("call_id")
    results = turns.where("role = 'assistant'").select("conv_id", "turn", asked, F.col("text").alias("content"))
    return link_calls(calls, results, TOOL_SCHEMAS)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    # Labelled good counts double, labelled bad a quarter, unlabelled once.
    weight = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.25)
    return mix(docs, labels.select("doc_id", weight.alias("weight")))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    learnt = labels.where(~held_out(F.col("doc_id")))
    scored = quality_scores(docs, fit(docs, learnt))
    score = F.col("quality_score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= 0.3).cast("int").alias("predicted"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_code(F.col("code")).alias("fingerprint"), "component_id")


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every so often a run loses a character, by a hash of its document and itself: misspellings of known words."""
    runs = word_runs(read_table(spark, sf_dir, "documents"), least_chars=6)
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    marked = runs.withColumn("h", F.crc32(name.cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = marked.select(F.when(F.col("h") % 199 == 0, shorter).otherwise(F.col("run")).alias("word"))
    return variant_groups(words.groupBy("word").agg(F.count("*").alias("n")), least_chars=6, least_n=5, ratio=5)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    proved = manifest(document_leaves(docs, marked, F.translate("text", UPPER, LOWER)))
    return proved.drop("source")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_common_lines(read_table(spark, sf_dir, "documents"), least_docs=10, least_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_tool_calls": op2_tool_calls,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_neighbours": op5_neighbours,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_passages": op8_passages,
    "op9_html": op9_html,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling": op11_spelling,
    "op12_merkle": op12_merkle,
    "op13_line_dedup": op13_line_dedup,
}

SQL: dict[str, str] = {"op4_mixing": MIXING, "op11_spelling": SPELLING, "op12_merkle": MERKLE, "op13_line_dedup": LINES}
