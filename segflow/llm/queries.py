"""Registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from segflow.llm import ann, bpe, chat, collocations, exact_search, language_id, lexical, line_dedup, mixing, pii, quality, sharding, simhash
from segflow.llm.checks import chat_sql, collocation_sql, exact_search_sql, lexical_sql, quality_sql
from segflow.llm.common import table
from segflow.session import stored

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; learned from three quarters of them."""
    docs = table(spark, folder, "documents")
    model = language_id.fit(docs.where(language_id.learns(F.col("doc_id"))))
    predicted = language_id.predict(docs.select("doc_id", "text"), model, drop=["text"])
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document a mix by weights 5, 2, 1 takes, and in which shards."""
    rows = stored(mixing.sized(table(spark, folder, "documents")), "sizes")
    taken = mixing.taken_words(mixing.mix(rows, weights=(5, 2, 1), most=3))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "pieces")


def op3_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of every embedding whose id is divisible by 20."""
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of every text's ids and of what they decode to."""
    vocabulary = bpe.load(spark, public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokens = bpe.encode(docs, vocabulary, decoded=True, drop=["text"])
    return tokens.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op5_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, dropped lines and digest of what is left of every document."""
    cut = line_dedup.drop_lines(table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cut.select("doc_id", "n_lines", "n_dropped", digest.alias("text_sha256"))


def op6_shard_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and place of every document; 24 shards of near equal bytes."""
    placed = sharding.shard(table(spark, folder, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of the standard table of thresholds for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge(docs).drop("text")


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and spans, and all spans, of every document."""
    found = stored(pii.find(table(spark, folder, "documents").select("doc_id", "text")), "spans")
    spans = pii.decide(found, pii.fit(found))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.sha2(pii.names_of(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return spans.select("doc_id", *[number(k) for k in pii.BASE], base, pii.names_of(F.col("spans")).alias("spans"))


def op9_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    """What the windows of every conversation say when read back, and their length."""
    read = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    pair = spark.range(2).select(F.lit(-7).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), said)
    back = chat.read_back(chat.format_conversations(read.union(pair)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return back.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        digest(lines).alias("turns_sha256"),
        F.length("targets").cast("long").alias("loss_chars"),
        digest(F.col("targets")).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document; three-word shingles, two bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"), width=3, distance=2)


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    return collocations.collocations(table(spark, folder, "documents"))


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 rows with the largest whole-number inner product for every 50th embedding."""
    return exact_search.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=50)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


_ALL = (
    op1_language_id, op2_mix_sources, op3_learned_partitions, op4_bpe_round_trip, op5_line_templates, op6_shard_by_bytes,
    op7_quality_rules, op8_personal_data, op9_chat_windows, op10_simhash_near_dedup, op11_phrase_collocations, op12_exact_top_k,
    op13_ranked_search, pipeline,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}
SQL: dict[str, str] = {
    "op7_quality_rules": quality_sql(),
    "op9_chat_windows": chat_sql(),
    "op11_phrase_collocations": collocation_sql(),
    "op12_exact_top_k": exact_search_sql(),
    "op13_ranked_search": lexical_sql(),
}
