"""From raw documents to token ids, in five stages.

Language identification, line dedup, near-dedup, mixing and encoding, each over all rows
that the stage before it kept. Every stage returns the columns of documents but the
last, which adds token ids. A stage's result is written before the next one reads it.

All stages read whole texts of any length and pass columns beyond those of documents through,
whatever their names, but for the last, which names its columns. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.llm import bpe, language_id, line_dedup, mixing, simhash
from segflow.llm.common import boxed, unboxed
from segflow.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a letter and those of ambiguous language go. The language column
    stays as it came: a prediction does not overwrite a label. Null and empty texts have no
    letter; equal rows have equal predictions and stay or go together."""
    model = language_id.fit(docs.where(language_id.learns(F.col("doc_id"))))
    judged = language_id.predict(docs.select(boxed(docs).alias("_doc"), "text"), model, drop=["text"])
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & ~F.col("ambiguous")
    return unboxed(judged.where(sure), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines of recurring templates go from all documents but one; documents without a
    word after that go too. What keeps a line has its words, so no line is lost with
    them. ``n_chars`` is counted anew. A null text stays null, an empty one empty; rows with
    equal id and text are one document. Of documents with a line, the one with the smallest hash
    keeps it."""
    cut = line_dedup.cut_lines(docs)
    kept = cut.where((F.col("n_dropped") == 0) | (F.col("own_share") > 0))
    n_chars = F.length(F.col("_doc")["text"]).cast(docs.schema["n_chars"].dataType)
    return unboxed(kept.withColumn("_doc", F.col("_doc").withField("n_chars", n_chars)), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, of several
    with that id the one whose text has the smallest hash. Null and empty texts are duplicates
    of each other; rows without an id stay, as they cannot be told apart."""
    return simhash.keep_one(docs, width=3, distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as the mix takes them: a row for each pass, with the words it takes, in the
    order of the shards drawn. Documents without a word are not taken; a null source is a source;
    equal rows are taken one by one."""
    return mixing.mixed_texts(docs, weights=(5, 2, 1), most=3)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every row; a null or empty text has none, and equal rows equal ones."""
    vocabulary = bpe.load(spark, public_tokenizers.path("word_bpe_49k.json"))
    return bpe.encode(docs.select("doc_id", "source", "lang", "text"), vocabulary, drop=["text"])


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

#: Learned and pseudo-random stages have no SQL; tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
