"""A corpus pipeline over the documents table, from language identification to a mix of sources.

Every stage takes (spark, docs, sf_dir) and all rows that the stage before it kept.  All stages read whole texts,
however long; take tables without rows, which stay so; and hand on the columns of documents, further ones being left
behind, whatever they are called.  What they do with nulls, ties and repeated rows, their docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches, materialize, read, word_count
from tallyforge.llm.decontaminate import drop_leaks
from tallyforge.llm.language_id import fit_gate, has_language
from tallyforge.llm.line_dedup import dedup_lines
from tallyforge.llm.mixing import cycle_weights, mix_sources
from tallyforge.llm.ngram_join import keep_one_of_each

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# The languages of texts can't be learned in SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language like those of the labelled ones: texts without a letter, and letters that are no
    language by a network with a calibrated limit, go.  Where none could be trained all texts with a letter stay.

    Null and empty texts go; a null id, label or source decides nothing.  Equal texts, and so repeated rows, all stay
    or all go; a text at the limit stays."""
    bounded_batches(spark)
    return docs.filter(has_language(fit_gate(docs), F.col("text"))).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go from the text; n_chars follows.

    Every row stays.  Null texts become empty ones.  Rows without an id lose no line and make no other lose one.  Of
    equal lines that with the smallest id stays; repeated rows of one id are one document and lose the same lines."""
    return dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, stays of each group of similar ones.

    Texts that are null or have no word are similar to nothing and stay, as do rows without an id.  Repeated rows of
    the id that stays all stay."""
    return keep_one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null texts hold none; items without a word are in none; rows without an id count as one document, so they all go
    if one of them holds an item.  Repeated rows all stay or all go.  A similarity of exactly 0.8 is enough."""
    return drop_leaks(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their size in words, the words taken and the times they are repeated.

    Documents without a word have nothing to take and go.  A null source is a source of its own.  Among rows of one id
    and size, repeated rows among them, which are taken makes no difference; other ties are settled by a seeded hash
    of the id, so that reruns agree."""
    sized = docs.select(*COLUMNS).withColumn("size", word_count(F.col("text"))).withColumn("members", F.array("source"))
    mix = mix_sources(materialize(sized, "pipeline-sizes"), "members", "size", F.col("doc_id"), cycle_weights)
    repeats = (F.col("taken") / F.col("size")).cast("int").alias("repeats")
    return mix.rows.filter("taken > 0").select(*COLUMNS, "size", "taken", repeats)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
