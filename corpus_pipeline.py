"""The pipeline: language identification, near-duplicate removal, decontamination, secrets, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all that the stage before
kept. ``run`` writes what each returns as Parquet and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.llm import bpe, decontamination, jaccard, language, secrets
from valuelens.llm.common import table, written
from valuelens.llm.queries import VOCABULARY, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the labelled ones teach; the label itself is not asked.

    Rejected are texts that are null or have no letter, and those that no learnt language is likelier for than
    all others together. Without labelled documents nothing is learnt, and nothing is kept.
    """
    small_batches(spark)
    found = language.identify(docs.select(COLUMNS), language.train(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= 0.5)).select(COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """With ``row_key``, a hash of id and text, null or not: rows of one key are copies."""
    return docs.select(COLUMNS).withColumn("row_key", F.xxhash64("doc_id", "text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, one without id only if none has one.

    Rows with equal ids and texts are copies, of which one stays. Rows that repeat an id with another text are
    documents of their own, and so are rows without an id.
    """
    small_batches(spark)
    rows = keyed(docs)
    placed = jaccard.join(rows, id_col="row_key").select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    named = rows.select("row_key", "doc_id").distinct().join(placed, "row_key")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    stays = named.groupBy("component_id").agg(first.alias("first")).select("first.row_key").distinct()
    kept = rows.join(stays, "row_key", "left_semi").withColumn("text_hash", F.hash("text"))
    return kept.dropDuplicates(["row_key", "doc_id", "text_hash"]).select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with or without an id; others of the same id stay."""
    small_batches(spark)
    rows = keyed(docs)
    leaks = decontamination.find(rows, table(spark, sf_dir, "benchmark"), id_col="row_key")
    return rows.join(leaks.select(F.col("doc_id").alias("row_key")).distinct(), "row_key", "left_anti").select(COLUMNS)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a note of their kind; every document stays."""
    text = F.when(F.size("spans") > 0, secrets.redacted()).otherwise(F.col("text"))
    scanned = secrets.scan(docs.select(COLUMNS)).withColumn("text", text)
    return scanned.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, proven by decoding them again."""
    small_batches(spark)
    file, pattern = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN
    coded = bpe.round_trip(docs.select(COLUMNS), file, pattern)
    whole = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    checked = F.when(whole, F.col("ids")).otherwise(F.raise_error(F.lit("tokens do not decode to the text")))
    return coded.select(
        "doc_id", "lang", "source", "n_chars", checked.cast("binary").alias("ids"), (F.length("ids") / 4).cast("long").alias("n_tokens")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language-id", language_id),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", scan_secrets),
    ("tokens", tokenize),
]

#: Naive Bayes, edit distances and byte-pair merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
