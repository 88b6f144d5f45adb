"""The queries of this package, by name, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.llm import bpe, chat, codes, decontamination, jaccard, language, licenses, lines, passages, pii, quality, resampling, secrets
from valuelens.llm.common import table
from valuelens.llm.oracle import ORACLE

BATCH_ROWS = "512"  # of what passes to Python at once; some texts are very long
SURROGATE_KEY = "of this query"  # in production a secret
LINE_BATCHES = 2  # deliveries that the line index is built from; the second meets the first one's filters
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return table(spark, sf_dir, "documents")


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeats(_documents(spark, sf_dir))


def surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(_documents(spark, sf_dir), SURROGATE_KEY).select("doc_id", "n_entities", "text")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    file, pattern = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN
    coded = bpe.round_trip(_documents(spark, sf_dir).select("doc_id", "text"), file, pattern)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.train(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_documents(spark, sf_dir))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) AS long)").alias(f"n_{kind}")
    base = tuple(rule.kind for rule in secrets.BASE_RULES)
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(secrets.listed("spans", base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed("spans").alias("spans"),
    )


def chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_digests(rows)


def chat_digests(rows: DataFrame) -> DataFrame:
    return (
        chat.format_conversations(rows)
        .withColumn("learnt", F.expr(chat.loss_text("segments", "level")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.expr(r"array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')").cast("binary"), 256).alias("turns_sha256"),
            F.char_length("learnt").cast("long").alias("loss_chars"),
            F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_documents(spark, sf_dir).select("doc_id", "text"))
    labels = "array_join(array_sort(array_distinct({})), ',')"
    return found.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.expr("cast(size(licenses.places) AS long)").alias("n_base"),
        F.expr("array_min(licenses.places.word)").alias("first_word"),
        F.expr("array_max(licenses.places.word)").alias("last_word"),
        F.expr(labels.format("licenses.places.label")).alias("base_labels"),
        F.expr(labels.format("concat(licenses.places.label, licenses.blocks.label)")).alias("labels"),
        F.expr(
            "if(size(licenses.places) > 0, 1D, coalesce(array_max(licenses.blocks.share), 0D))"
        ).alias("score"),
    )


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = lines.deduplicated(_documents(spark, sf_dir), batches=LINE_BATCHES)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_passages": repeated_passages,
    "op2_bpe_round_trip": bpe_round_trip,
    "op3_surrogates": surrogates,
    "op4_host_rules": host_rules,
    "op5_language_id": language_id,
    "op6_jaccard_join": jaccard_join,
    "op7_secret_scan": secret_scan,
    "op8_chat_round_trip": chat_round_trip,
    "op9_license_scan": license_scan,
    "op10_benchmark_leaks": benchmark_leaks,
    "op11_line_dedup": line_dedup,
    "op12_target_resampling": target_resampling,
    "op13_vector_codes": vector_codes,
}

__all__ = ["ORACLE", "QUERIES"]
