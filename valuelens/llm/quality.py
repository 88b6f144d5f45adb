"""Quality rules of documents and of hosts. Built-in expressions only.

A host whose documents fail a rule too often is rejected as a whole. Rates of hosts with few documents are
shrunk towards the mean of all hosts by a beta prior fitted to the hosts themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.common import SPACE, WORD, written

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_SYMBOL_PERCENT = 30
MAX_DUPLICATE_LINE_PERCENT = 50
#: The shrunk share of a host's documents that may fail each rule.
HOST_LIMITS = {"short": 0.8, "repeated": 0.8, "symbols": 0.9, "lines": 0.9}
MAX_STRENGTH = 1e6

#: ``transform(array(x), v -> ...)[0]`` binds a value to a name, so that it is worked out once per row.
_COUNTS = f"""
transform(array(filter(split(text, r'{SPACE}'), x -> x <> '')), w -> named_struct(
  'n_words', cast(size(w) AS long),
  'word_chars', aggregate(w, 0L, (a, x) -> a + char_length(x)),
  'n_symbols', cast(regexp_count(text, '[#*$%&|<>]') AS long),
  'n_lines', cast(size(lines) AS long),
  'n_dup_lines', cast(size(lines) - size(array_distinct(lines)) AS long),
  'n_repeat_words', if(size(w) < 4, 0L,
    transform(array(sort_array(transform(sequence(0, size(w) - 3), i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS i)))), z ->
      transform(array(sort_array(transform(
        filter(sequence(0, size(z) - 1), k -> z[k].h = get(z, k - 1).h OR z[k].h = get(z, k + 1).h), k -> z[k].i))), p ->
          aggregate(transform(p, (x, k) -> least(3, coalesce(get(p, k + 1) - x, 3))), 0L, (a, x) -> a + x))[0])[0])
))[0]
"""


@dataclass(frozen=True)
class Prior:
    alpha: float
    beta: float


def document_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``counts``: words, their characters, symbols, lines with a word, repeated lines, and words in
    three-word windows that occur twice or more in the text (windows are compared by a 64-bit hash).

    Null texts have no words. Nothing depends on other rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumns({"__text": text})
    lines = f"filter(split(__text, '\\n'), x -> x rlike r'{WORD}')"
    body = _COUNTS.replace("(text", "(__text").replace("lines)", "__lines)")
    return rows.withColumn("counts", F.expr(f"transform(array({lines}), __lines -> {body})[0]")).drop("__text")


def rule_failures(counts: str = "counts") -> dict[str, str]:
    """Conditions under which a document fails a rule. The first two also reject the document itself."""
    c = counts
    return {
        "short": f"{c}.n_words < {MIN_WORDS}",
        "repeated": f"100 * {c}.n_repeat_words > {MAX_REPEATED_PERCENT} * {c}.n_words",
        "symbols": f"100 * {c}.n_symbols > {MAX_SYMBOL_PERCENT} * {c}.word_chars",
        "lines": f"100 * {c}.n_dup_lines > {MAX_DUPLICATE_LINE_PERCENT} * {c}.n_lines",
    }


def fit_prior(rates: list[tuple[float, float]]) -> Prior:
    """By moments, from the mean and variance of the hosts' rates. Equal rates: as strong as is allowed."""
    ((mean, variance),) = rates
    if mean is None:
        return Prior(0.0, 1.0)
    spread = mean * (1 - mean)
    strength = MAX_STRENGTH if not variance else min(MAX_STRENGTH, max(0.0, spread / variance - 1))
    return Prior(mean * strength, (1 - mean) * strength)


def host_verdicts(judged: DataFrame, host_col: str, limits: dict[str, float]) -> DataFrame:
    """One row per host: documents, and by rule failures, shrunk rate; ``host_failed``.

    ``judged`` has a boolean column per rule. Null hosts are no host. The prior is two numbers a rule.
    """
    hosts = (
        judged.where(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("host"))
        .agg(F.count("*").alias("documents"), *(F.sum(F.col(r).cast("long")).alias(r) for r in limits))
    )
    moments = hosts.agg(
        *(f(F.col(r) / F.col("documents")).alias(f"{r}_{f.__name__}") for r in limits for f in (F.avg, F.var_pop))
    ).first()
    bad = F.lit(False)
    for rule, limit in limits.items():
        prior = fit_prior([(moments[f"{rule}_avg"], moments[f"{rule}_var_pop"])])
        rate = (F.col(rule) + prior.alpha) / (F.col("documents") + prior.alpha + prior.beta)
        hosts = hosts.withColumn(f"{rule}_rate", rate)
        bad = bad | (F.col(f"{rule}_rate") > limit)
    return hosts.withColumn("host_failed", bad)


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: dict[str, float] = HOST_LIMITS,
) -> DataFrame:
    """One row per row: id, host, counts, ``base_failed``, ``host_failed`` and ``kept``.

    Counts are written once and used twice, for the hosts and for the join. Only these narrow rows are
    shuffled, and hosts are summed before. Documents without a host are judged by themselves. An empty table
    gives no rows; repeated rows give as many and count as often.
    """
    rules = rule_failures()
    rows = document_counts(
        docs.select(
            F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host")
        )
    ).drop("text")
    rows = written(rows.withColumns({r: F.expr(c) for r, c in rules.items()}), "quality")
    hosts = host_verdicts(rows, "host", limits).select("host", "host_failed")
    failed = F.col("short") | F.col("repeated")
    host_failed = F.coalesce("host_failed", F.lit(False))
    return rows.join(hosts, "host", "left").select(
        "id",
        "host",
        "counts.*",
        failed.alias("base_failed"),
        host_failed.alias("host_failed"),
        (~failed & ~host_failed).alias("kept"),
    )
