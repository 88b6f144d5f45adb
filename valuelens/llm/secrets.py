"""Secret scans by way of an inverted index of trigrams. Built-in expressions only.

From each rule's pattern a Boolean query is derived: alternatives of trigrams that a match cannot do without.
Postings of these trigrams are intersected, and only texts that remain are searched for the rule. Rules without
a mandatory trigram search every text.
"""

from __future__ import annotations

import re._constants as codes
import re._parser as patterns
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_STRINGS = 64
MAX_CLASS = 8


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters; other matches are dropped after the search."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


ASSIGN = Rule(
    "assign",
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    group=2,
    least=6,
)
BASE_RULES = (ASSIGN, Rule("access", r"AKIA[A-Z0-9]+", least=20), Rule("hex", r"[0-9a-f]{24,}"))
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


class _Runs:
    """Collects what a match must contain: runs of adjacent strings, each run a set of possibilities."""

    def __init__(self):
        self.done: list[set[str]] = []
        self.now: set[str] = {""}

    def cut(self) -> None:
        self.done.append(self.now)
        self.now = {""}

    def follow(self, strings: set[str] | None) -> None:
        if strings is None or len(strings) * len(self.now) > MAX_STRINGS:
            self.cut()
        if strings is not None and len(strings) <= MAX_STRINGS:
            self.now = {a + b for a in self.now for b in strings}


def _members(items) -> set[str] | None:
    """The lower-cased characters of a class, if they are few."""
    found: set[str] = set()
    for code, value in items:
        if code is codes.LITERAL:
            found.add(chr(value).lower())
        elif code is codes.RANGE and value[1] - value[0] < 4 * MAX_CLASS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MAX_CLASS else None


def _exact(tree) -> set[str] | None:
    """All strings that the tree matches, lower-cased, if they are few."""
    runs = _Runs()
    _walk(tree, runs)
    return None if runs.done else runs.now


def _walk(tree, runs: _Runs) -> None:
    for code, value in tree:
        if code is codes.LITERAL:
            runs.follow({chr(value).lower()})
        elif code is codes.IN:
            runs.follow(_members(value))
        elif code is codes.SUBPATTERN:
            _walk(value[3], runs)
        elif code is codes.BRANCH:
            branches = [_exact(b) for b in value[1]]
            runs.follow(None if None in branches else set().union(*branches))
        elif code in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT):
            least, most, inner = value
            once = _exact(inner)
            if (least, most) == (0, 1):
                runs.follow(None if once is None else once | {""})
                continue
            for _ in range(min(least, 3)):
                runs.follow(once)
            if not least == most <= 3:
                runs.cut()
        elif code is not codes.AT:
            runs.cut()


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives; a lower-cased text with a match has all trigrams of one of them. None: nothing is mandatory."""
    runs = _Runs()
    _walk(patterns.parse(pattern), runs)
    runs.cut()
    clauses = []
    for run in runs.done:
        if all(len(s) >= 3 for s in run):
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
            clauses.append({s for s in sets if not any(other < s for other in sets)})
    if not clauses:
        return None
    query = {frozenset()}
    for clause in sorted(clauses, key=len):
        if len(query) * len(clause) <= MAX_STRINGS:
            query = {a | b for a, b in product(query, clause)}
    return sorted((q for q in query if not any(other < q for other in query)), key=sorted)


def query_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """kind, alternative, trigram, needed: a few dozen rows, whatever the input."""
    rows = [
        (rule.kind, i, trigram, len(alternative))
        for rule in rules
        for i, alternative in enumerate(trigram_query(rule.pattern) or [])
        for trigram in sorted(alternative)
    ]
    return spark.createDataFrame(rows, "kind string, alternative int, trigram string, needed int")


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """trigram, id, text_hash: for those trigrams that some query asks for."""
    listed = F.array(*map(F.lit, trigrams)).cast("array<string>")
    present = F.expr("transform(array(lower(text)), low -> filter(listed, g -> contains(low, g)))[0]")
    return (
        docs.withColumn("listed", listed)
        .select("id", "text_hash", F.explode(present).alias("trigram"))
    )


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """id, text_hash, kinds: texts whose postings fulfil the query of a rule."""
    queries = query_table(docs.sparkSession, rules)
    trigrams = sorted({t for rule in rules for a in trigram_query(rule.pattern) or [] for t in a})
    return (
        postings(docs, trigrams)
        .join(F.broadcast(queries), "trigram")
        .groupBy("id", "text_hash", "kind", "alternative", "needed")
        .agg(F.size(F.collect_set("trigram")).alias("found"))
        .where("found = needed")
        .groupBy("id", "text_hash")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def spans_of(rule: Rule, place: int) -> str:
    """The rule's matches in ``text``, from left to right: start, place among the kinds, end, kind."""
    pattern = _literal(rule.pattern)
    values = f"regexp_extract_all(text, {pattern}, {rule.group})"
    return f"""transform(array(struct(split(text, {pattern}, -1) AS parts,
        regexp_extract_all(text, {pattern}, 0) AS whole, {values} AS vals)), m ->
      aggregate(sequence(0, size(m.parts) - 1),
        struct(0L AS at, cast(array() AS array<struct<start: bigint, place: int, end: bigint, kind: string>>) AS found),
        (a, i) -> if(i >= size(m.whole), a, struct(
          a.at + char_length(m.parts[i]) + char_length(m.whole[i]) AS at,
          if(char_length(m.vals[i]) < {rule.least}, a.found, array_append(a.found, struct(
            a.at + char_length(m.parts[i]) AS start, {place} AS place,
            a.at + char_length(m.parts[i]) + char_length(m.whole[i]) AS end, '{rule.kind}' AS kind))) AS found)),
        a -> a.found))[0]"""


def _literal(pattern: str) -> str:
    """As a SQL string, without any escape that SQL would change."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Adds ``spans``: start, place, end, kind of all matches, by start, then by the order of the rules.

    Places are code points, ends exclusive. Null texts are empty. Every row of the input is returned once; rows
    with equal id and text are looked up together and each gets the result. A column ``spans`` is replaced.
    Candidates are joined by id and a hash of the text, both compared null-safely, so that missing or
    repeated ids do no harm.
    """
    rows = docs.drop("spans").withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    narrow = rows.select(F.col(id_col).alias("id"), F.col("__text").alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    listed = tuple(r for r in rules if trigram_query(r.pattern))
    found = candidates(narrow, listed)
    joined = rows.withColumn("__hash", F.xxhash64("__text")).join(
        found.select(F.col("id").alias("__id"), F.col("text_hash").alias("__found_hash"), F.col("kinds").alias("__kinds")),
        F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__found_hash")),
        "left",
    )
    empty = "cast(array() AS array<struct<start: bigint, place: int, end: bigint, kind: string>>)"
    parts = []
    for place, rule in enumerate(rules):
        spans = spans_of(rule, place).replace("(text,", "(__text,")
        wanted = f"array_contains(__kinds, '{rule.kind}')" if rule in listed else "true"
        parts.append(f"if({wanted}, {spans}, {empty})")
    return joined.withColumn("spans", F.expr(f"sort_array(concat({', '.join(parts)}))")).drop(
        "__text", "__hash", "__id", "__found_hash", "__kinds"
    )


def listed(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end, comma-joined."""
    names = ", ".join(f"'{k}'" for k in kinds or ())
    chosen = f"filter({spans}, s -> s.kind IN ({names}))" if kinds else spans
    return F.expr(f"array_join(transform({chosen}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def redacted(text_col: str = "text", spans_col: str = "spans") -> Column:
    """The text with a note in the place of each run of overlapping spans; null stays null."""
    return F.expr(f"""transform(array(aggregate({spans_col}, struct(0L AS at, '' AS out), (a, s) -> struct(
        greatest(a.at, s.end) AS at,
        if(s.start < a.at, a.out, concat(a.out, substr({text_col}, cast(a.at + 1 AS int), cast(s.start - a.at AS int)),
          '[', s.kind, ']')) AS out))), a -> concat(a.out, substr({text_col}, cast(a.at + 1 AS int))))[0]""")
