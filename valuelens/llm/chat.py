"""Chat formatting that is proven by reading it back. Built-in expressions only.

A conversation is rendered, parsed again by a deterministic parser, and compared with its turns. Where they
differ, its contents are escaped, first the texts and then the roles too, until they are equal.

    conversation = { START role "\\n" text END "\\n" }       no START or END within role and text
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"

#: A control string with any number of backslashes behind its "<"; escaping adds one, unescaping takes one.
_PLAIN = r"r'<(\\*)\|(im_start|im_end)\|>'"
_ESCAPED = r"r'<(\\*)\\\|(im_start|im_end)\|>'"
_MARK = r"r'<\|im_(?:start|end)\|>'"


def escaped(text: str) -> str:
    return rf"regexp_replace({text}, {_PLAIN}, r'<$1\\|$2|>')"


def unescaped(text: str) -> str:
    return f"regexp_replace({text}, {_ESCAPED}, r'<$1|$2|>')"


def _role_escaped(role: str) -> str:
    return rf"replace(replace(replace({role}, r'\', r'\b'), '\n', r'\n'), '<', r'\l')"


def _role_unescaped(role: str) -> str:
    return rf"replace(replace(replace({role}, r'\l', '<'), r'\n', '\n'), r'\b', r'\')"


def rendered(turns: str, role: str = "t.role", text: str = "t.text") -> str:
    """An array of segments; those with ``loss`` are what a model learns to write."""
    return f"""flatten(transform({turns}, t -> array(
      struct(concat('{START}', {role}, '\\n') AS text, false AS loss),
      struct({text} AS text, t.role = '{ASSISTANT}' AS loss),
      struct('{END}\\n' AS text, false AS loss))))"""


def joined(segments: str) -> str:
    return f"array_join(transform({segments}, s -> s.text), '')"


def loss_text(segments: str, level: str) -> str:
    """What a model learns to write, as in the source: escaped texts are read back one by one, and then joined."""
    own = f"transform(filter({segments}, s -> s.loss), s -> if({level} = 0, s.text, {unescaped('s.text')}))"
    return f"array_join({own}, '')"


def parsed(formatted: str) -> str:
    """The turns of a formatted conversation; null if it does not follow the grammar."""
    bodies = f"""transform(filter(parts, (p, i) -> i % 2 = 1), p -> struct(
      {_role_unescaped("substring_index(p, '\\n', 1)")} AS role,
      {unescaped("substr(p, char_length(substring_index(p, '\\n', 1)) + 2)")} AS text))"""
    return f"""transform(array(struct(split({formatted}, {_MARK}, -1) AS parts,
        regexp_extract_all({formatted}, {_MARK}, 0) AS marks)), both -> transform(array(both.parts), parts -> if(
          forall(transform(both.marks, (m, i) -> m = if(i % 2 = 0, '{START}', '{END}')), x -> x)
            AND forall(transform(parts, (p, i) -> if(i = 0, p = '', i % 2 = 1 OR p = '\\n')), x -> x)
            AND size(parts) % 2 = 1,
          {bodies}, null))[0])[0]"""


def format_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text, loss), ``formatted``, ``level``, ``turns``.

    ``turns`` is what the parser reads from ``formatted``; ``level`` says what had to be escaped (0 nothing,
    1 texts, 2 roles too). A conversation that could not be read back at level 2 would stop the query.

    Null texts and roles count as empty. Rows are ordered by turn (null first), then role, then text, so that ties
    and repeated rows, which all stay, have one result. Rows without an id are one conversation. A
    conversation is one output row by its nature, whatever its length; nothing larger is gathered. An empty table gives no
    rows. Other columns are not used, whatever their names.
    """
    turns = (
        rows.select(
            F.col(id_col).alias("conv_id"),
            F.struct(
                F.col(turn_col).alias("turn"),
                F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
            ).alias("row"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select("conv_id", F.expr("transform(rows, r -> struct(r.role AS role, r.text AS text))").alias("source"))
    )
    levels = [
        rendered("source"),
        rendered("source", text=escaped("t.text")),
        rendered("source", role=_role_escaped("t.role"), text=escaped("t.text")),
    ]

    def candidate(level: int) -> str:
        """The rendering, if it reads back as the source, else the next level's."""
        tried = f"struct({levels[level]} AS segments, {level} AS level)"
        with_text = f"transform(array({tried}), c -> struct(c.segments, c.level, {joined('c.segments')} AS formatted))[0]"
        with_turns = f"transform(array({with_text}), c -> struct(c.*, {parsed('c.formatted')} AS turns))[0]".replace(
            "c.*", "c.segments, c.level, c.formatted"
        )
        last = "raise_error('a conversation cannot be read back')" if level == 2 else candidate(level + 1)
        return f"transform(array({with_turns}), c -> if(coalesce(c.turns = source, false), c, {last}))[0]"

    return turns.withColumn("best", F.expr(candidate(0))).select(
        "conv_id", "best.segments", "best.formatted", "best.level", "best.turns"
    )
