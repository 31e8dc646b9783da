"""Chat formatting: a finite-state machine over roles, and text segments that know whether they count in the loss.

Everything is DataFrame functions. A conversation may be of any length, so it is cut into stretches of
2 to the ``STRETCH_BITS`` turn numbers. Each stretch is folded on its own into a map from every state before it to the
state after it; the maps of a conversation, one small row per stretch, are then chained in order.

Texts can't be mistaken for the template's marks: three characters are escaped, each as a backslash and a
letter, so that no mark occurs in an escaped text and the original comes back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.llm.queries import query, table

STRETCH_BITS = 6
ESCAPES = [("\\", "\\s"), ("<", "\\l"), ("[", "\\b")]


@dataclass(frozen=True)
class Template:
    """Marks around a turn, which roles follow each other, and the roles whose text counts in the loss.

    ``moves`` has the state after each pair of state and role; a pair that it lacks is an error.
    """

    begin: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    error: str = "error"
    accepting: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
            ("assistant", "tool"): "tool",
            ("tool", "assistant"): "assistant",
        }
    )

    @property
    def states(self) -> list[str]:
        return sorted({self.start, self.error, *self.moves.values(), *(state for state, _ in self.moves)})


CHATML = Template()


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def escaped_role(role: Column) -> Column:
    """A role ends with its line, so a line feed inside is escaped, too."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def role_of(code: Column) -> Column:
    return unescaped(F.replace(code, F.lit("\\n"), F.lit("\n")))


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``stretch``; a null role or text is empty, a null turn comes first."""
    return rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("stretch", F.shiftright(F.coalesce("turn", F.lit(-(2**62))), STRETCH_BITS))


def segments(rows: DataFrame, template: Template = CHATML, **columns: str) -> DataFrame:
    """The formatted conversations: ``conv_id``, ``stretch``, ``place``, ``role``, ``segment`` (0 to 2), ``text``, ``loss``.

    Turns are ordered by turn, then role and text; ``place`` numbers them within their stretch. A turn gives its opening mark with the role, its escaped
    text and its closing mark; only the text of a learned role counts in the loss. All conversations are
    formatted, valid or not. Repeated rows are turns of their own; an empty table gives no rows; further columns
    are ignored. ``columns`` names the columns of ``rows`` as in ``turns``.
    """
    opening = F.concat(F.lit(template.begin), escaped_role(F.col("role")), F.lit(template.after_role))
    piece = lambda at, text, loss: F.struct(F.lit(at).alias("segment"), text.alias("text"), loss.alias("loss"))
    pieces = F.array(
        piece(0, opening, F.lit(False)),
        piece(1, escaped(F.col("text")), F.col("role").isin(*template.learned)),
        piece(2, F.lit(template.end), F.lit(False)),
    )
    order = Window.partitionBy("conv_id", "stretch").orderBy("turn", "role", "text")
    numbered = turns(rows, **columns).withColumn("place", F.row_number().over(order))
    return numbered.select("conv_id", "stretch", "place", "role", F.inline(pieces))


def assembled(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``stretch``, ``formatted`` and ``learned``, the texts of the segments that count in the loss."""
    item = F.struct("place", "segment", "text", "loss")
    stretch = formatted.groupBy("conv_id", "stretch").agg(F.array_sort(F.collect_list(item)).alias("parts"))
    return stretch.select(
        "conv_id",
        "stretch",
        F.concat_ws("", F.transform("parts", lambda p: p.text)).alias("formatted"),
        F.transform(F.filter("parts", lambda p: p.loss), lambda p: p.text).alias("learned"),
    )


def read_back(stretches: DataFrame, template: Template = CHATML) -> DataFrame:
    """``turns`` (role and text) of each assembled stretch, from nothing but its formatted text."""
    quoted = lambda s: r"\Q" + s + r"\E"
    pieces = F.filter(F.split("formatted", quoted(template.end)), lambda p: p != "")
    at = lambda p: F.instr(p, template.after_role)
    first = len(template.begin) + 1
    turn = lambda p: F.struct(
        role_of(F.substring(p, F.lit(first), at(p) - first)).alias("role"),
        unescaped(F.substring(p, at(p) + len(template.after_role), F.length(p))).alias("text"),
    )
    return stretches.withColumn("turns", F.transform(pieces, turn))


def folded(turns: str, template: Template) -> list[Column]:
    """For each state before a stretch of turns (an array with ``role``) the state after it."""
    entries = [F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}|{role}", to)]
    moves = F.create_map(*entries)
    step = lambda state, t: F.coalesce(
        F.try_element_at(moves, F.concat_ws("|", state, t.role)), F.lit(template.error)
    )
    return [F.aggregate(turns, F.lit(s), step).alias(f"from_{s}") for s in template.states]


def chained(parts: Column, template: Template) -> Column:
    """The state after all stretches, given their maps in order."""

    def follow(state: Column, part: Column) -> Column:
        to = F.lit(template.error)
        for s in template.states:
            to = F.when(state == s, part[f"from_{s}"]).otherwise(to)
        return to

    return F.aggregate(parts, F.lit(template.start), follow)


def validity(rows: DataFrame, template: Template = CHATML, **columns: str) -> DataFrame:
    """``conv_id``, ``state`` at the end, ``valid`` (ended in an accepting state) of every conversation."""
    own = turns(rows, **columns).groupBy("conv_id", "stretch").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    maps = own.select("conv_id", F.struct("stretch", *folded("turns", template)).alias("part"))
    whole = maps.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    state = chained(F.col("parts"), template)
    return whole.select("conv_id", state.alias("state"), state.isin(*template.accepting).alias("valid"))


def digests(rows: DataFrame, template: Template = CHATML, **columns: str) -> DataFrame:
    """A row per conversation, read back from its formatted text.

    The digest of a conversation is defined over all its turns in a row, so in the end they meet in one row.
    Stretches of formatted text, not turns, are what is shuffled for that.
    """
    formatted = segments(rows, template, **columns)
    back = read_back(assembled(formatted), template)
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))))
    learned = F.concat_ws("", F.transform("learned", unescaped))
    stretch = back.select(
        "conv_id", "stretch", F.size("turns").cast("long").alias("n"), lines.alias("lines"), learned.alias("learned"),
        F.length("formatted").cast("long").alias("chars"), F.struct("stretch", *folded("turns", template)).alias("part"),
    )
    joined = lambda c: F.concat_ws(
        "", F.transform(F.array_sort(F.collect_list(F.struct("stretch", c))), lambda p: p[c])
    )
    whole = stretch.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), joined("lines").alias("lines"), joined("learned").alias("learned"),
        F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list("part")).alias("parts"),
    )
    return whole.select(
        "conv_id", "n_turns", F.sha2("lines", 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
        chained(F.col("parts"), template).isin(*template.accepting).alias("valid"),
    )


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
), moves AS (
  SELECT conv_id, role,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS earlier,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS later
  FROM turns
), valid AS (
  SELECT conv_id, bool_and(coalesce(earlier, 'start') || '|' || role IN (
           'start|system', 'start|user', 'system|user', 'user|assistant', 'assistant|user', 'assistant|tool', 'tool|assistant'))
           AND bool_and(later IS NOT NULL OR role = 'assistant') AS valid
  FROM moves GROUP BY conv_id
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + 1 + length('<|im_end|>') + 1 + length(role) + length(text)
           + length(regexp_replace(role || text, '[^\\<\[]', '', 'g'))) AS BIGINT) AS formatted_chars,
       any_value(valid) AS valid
FROM turns JOIN valid USING (conv_id) GROUP BY conv_id
"""


@query("op7_chat_formatting", SQL)
def op7_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(rows.unionByName(own))
