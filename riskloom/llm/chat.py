"""Chat formatting with Spark expressions only: turns to one training text, its loss mask, and back.

A conversation's turns are collected as structs and sorted; adjacent turns of one role share a block; blocks are
concatenated. Template: ``<turn ROLE>\\nTEXT<next>TEXT</turn>\\n``. Texts and roles are escaped so that no control
character of the template can occur inside them: ``\\`` becomes ``\\\\``, ``<`` becomes ``\\l`` and ``>`` becomes ``\\g``.

Every step is linear in the conversation, and a conversation has to fit in one row, as its result is one text.

Defined cases: a NULL text or role is empty; rows are ordered by (turn, role, text), a NULL turn first; repeated rows
are turns of their own; a NULL conv_id is a conversation; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table

LEARNED_ROLE = "assistant"
END, NEXT = "</turn>\n", "<next>"
CONTROL_ID, CONTROL_TEXT = -7, "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    """Undo ``escape``. Doubled backslashes are split off first, so no other escape can be misread."""
    pieces = F.split(text, r"\\\\")
    plain = F.transform(
        pieces,
        lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")),
    )
    return F.array_join(plain, "\\")


def format_conversations(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """conv_id, formatted, segments: ``segments`` (text, loss) concatenate to ``formatted``; loss marks what is learned.

    A turn knows from the array whether it opens or closes a block, so merging needs no growing accumulator.
    """
    one = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    role = lambda i: F.element_at("turns", i + 1)["role"]
    last = F.size("turns") - 1

    def segments(t: Column, i: Column) -> Column:
        opens = F.when((i > 0) & role(F.greatest(i - 1, F.lit(0))).eqNullSafe(t["role"]), F.lit(NEXT)).otherwise(
            F.concat(F.lit("<turn "), escape(t["role"]), F.lit(">\n"))
        )
        closes = F.when((i < last) & role(F.least(i + 1, last)).eqNullSafe(t["role"]), F.lit("")).otherwise(F.lit(END))
        plain = F.lit(False)
        return F.array(
            F.struct(opens.alias("text"), plain.alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == learned_role).alias("loss")),
            F.struct(closes.alias("text"), plain.alias("loss")),
        )

    built = grouped.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"))
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return built.select("conv_id", joined.alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns inside a formatted text."""
    blocks = F.split(formatted, END)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, ">\n", 1)
        role = unescape(F.replace(head, F.lit("<turn "), F.lit("")))
        body = F.substr(block, F.length(head) + 3)
        return F.transform(
            F.split(body, NEXT), lambda text: F.struct(role.alias("role"), unescape(text).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(CONTROL_ID, 0, "user", CONTROL_TEXT), (CONTROL_ID, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    done = format_conversations(rows.unionByName(control))
    read = done.select(
        "conv_id",
        read_back(F.col("formatted")).alias("turns"),
        learned_text(F.col("segments")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP4_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS merged,
    length(text) + length(text) - length(replace(text, '\', ''))
      + 2 * length(text) - length(replace(text, '<', '')) - length(replace(text, '>', '')) AS text_chars,
    length(role) + length(role) - length(replace(role, '\', ''))
      + 2 * length(role) - length(replace(role, '<', '')) - length(replace(role, '>', '')) AS role_chars
  FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN merged THEN 6 ELSE 8 + role_chars + 8 END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
