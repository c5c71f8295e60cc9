"""Operator 8: chat formatting by a finite-state machine over roles.

A declarative template says how a turn is written, which role may follow which
and which roles a model is trained on.  Each conversation becomes a list of text
segments with a loss flag; their concatenation is the formatted text.  Control
strings inside a role or text are broken up by a backslash, and backslashes are
doubled, so that the formatted text can be read back exactly.

All of it is built-in column functions.  The rows of one conversation meet in one
row, which is the operator's result; conversations are spread over the cluster.

Defined results: a null role or text counts as empty; turns are ordered by turn
(null first), then role, then text, so ties and repeated rows have one order and
all are kept; rows of a null conv_id form one conversation; a conversation that
breaks the turn order is formatted all the same and has ``valid`` false; extra
columns are ignored; an empty table gives an empty result.  Texts and roles of any
length are kept whole.  ``with_tricky`` adds its two rows to conversation -7,
whether or not the table has one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    head: str = "### "
    after_role: str = ": "
    end: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Roles that may come next; the key "" is the start of a conversation.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    #: Roles that may be last.
    last: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[tuple[str, str], ...]:
        """Control strings and what stands for them inside a text."""
        return tuple((c, f"{c[0]}\\{c[1:]}") for c in (self.head, self.end.rstrip("\n")))


def escaped(text: Column, template: Template) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, instead in template.controls:
        text = F.replace(text, F.lit(control), F.lit(instead))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def valid(roles: Column, template: Template) -> Column:
    """Whether the machine accepts the roles: no forbidden step, a good end."""

    def step(state: Column, role: Column) -> Column:
        allowed = F.lit(False)
        for before, after in template.follows.items():
            allowed = allowed | ((state == before) & role.isin(*after))
        return F.when(allowed, role).otherwise(F.lit("!"))

    return F.aggregate(roles, F.lit(""), step, lambda state: state.isin(*template.last))


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, valid."""
    t = template or Template()
    rows = turns.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    together = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def written(x: Column) -> Column:
        role = F.replace(escaped(x["role"], t), F.lit(t.after_role[0]), F.lit("\\" + t.after_role[0]))
        parts = (
            (F.concat(F.lit(t.head), role, F.lit(t.after_role)), F.lit(False)),
            (escaped(x["text"], t), x["role"].isin(*t.loss_roles)),
            (F.lit(t.end), F.lit(False)),
        )
        return F.array(*(F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts))

    return together.select(
        "conv_id",
        F.flatten(F.transform("turns", written)).alias("segments"),
        valid(F.transform("turns", lambda x: x["role"]), t).alias("valid"),
    )


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, formatted, turns array<struct<role, text>> and loss_text, all read
    from the segments; turns only from the formatted text."""
    t = template or Template()
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    mark = t.after_role[0]
    # Possessive, so that a role of any length is matched in a loop, not by recursion.
    role = rf"(?s)^\Q{t.head}\E((?:[^\\{mark}]++|\\.)*+)\Q{t.after_role}\E"

    def turn(x: Column) -> Column:
        return F.struct(
            unescaped(F.regexp_extract(x, role, 1)).alias("role"),
            unescaped(F.regexp_replace(x, role, "")).alias("text"),
        )

    kept = [c for c in formatted.columns if c not in ("conv_id", "segments")]
    parts = F.split("formatted", rf"\Q{t.end}\E", -1)
    return (
        formatted.select("conv_id", text.alias("formatted"), loss.alias("loss_text"), *kept)
        .withColumn("parts", parts)
        .withColumn("turns", F.transform(F.slice("parts", 1, F.size("parts") - 1), turn))
        .drop("parts")
    )


def digests(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row for each conversation: counts and hashes of what was read back."""
    back = read_back(format_chats(turns, template), template)
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


#: The fixed conversation that holds the template's own control strings.
TRICKY = r"""
SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, r'\### Assistant: </turn> ok' AS text
FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)
"""


def with_tricky(turns: DataFrame) -> DataFrame:
    columns = turns.select("conv_id", "turn", "role", "text")
    return columns.unionByName(turns.sparkSession.sql(TRICKY))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w AS (
  SELECT *, LAG(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS from_end,
    '### ' || REPLACE(REPLACE(REPLACE(REPLACE(role, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>'), ':', '\:') || ': '
      || REPLACE(REPLACE(REPLACE(text, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>') || '</turn>' || CHR(10) AS written
  FROM c
)
SELECT conv_id, COUNT(*) AS n_turns,
  SHA256(STRING_AGG(role || CHR(10) || text || CHR(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(COALESCE(SUM(LENGTH(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  SHA256(COALESCE(STRING_AGG(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(SUM(LENGTH(written)) AS BIGINT) AS formatted_chars,
  BOOL_AND(CASE COALESCE(before, '') WHEN '' THEN before IS NULL AND role IN ('system', 'user') WHEN 'system' THEN role = 'user'
      WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE FALSE END)
    AND BOOL_OR(from_end = 1 AND role = 'assistant') AS valid
FROM w GROUP BY conv_id
"""
