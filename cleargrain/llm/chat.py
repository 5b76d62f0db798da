"""Operator 5: chat formatting that survives a grammar round trip.

Grammar of a rendered conversation, read by a deterministic parser::

    conversation = { "<|im_start|>" role "\\n" text "<|im_end|>" "\\n" }

A turn is rendered as it is and the rendering is parsed again. Where the turns so
recovered differ from the source, the conflicting text is escaped: a backslash
goes behind the ``<|`` of whatever looks like a control string, with or without
backslashes already there, and the parser takes one away. The rendering that is
kept is the first whose turns are identical to the source; the escaped one always
is, as no control string is left in it and each backslash added is taken away.

Everything is DataFrame expressions. One conversation is one row of output, and
its hash covers its whole text, so a conversation's turns do meet in one row.

Nulls and ties: a null text or role is empty; a null turn number comes first;
equal turn numbers are ordered by role, then text; repeated rows are kept; rows
with a null conversation id form a conversation. Other columns are not read. An
empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
_CONTROL = r"<\|(\\*)im_(start|end)\|>"
_ESCAPED = r"<\|\\(\\*)im_(start|end)\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"<|\\$1im_$2|>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "<|$1im_$2|>")


def _escape_role(role: Column) -> Column:
    """A role's line break would end it early."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(turns: Column) -> Column:
    """Turns (array of role, text; already escaped) as one text."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), ""
    )


def segments(formatted: Column) -> Column:
    """What stands between the start marks, as role and text still escaped; a text that breaks the grammar is null."""
    parts = F.split(formatted, r"<\|im_start\|>")

    def segment(part: Column) -> Column:
        line = F.instr(part, "\n")
        body = F.substr(part, line + 1)
        end = F.instr(body, END)
        fits = (line > 0) & (end > 0) & (F.length(body) == end + len(END))
        text = F.when(fits & F.endswith(body, F.lit(END + "\n")), F.substr(body, F.lit(1), end - 1))
        return F.struct(F.substr(part, F.lit(1), line - 1).alias("role"), text.alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), segment)


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation."""
    return F.transform(
        segments(formatted), lambda t: F.struct(_unescape_role(t["role"]).alias("role"), unescape(t["text"]).alias("text"))
    )


def _escaped(turns: Column) -> Column:
    return F.transform(
        turns, lambda t: F.struct(_escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text"))
    )


def format_conversations(
    rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, formatted, loss_spans (first place from 0 and length, in code points, of each assistant text)."""
    turn = F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    grouped = rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    tried = grouped.select("conv_id", source.alias("turns")).withColumn("plain", render(F.col("turns")))
    tried = tried.withColumn("formatted", F.when(parse(F.col("plain")) == F.col("turns"), F.col("plain")).otherwise(render(_escaped(F.col("turns")))))
    checked = F.when(parse(F.col("formatted")) == F.col("turns"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("A rendered conversation differs from its source"))
    )
    return tried.select("conv_id", checked.alias("formatted")).withColumn("loss_spans", loss_spans(F.col("formatted")))


def loss_spans(formatted: Column) -> Column:
    """Places of the assistants' texts, without the marks around them."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first: int, length: int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        first = state["at"] + len(START) + F.length(turn["role"]) + 1
        span = F.struct(first.alias("first"), F.length(turn["text"]).alias("length"))
        spans = F.when(turn["role"] == ASSISTANT, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((first + F.length(turn["text"]) + len(END) + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(segments(formatted), zero, step)["spans"]


def masked_text(formatted: Column, spans: Column) -> Column:
    """The text under the mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["first"] + 1, s["length"]))), "")
