"""Chat formatting with a grammar round trip.

Template, one piece per turn, pieces follow each other without anything between:

* user: ``[INST] text [/INST]``
* assistant: ``<s>text</s>``
* system: ``<<SYS>>text<</SYS>>``
* any other role: ``[ROLE] role [/ROLE] text [/TEXT]``

The grammar is deterministic: at a piece's start its opening string names the form, and the piece ends
at the first closing string of that form. A control string inside a text or role would be taken
for the template's own, so a conversation is rendered, parsed again and compared with
its source; where they differ, conflicting content is escaped and the round is made again.
Escaping puts one more backslash behind the first character of every control string, also
of those that have backslashes there already; reading takes one away. Escaped texts hold
no control string, and no text can form one together with the string that follows it, since
``[`` and ``<`` stand nowhere but at a control string's start; so the second round is the last.

* null role: like an empty role name; null text: empty
* ties in turn: ordered by role, then text; repeated rows are turns of their own
* null conversation id: its rows are one conversation; null turns come first
* an assistant turn is the only content under the loss mask
* empty table: empty result; other columns are ignored

DataFrame expressions only. A conversation is one output row, as a document is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings.
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TEXT]")
_REST = r"(/?INST\]|/?ROLE\]|/TEXT\]|/?s>|</?SYS>>)"
_CONFLICT = r"([\[<])(\\*)" + _REST
_ESCAPED = r"([\[<])\\(\\*)" + _REST
_PIECE = (
    r"(?s)\[INST\] (.*?) \[/INST\]|<s>(.*?)</s>|<<SYS>>(.*?)<</SYS>>|\[ROLE\] (.*?) \[/ROLE\] (.*?) \[/TEXT\]"
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONFLICT, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _opening(role: Column, shown: Column) -> Column:
    return (
        F.when(role == "user", F.lit("[INST] "))
        .when(role == "assistant", F.lit("<s>"))
        .when(role == "system", F.lit("<<SYS>>"))
        .otherwise(F.concat(F.lit("[ROLE] "), shown, F.lit(" [/ROLE] ")))
    )


def _closing(role: Column) -> Column:
    return (
        F.when(role == "user", F.lit(" [/INST]"))
        .when(role == "assistant", F.lit("</s>"))
        .when(role == "system", F.lit("<</SYS>>"))
        .otherwise(F.lit(" [/TEXT]"))
    )


def _rendered(turns: str, escape: bool) -> Column:
    """Pieces of a conversation as (head, body, tail)."""
    shape = escaped if escape else (lambda text: text)
    return F.transform(
        turns,
        lambda t: F.struct(
            _opening(t["role"], shape(t["role"])).alias("head"), shape(t["text"]).alias("body"), _closing(t["role"]).alias("tail")
        ),
    )


def _joined(pieces: str) -> Column:
    return F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], p["tail"])), "")


def parsed(formatted: str) -> Column:
    """Turns (role, text) of a formatted conversation, unescaped; pieces are cut by the grammar alone.

    Null where the pieces do not account for every character.
    """
    whole = F.regexp_extract_all(formatted, F.lit(_PIECE), F.lit(0))
    part = lambda piece, i: F.regexp_extract(piece, _PIECE, i)

    def turn(piece: Column) -> Column:
        is_user, is_assistant, is_system = (piece.startswith(s) for s in ("[INST] ", "<s>", "<<SYS>>"))
        role = (
            F.when(is_user, F.lit("user"))
            .when(is_assistant, F.lit("assistant"))
            .when(is_system, F.lit("system"))
            .otherwise(unescaped(part(piece, 4)))
        )
        text = F.when(is_user, part(piece, 1)).when(is_assistant, part(piece, 2)).when(is_system, part(piece, 3)).otherwise(part(piece, 5))
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.when(F.array_join(whole, "") == F.col(formatted), F.transform(whole, turn))


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: conv, formatted, turns (read back), mask (start, length), is_escaped, round_trips.

    ``mask`` has the character ranges of assistant texts in ``formatted``, from 0, as escaped there.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    conversations = (
        rows.select(F.col(conv_col).alias("conv"), turn.alias("t"))
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .withColumn("source", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    )
    first = (
        conversations.withColumn("plain", _rendered("source", False))
        .withColumn("plain_text", _joined("plain"))
        .withColumn("is_escaped", ~parsed("plain_text").eqNullSafe(F.col("source")))
    )
    second = (
        first.withColumn("pieces", F.when(F.col("is_escaped"), _rendered("source", True)).otherwise(F.col("plain")))
        .withColumn("formatted", F.when(F.col("is_escaped"), _joined("pieces")).otherwise(F.col("plain_text")))
        .withColumn("read", parsed("formatted"))
    )
    size = lambda s: F.char_length(s).cast("long")
    ranges = F.transform(
        "pieces", lambda p: F.struct((p["head"] == "<s>").alias("on"), size(p["head"]).alias("h"), size(p["body"]).alias("b"), size(p["tail"]).alias("t"))
    )
    begun = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: long, length: long>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        here = F.array(F.struct((state["at"] + p["h"]).alias("start"), p["b"].alias("length")))
        spans = F.when(p["on"], F.concat(state["spans"], here)).otherwise(state["spans"])
        return F.struct((state["at"] + p["h"] + p["b"] + p["t"]).alias("at"), spans.alias("spans"))

    return second.select(
        "conv",
        "formatted",
        F.col("read").alias("turns"),
        F.aggregate(ranges, begun, step)["spans"].alias("mask"),
        "is_escaped",
        F.col("read").eqNullSafe(F.col("source")).alias("round_trips"),
    )


def masked_texts(formatted: str, mask: str) -> Column:
    """The unescaped texts under the mask, cut from the formatted text."""
    return F.transform(mask, lambda m: unescaped(F.substring(F.col(formatted), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
