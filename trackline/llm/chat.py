"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

Rendered text is parsed again by this grammar and compared with the source: a
message ends at its first "<|im_end|>", and what is not a turn is read as null.
Where the plain rendering does not come back identically (control strings or
escapes inside a text or role), the conversation is rendered once more with
escapes: % as %25, <| as %3C| and, in roles, the newline as %0A.  The parser
always unescapes, so it needs no flag, and an escaped rendering has no
control string but the template's own.  The loss mask marks the text of the
assistant's turns, as runs of code points over the formatted string.

Defined cases: null roles and texts are empty; turns are ordered by (turn,
role, text), nulls first; a null conversation id is one conversation;
repeated rows are repeated turns; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(c: Column, role: bool = False) -> Column:
    c = F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))
    return F.replace(c, F.lit("\n"), F.lit("%0A")) if role else c


def unescape(c: Column, role: bool = False) -> Column:
    c = F.replace(c, F.lit("%0A"), F.lit("\n")) if role else c
    return F.replace(F.replace(c, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def _pieces(turns: Column, escaped: bool) -> Column:
    """Per turn the text before the message, the message and the text after."""
    same = lambda c, role=False: escape(c, role) if escaped else c
    return F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(START), same(t["role"], True), F.lit("\n")).alias("head"), same(t["text"]).alias("body"),
        F.lit(END + "\n").alias("tail"), (t["role"] == LOSS_ROLE).alias("loss")))


def _render(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], p["tail"])), "")


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted string; null where a piece goes on
    after its first end or has none."""
    pieces = F.split(formatted, "<\\|im_start\\|>", -1)
    parts = F.slice(pieces, F.lit(2), F.size(pieces))

    def turn(p: Column) -> Column:
        body = F.substring_index(p, END, 1)
        role = F.substring_index(body, "\n", 1)
        return F.when(p == F.concat(body, F.lit(END + "\n")), F.struct(
            unescape(role, True).alias("role"),
            unescape(F.substring(body, F.length(role) + 2, F.length(body))).alias("text")))
    return F.transform(parts, turn)


def format_chats(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_runs``
    (array of (chars, loss) over the formatted string), ``parsed`` (turns read
    back), ``escaped`` and ``identical``."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = conversations.select(F.col(f"`{id_col}`").alias("conv_id"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    turns = turns.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    plain = turns.withColumn("pieces", _pieces(F.col("turns"), False)).withColumn("formatted", _render(F.col("pieces")))
    tried = plain.withColumn("escaped", ~parse(F.col("formatted")).eqNullSafe(F.col("turns")))
    final = (tried.withColumn("pieces", F.when(F.col("escaped"), _pieces(F.col("turns"), True)).otherwise(F.col("pieces")))
             .withColumn("formatted", F.when(F.col("escaped"), _render(F.col("pieces"))).otherwise(F.col("formatted")))
             .withColumn("parsed", parse(F.col("formatted"))))
    runs = F.flatten(F.transform("pieces", lambda p: F.array(
        F.struct(F.length(p["head"]).alias("chars"), F.lit(False).alias("loss")),
        F.struct(F.length(p["body"]).alias("chars"), p["loss"].alias("loss")),
        F.struct(F.length(p["tail"]).alias("chars"), F.lit(False).alias("loss")))))
    return final.select("conv_id", "formatted", runs.alias("loss_runs"), "parsed", "escaped",
                        F.col("parsed").eqNullSafe(F.col("turns")).alias("identical"))


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted output says when read back, as lengths and digests."""
    said = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("parsed", lambda t: t["role"] == LOSS_ROLE), lambda t: t["text"]), "")
    return chats.select("conv_id", F.size("parsed").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
