"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of
one role become one block by array slicing (linear in the number of turns);
blocks are concatenated. Control strings inside roles and texts are broken by
a backslash after their first character, and backslashes are doubled, so the
template's own marks never occur inside a text and ``read_back`` restores
every turn exactly.

    <|im_start|>ROLE<|im_sep|>TEXT[<|im_cont|>TEXT ...]<|im_end|>   per block

``loss_mask`` is the loss mask in run-length form: alternately one run per
piece of text between marks and one per mark, in order, covering ``formatted``
code point by code point; only assistant texts are under loss.

Defined results: null texts and roles count as empty; null turns sort first;
equal turn numbers sort by role, then text; repeated rows are kept as turns;
a null conversation id is a conversation of its own. A conversation is one
output row, so its turns meet in one task: that is inherent in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, CONT, END = "<|im_start|>", "<|im_sep|>", "<|im_cont|>", "<|im_end|>"
LOSS_ROLE = "assistant"
#: Control strings of this and of common other templates: none may appear unescaped in a text.
CONTROL = r"<\|[a-z_]+\|>|</?s>|\[/?INST\]|<</?SYS>>"
_MARK = r"<\|im_(?:start|sep|cont|end)\|>"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"([<\[])(?=(?:(?<=<)(?:\|[a-z_]+\|>|/?s>|</?SYS>>)|(?<=\[)/?INST\]))",
                            r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _run(chars: Column, loss: Column) -> Column:
    return F.struct(chars.cast("int").alias("chars"), loss.alias("loss"))


def _mark(mark: str) -> Column:
    return _run(F.lit(len(mark)), F.lit(False))


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = df.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # where a block begins: the first turn and every change of role
    n = F.size("turns")
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    turns = turns.withColumn("begins", begins)
    ends = F.concat(F.slice("begins", 2, F.size("begins")), F.array(n))
    blocks = F.transform(F.arrays_zip(F.col("begins").alias("a"), ends.alias("b")), lambda z: F.struct(
        escape(F.get("turns", z["a"])["role"]).alias("role"),
        (F.get("turns", z["a"])["role"] == LOSS_ROLE).alias("loss"),
        F.transform(F.slice("turns", z["a"] + 1, z["b"] - z["a"]), lambda t: escape(t["text"])).alias("texts")))
    turns = turns.select("conv_id", blocks.alias("blocks"))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(START), b["role"], F.lit(SEP), F.array_join(b["texts"], CONT), F.lit(END))), "")
    nothing = _run(F.lit(0), F.lit(False))
    runs = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(_mark(START), _run(F.length(b["role"]), F.lit(False))),
        F.flatten(F.transform(b["texts"], lambda t, j: F.array(
            F.when(j == 0, _mark(SEP)).otherwise(_mark(CONT)), _run(F.length(t), b["loss"])))),
        F.array(_mark(END), nothing))))
    return turns.select("conv_id", formatted.alias("formatted"),
                        F.concat(F.array(nothing), runs).alias("loss_mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """``format_chats`` undone: conv_id, turns (role, text), loss_texts (unescaped), formatted."""
    blocks = F.split("formatted", r"<\|im_end\|>", -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.get(F.split(b, r"<\|im_sep\|>", -1), F.lit(1)), r"<\|im_cont\|>", -1),
        lambda t: F.struct(unescape(F.substring_index(F.substr(b, F.lit(len(START) + 1)), SEP, 1)).alias("role"),
                           unescape(t).alias("text")))))
    # pieces between marks stand at the even places of the mask
    pieces = F.split("formatted", _MARK, -1)
    under = F.filter(F.transform(pieces, lambda p, i: F.struct(
        p.alias("p"), F.get("loss_mask", i * 2)["loss"].alias("loss"))), lambda x: x["loss"])
    return chats.select("conv_id", turns.alias("turns"),
                        F.transform(under, lambda x: unescape(x["p"])).alias("loss_texts"), "formatted")
