"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, and adjacent
turns of one role are merged into one block by an array aggregation; blocks are
concatenated under a template that marks roles and turns:

    <|im_start|>role \\n text [<|im_sep|> text ...] <|im_end|> \\n

Inside texts and roles ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so
the control strings appear nowhere but in the template, and removing the
escapes gives back the text. The loss mask is a list of spans (start, length in
code points) of the formatted string, one for each assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_chunks

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """A backslash stands before the character that it protects."""
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    """A role ends at the first line feed, so its own are written as ``\\n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # \\ is set aside so that an escaped backslash before an n isn't taken for a line feed
    parts = F.split(role, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")),
                                                               F.lit("\\|"), F.lit("|"))), "\\")


def format_chat(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per conversation: ``id_col``, formatted, loss_spans (start, length).

    Turns are sorted by number, then role, then text (null numbers first), so
    ties have one order. Null texts and roles are empty; rows with a null id
    form one conversation; repeated rows are repeated turns. An empty table
    gives an empty result; other columns are ignored.
    """
    rows = turns.select(
        F.col(id_col).alias("__id"),
        F.struct(F.col(turn_col).alias("turn"),
                 F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("t"))
    collected = rows.groupBy("__id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # What the template puts before each text depends on the turn before it.
    pieces = F.transform("turns", lambda t, i: F.struct(
        F.when((i > 0) & (F.get("turns", i - 1)["role"] == t["role"]), F.lit(SEP))
        .otherwise(F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(START),
                            escape_role(t["role"]), F.lit("\n"))).alias("before"),
        escape(t["text"]).alias("text"), (t["role"] == LOSS_ROLE).alias("loss")))
    shaped = collected.select("__id", pieces.alias("pieces"))
    formatted = F.concat(F.array_join(F.transform(
        "pieces", lambda p: F.concat(p["before"], p["text"])), ""), F.lit(END))
    none = F.expr("array()").cast("array<struct<start:bigint,length:bigint>>")

    def step(a: Column, p: Column) -> Column:
        """The place behind a piece, and the loss spans so far."""
        start = a["at"] + F.length(p["before"])
        span = F.struct(start.cast("bigint").alias("start"), F.length(p["text"]).cast("bigint").alias("length"))
        return F.struct((start + F.length(p["text"])).cast("bigint").alias("at"),
                        F.when(p["loss"], F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    def chunk_step(done: Column, chunk: Column) -> Column:
        at = F.coalesce(F.get(done, F.size(done) - 1)["at"], F.lit(0).cast("bigint"))
        return F.concat(done, F.array(F.aggregate(chunk, F.struct(at.alias("at"), none.alias("spans")), step)))

    scanned = F.aggregate(in_chunks(F.col("pieces")), F.expr("array()").cast(
        "array<struct<at:bigint,spans:array<struct<start:bigint,length:bigint>>>>"), chunk_step)
    return shaped.select(F.col("__id").alias(id_col), formatted.alias("formatted"),
                         F.flatten(F.transform(scanned, lambda c: c["spans"])).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds, as an array of structs."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda b: b != "")
    parsed = F.transform(blocks, lambda b: F.struct(
        F.substring_index(b, "\n", 1).alias("role"), b.alias("block")))
    turns = F.transform(parsed, lambda b: F.transform(
        F.split(F.substring(b["block"], F.length(b["role"]) + 2,
                            F.length(b["block"]) - F.length(b["role"]) - 1 - F.lit(len(END))),
                r"<\|im_sep\|>", -1),
        lambda x: F.struct(unescape_role(b["role"]).alias("role"), unescape(x).alias("text"))))
    return F.flatten(turns)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, without its escapes. Spans are in order; each is cut from the stretch of its chunk."""
    def stretch(chunk: Column) -> Column:
        first, last = F.get(chunk, F.lit(0)), F.get(chunk, F.size(chunk) - 1)
        return F.struct(
            chunk.alias("spans"), first["start"].alias("at"),
            F.substring(formatted, (first["start"] + 1).cast("int"),
                        (last["start"] + last["length"] - first["start"]).cast("int")).alias("text"))

    stretches = F.transform(in_chunks(spans), stretch)
    return F.array_join(F.transform(stretches, lambda c: F.array_join(F.transform(
        c["spans"], lambda s: unescape(F.substring(c["text"], (s["start"] - c["at"] + 1).cast("int"),
                                                   s["length"].cast("int")))), "")), "")
