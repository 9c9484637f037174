"""Chat formatting with a grammar round trip.

A turn is rendered as

    user        ``[INST] `` text `` [/INST]``
    assistant   blank, text, ``</s>``
    other role  ``[ROLE name] `` text `` [/ROLE]``

and the turns follow each other. The parser reads the rendered text from left to
right and takes out the escapes: a control string is escaped by a backslash
after its bracket, and so is one that already has backslashes there, which
makes the escape reversible.

A conversation is first rendered as it is and parsed again. Where the turns that
come back differ from the source, the differing content is escaped and the
round trip is made once more; a conversation that still differs fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the control strings, as they stand after "[" or "<".
_CONTROL = r"/?INST\]|/?ROLE[ \]]|/?s>"
_CONFLICT = rf"([\[<])(\\*(?:{_CONTROL}))"
_ESCAPED = rf"([\[<])\\(\\*(?:{_CONTROL}))"
# The grammar: one alternative for each kind of turn.
TURN = (r"(?s)\G(?:\[INST\] .*? \[/INST\]|\[ROLE [^\]]*\] .*? \[/ROLE\]| .*?</s>)")

_SIDES = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
_SCHEMA = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONFLICT, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def _role_name(role: Column) -> Column:
    """A role as it stands in a header: backslash and bracket are written out."""
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("]"), F.lit("\\r"))


def _role_read(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("\\r"), F.lit("]")), F.lit("\\b"), F.lit("\\"))


def _opening(role: Column) -> Column:
    out = F.concat(F.lit("[ROLE "), _role_name(role), F.lit("] "))
    for name, (left, _) in _SIDES.items():
        out = F.when(role == name, F.lit(left)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(" [/ROLE]")
    for name, (_, right) in _SIDES.items():
        out = F.when(role == name, F.lit(right)).otherwise(out)
    return out


def _rendered(turns: Column) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(_opening(t["role"]), t["text"], _closing(t["role"]))), "")


def parse(formatted: Column) -> Column:
    """The turns of a rendered text, escapes taken out."""
    def turn(m: Column) -> Column:
        role = (F.when(m.startswith("[INST] "), F.lit("user"))
                .when(m.startswith(" "), F.lit("assistant"))
                .otherwise(_role_read(F.regexp_extract(m, r"^\[ROLE ([^\]]*)\]", 1))))
        left = F.length(_opening(role))
        return F.struct(
            role.alias("role"),
            unescape(F.substr(m, left + 1, F.length(m) - left - F.length(_closing(role)))).alias("text"))
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), turn)


def format_chats(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conv_id, formatted, loss_spans, escaped)``, one row per conversation.

    ``loss_spans`` are ``(start, length)`` in code points of ``formatted``, from
    0: the text of each assistant turn. ``escaped`` tells whether the plain
    rendering did not survive the round trip.

    Defined cases: null texts and roles are empty texts; rows of one turn number
    follow each other by role and text, repeated rows are turns of their own,
    null turn numbers come first; rows with a null id are one conversation;
    other columns are left out; an empty table gives an empty table.
    """
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    source = F.transform(F.array_sort(F.col("_rows")), lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text")))
    chats = (
        rows.select(F.col(conv_id).alias("conv_id"), one.alias("_row"))
        .groupBy("conv_id").agg(F.collect_list("_row").alias("_rows"))
        .select("conv_id", source.alias("_turns"))
        .withColumn("_plain", _rendered(F.col("_turns")))
        .withColumn("_back", parse(F.col("_plain"))))
    same = F.col("_back") == F.col("_turns")
    conflict = F.transform(F.col("_turns"), lambda t: F.struct(
        t["role"].alias("role"), escape(t["text"]).alias("text")))
    used = (
        chats.withColumn("escaped", ~same)
        .withColumn("_used", F.when(same, F.col("_turns")).otherwise(conflict))
        .withColumn("_text", F.when(same, F.col("_plain")).otherwise(_rendered(F.col("_used")))))
    lengths = F.transform(F.col("_used"), lambda t: F.struct(
        (t["role"] == "assistant").alias("loss"), F.length(_opening(t["role"])).alias("left"),
        F.length(t["text"]).alias("size"), F.length(_closing(t["role"])).alias("right")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walked = F.aggregate(
        lengths, start,
        lambda done, t: F.struct(
            (done["at"] + t["left"] + t["size"] + t["right"]).alias("at"),
            F.when(t["loss"], F.concat(done["spans"], F.array(F.struct(
                (done["at"] + t["left"]).alias("start"), t["size"].alias("length")))))
            .otherwise(done["spans"]).alias("spans")),
        lambda done: done["spans"])
    return (
        used.withColumn("_checked", F.when(same, F.lit(True)).otherwise(
            parse(F.col("_text")) == F.col("_turns")))
        .select("conv_id",
                F.when(F.col("_checked"), F.col("_text")).otherwise(F.raise_error(
                    F.lit("a conversation does not survive the round trip"))).alias("formatted"),
                walked.alias("loss_spans"), "escaped"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``(conv_id, turns, loss_text)`` from formatted conversations alone: the
    turns by the parser, the loss text by the spans."""
    loss = F.transform(F.col("loss_spans"), lambda s: unescape(
        F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select(
        "conv_id", "formatted", "escaped", parse(F.col("formatted")).alias("turns"),
        F.array_join(loss, "").alias("loss_text"))
