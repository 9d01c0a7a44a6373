"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Template: a turn is `[INST] text [/INST]` for a user, `[SYS] text [/SYS]` for the system, `<s> text </s>` for the
assistant and `[ROLE:name] text [/ROLE]` for any other role. Every control string begins with `[` or `<`. Inside
texts and names these characters, `]`, `>` and the backslash are written as backslash and a letter, so that no text
can hold a control string, and unescaping gives exactly the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: character -> its escape; the backslash comes first when escaping and last when unescaping
ESCAPES = {"\\": "\\e", "<": "\\l", "[": "\\b", ">": "\\g", "]": "\\r"}

#: role -> opening and closing mark
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("<s> ", " </s>")}

#: one formatted turn: its tag and its escaped text
TURN = r"[\[<]([^\[<\]>]*)[\]>] ([^\[<]*) [\[<]/[A-Zs]+[\]>]"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _mark(role: Column, which: int) -> Column:
    other = F.concat(F.lit("[ROLE:"), escape(role), F.lit("] ")) if which == 0 else F.lit(" [/ROLE]")
    chosen = F.when(F.lit(False), F.lit(""))
    for name, marks in MARKS.items():
        chosen = chosen.when(role == name, F.lit(marks[which]))
    return chosen.otherwise(other)


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row for each conversation: conv_id, turns (array of role, opening, body, closing), formatted.

    Rows are ordered by turn, then role, then text; null turns come first. Null texts and roles count as empty.
    Repeated rows are turns of their own. Rows without a conversation id form one conversation. Other columns of
    the input are not read. A conversation is one row here, since its format and its digest are one string.
    """
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    gathered = turns.select(F.col(conv).alias("conv_id"), said.alias("said")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("said")).alias("said"))
    written = F.transform("said", lambda x: F.struct(
        x["role"].alias("role"), _mark(x["role"], 0).alias("opening"), escape(x["text"]).alias("body"),
        _mark(x["role"], 1).alias("closing")))
    return gathered.select("conv_id", written.alias("turns")).withColumn("formatted", F.array_join(
        F.transform("turns", lambda x: F.concat(x["opening"], x["body"], x["closing"])), ""))


def expand_targets(conversations: DataFrame) -> DataFrame:
    """One example for each assistant turn of `format_conversations`: all preceding turns, then the reply.

    Adds example (0, 1, ...), prompt (the preceding turns and the opening mark), target (the reply with its closing
    mark), and loss_start, loss_length: the code points of prompt || target that are trained, which is the reply's
    text alone. A conversation without an assistant turn keeps one row, in which all of these are null.
    """
    places = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: F.get("turns", i)["role"] == "assistant")
    one = conversations.select("*", F.posexplode_outer(places).alias("example", "_at"))
    reply = F.get("turns", F.col("_at"))
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("_at")),
                                       lambda x: F.concat(x["opening"], x["body"], x["closing"])), "")
    return (one.withColumn("prompt", F.concat(context, reply["opening"]))
            .withColumn("target", F.concat(reply["body"], reply["closing"]))
            .withColumn("loss_start", F.length("prompt").cast("bigint"))
            .withColumn("loss_length", F.length(reply["body"]).cast("bigint"))
            .drop("_at"))


def read_turns(formatted: Column) -> Column:
    """Role and text of each turn, read back from a formatted conversation."""
    tags, bodies = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(group)) for group in (1, 2))
    role = F.transform(tags, lambda tag: F.when(tag == "INST", "user").when(tag == "SYS", "system")
                       .when(tag == "s", "assistant").otherwise(unescape(F.substr(tag, F.lit(6)))))
    return F.arrays_zip(role.alias("role"), F.transform(bodies, unescape).alias("text"))


def digest_examples(examples: DataFrame) -> DataFrame:
    """For each conversation, what its examples and its format say, read back from them."""
    trained = F.substr(F.concat("prompt", "target"), F.col("loss_start") + 1, F.col("loss_length"))
    # the formatted string is the same in all examples of a conversation
    one = (examples.withColumn("_loss", unescape(trained))
           .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("example").isNotNull(), F.struct(
               F.col("example"), F.col("_loss").alias("text"))))).alias("losses"), F.first("formatted").alias("formatted")))
    turns = read_turns(F.col("formatted"))
    loss = F.array_join(F.transform("losses", lambda x: x["text"]), "")
    return one.withColumns({"_turns": turns, "_loss": loss}).select(
        "conv_id", F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
