"""Chat formatting from an event log, with DataFrame functions only.

A log has one row for each event: conv_id, turn, seq, kind, role, text. Kinds:

* ``message`` opens a message with its text,
* ``delta`` appends its text to the open message of its turn (streamed output),
* ``edit`` and ``regenerate`` replace the text of the open message; later deltas append to that.

The log is dealt by conversation and sorted by turn and seq. A running count of messages numbers
them, each message's events are folded to its final text, and the messages are rendered. One
exchange serves all steps, as each groups by the conversation first. A conversation's events meet
in one task because its formatted text is one value; sorting spills, and only final texts are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template: a turn is HEAD role ROLE_END text TURN_END.
HEAD, ROLE_END, TURN_END = "### ", "</role>", "</turn>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    r"""Make control strings harmless: \ and # get a \ before them, and so do the / of </turn> and </role>."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("#"), F.lit("\\#"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("</role>"), F.lit("<\\/role>"))


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log of one ``message`` for each row of conv_id, turn, role, text."""
    return turns.select(
        "conv_id", "turn", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )


def messages(log: DataFrame) -> DataFrame:
    """conv_id, number, role, text: the final messages of each conversation, numbered from 1.

    Null roles and texts count as empty; events of one turn and seq go in order of kind, role and
    text (message first); repeated ``message`` rows are messages of their own. Events before any message of
    their conversation form a message 0. Other columns of the log are ignored.
    """
    order = F.when(F.col("kind") == "message", 0).otherwise(1)
    rows = log.select(
        "conv_id", "turn", "seq", order.alias("later"), F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "seq", "later", "kind", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.withColumn("number", F.sum(F.when(F.col("kind") == "message", 1).otherwise(0)).over(so_far))
    # Each replacing event starts a new version; the last version's pieces are the final text.
    versioned = counted.withColumn("version", F.sum(F.when(F.col("kind") == "delta", 0).otherwise(1)).over(so_far))
    placed = versioned.withColumn("place", F.row_number().over(in_order))
    of_message = Window.partitionBy("conv_id", "number").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = placed.withColumn("last", F.max("version").over(of_message)).withColumn("role", F.first("role").over(of_message))
    piece = F.struct("place", "text")
    final = last.where("version = last").groupBy("conv_id", "number").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"), F.min("role").alias("role")
    )
    return final.select(
        "conv_id", "number", "role", F.array_join(F.transform("pieces", lambda x: x["text"]), "").alias("text")
    )


def render(final: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """conv_id, n_turns, formatted, loss: spans (start, length in code points) of trained texts."""
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(ROLE_END))
    body = escape(F.col("text"))
    parts = final.select("conv_id", "number", "role", head.alias("head"), body.alias("body"))
    parts = parts.withColumn("size", F.length("head") + F.length("body") + len(TURN_END))
    before = Window.partitionBy("conv_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("head"))
    turn = F.struct(
        "number", F.concat("head", "body", F.lit(TURN_END)).alias("piece"), "start",
        F.length("body").alias("length"), (F.col("role") == trained_role).alias("trained"),
    )
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    trained = F.filter("turns", lambda x: x["trained"])
    return turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(
            trained, lambda x: F.struct(x["start"].cast("bigint").alias("start"), x["length"].cast("bigint").alias("length"))
        ).alias("loss"),
    )


def read_back(output: DataFrame) -> DataFrame:
    """``output`` with turns (role, text), parsed from its formatted text, and loss_text from its spans."""
    pieces = F.split("formatted", TURN_END, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(HEAD) + 1, 2147483647)
        role = F.substring_index(rest, ROLE_END, 1)
        text = F.substr(rest, F.length(role) + len(ROLE_END) + 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    spans = F.transform(
        "loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int")))
    )
    return output.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", F.array_join(spans, ""))


def digest(output: DataFrame) -> DataFrame:
    """What was read back, as lengths and hashes."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(output).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
