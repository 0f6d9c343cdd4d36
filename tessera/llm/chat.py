"""Chat formatting from event logs: fold each conversation's events to final messages, then render them.

All of it is DataFrame expressions. An event has a conversation, a sequence number, a kind, the message that
it is about, a role and a text:

    message     opens the message with its role and text (a later one for the same message replaces both)
    delta       appends its text
    edit        replaces the whole text
    regenerate  drops the text; it and the deltas after it make the new one
    delete      removes the message, unless a later event opens it again

Logs are partitioned by conversation once; messages are folded and turns joined within that partitioning, so
texts are shuffled once. One conversation is one value of the result, and its digests need all of it in
order, so a conversation can't be split further; the sort by sequence spills.

The template renders a turn as OPEN role SEP text CLOSE. A control string inside a role or text gets a
backslash after its first character, and such forms with backslashes get one more, so the escape can be undone
and no control string is left but the template's own. The loss mask is run lengths over the formatted
string, one run for each turn: `skip` characters without loss, `take` under loss, `rest` without.

Edge cases. Null texts and roles count as empty; null conversations make one conversation; null turns come
first. Turns of one number are ordered by role, then text, and repeated rows each stay a turn. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, SEP, CLOSE = "[INST]", "[/INST]", "</s>"
#: A control string after its first character, in the syntax that Java's and DuckDB's patterns share.
_TAIL = r"(?:/?INST\]|/s>)"
ESCAPE = (r"([\[<])(\\*" + _TAIL + ")", r"$1\\$2")
UNESCAPE = (r"([\[<])\\(\\*" + _TAIL + ")", "$1$2")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def as_events(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of whole turns as an event log: one `message` event for each row, equal turns told apart by `copy`."""
    return turns.repartition(conv).select(
        F.col(conv).alias("conv"),
        F.struct(F.col(turn).alias("turn"), F.row_number().over(Window.partitionBy(conv, turn).orderBy(role, text)).alias("copy")).alias("message"),
        F.col(turn).alias("seq"),
        F.lit("message").alias("kind"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    )


def as_streams(events: DataFrame, streamed: str = "assistant") -> DataFrame:
    """A log of `message` events as a live one would have them; it folds to the same messages.

    A message of the streamed role is opened empty, begun, regenerated and streamed in three deltas; any other is drafted and
    then edited. seq becomes a struct of the message's and the event's place in it.
    """
    text, n = F.coalesce("text", F.lit("")), F.char_length(F.coalesce("text", F.lit("")))
    third = F.floor(n / 3).cast("int")
    no = F.lit(None).cast("string")
    event = lambda at, kind, said: F.struct(F.lit(at).alias("at"), F.lit(kind).alias("kind"), said.alias("text"))
    live = [event(0, "message", no), event(1, "delta", F.substring(text, F.lit(1), third)), event(2, "regenerate", no)]
    live += [event(3 + k, "delta", F.substring(text, third * k + 1, third if k < 2 else n)) for k in range(3)]
    drafted = [event(0, "message", F.substring(text, F.lit(1), third)), event(1, "edit", text)]
    parts = F.when(F.col("role") == streamed, F.array(*live)).otherwise(F.array(*drafted))
    rows = events.select("conv", "message", "seq", "role", F.explode(parts).alias("e"))
    return rows.select("conv", "message", F.struct("seq", "e.at").alias("seq"), "e.kind", F.when(F.col("e.at") == 0, F.col("role")).alias("role"), "e.text")


def by_conversation(events: DataFrame) -> DataFrame:
    """An event log partitioned by conversation, as as_events() gives it; fold() and render() then need no further shuffle."""
    return events.repartition("conv")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv, message, seq, role, text) of an event log (conv, message, seq, kind, role, text).

    seq is that of the message's first event. Events of one message with equal seq are ordered by kind, then role, then text.
    """
    # 'message' before 'delta' at one seq, so that a stream may open and start at once.
    rank = F.when(F.col("kind") == "message", 0).when(F.col("kind") == "regenerate", 1).when(F.col("kind") == "edit", 2).when(F.col("kind") == "delta", 3).when(F.col("kind") == "delete", 4)
    rank = F.coalesce(rank, F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))).cast("int"))
    event = F.struct(F.col("seq").alias("seq"), rank.alias("rank"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    logs = events.groupBy("conv", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    # The text starts at the last event that isn't a delta.
    start = F.greatest(F.lit(1), F.array_max(F.transform("log", lambda e, i: F.when(e["rank"] != 3, i + 1))))
    opened = F.array_max(F.transform("log", lambda e, i: F.when(e["rank"] == 0, i + 1)))
    text = F.array_join(F.transform(F.expr("slice(log, start, size(log))"), lambda e: e["text"]), "")
    return (
        logs.withColumn("start", start)
        .withColumn("opened", F.coalesce(opened, F.lit(1)))
        .filter(F.element_at("log", F.col("start"))["rank"] != 4)
        .select("conv", "message", F.element_at("log", 1)["seq"].alias("seq"), F.element_at("log", F.col("opened"))["role"].alias("role"), text.alias("text"))
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv, formatted, runs) of final messages: the formatted conversation and its loss mask as run lengths."""
    head, body = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SEP)), escape(F.col("text"))
    n_head, n_body, loss = F.char_length("head").cast("long"), F.char_length("body").cast("long"), F.col("role") == loss_role
    run = F.struct(
        F.when(loss, n_head).otherwise(n_head + n_body).alias("skip"),
        F.when(loss, n_body).otherwise(F.lit(0).cast("long")).alias("take"),
        F.lit(len(CLOSE)).cast("long").alias("rest"),
    )
    turns = messages.withColumn("head", head).withColumn("body", body).select("conv", F.struct("seq", "message", F.concat("head", "body", F.lit(CLOSE)).alias("segment"), run.alias("run")).alias("t"))
    whole = turns.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv", F.array_join("t.segment", "").alias("formatted"), F.col("t.run").alias("runs"))


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with `turns` (array of role and text) and `loss` (all text under the mask), unescaped, from string and runs alone."""
    parts = F.slice(F.split("formatted", CLOSE), 1, F.size(F.split("formatted", CLOSE)) - 1)

    def turn(part: Column) -> Column:
        cut = F.split(part, SEP.replace("[", r"\[").replace("]", r"\]"), 2)
        return F.struct(unescape(F.substring(cut[0], len(OPEN) + 1, 2**31 - 1)).alias("role"), unescape(cut[1]).alias("text"))

    def under(part: Column, run: Column) -> Column:
        return unescape(F.substring(part, (run["skip"] + 1).cast("int"), run["take"].cast("int")))

    return formatted.withColumn("parts", parts).withColumn("turns", F.transform("parts", turn)).withColumn("loss", F.array_join(F.zip_with("parts", "runs", under), "")).drop("parts")


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of conversations as read back from their formatted strings."""
    back = read_back(formatted)
    return back.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Formatted conversations of a table of whole turns."""
    return render(fold(as_events(turns, conv, turn, role, text)))
