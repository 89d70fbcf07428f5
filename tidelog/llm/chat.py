"""Chat formatting with a grammar round trip, in built-in functions only.

A conversation is rendered by one production per turn::

    turn := "<s>[ROLE] " role " [/ROLE] " text " </s>"

and read back by a deterministic parser: the first `` </s>`` ends a turn, control strings inside a role or text
are an error, and a backslash before a control string is taken away. The recovered turns are compared with the
source. Conversations that do not come back identical have their conflicting content escaped (one more
backslash before every control string, behind backslashes it already has) and are compared again; since spaces stand
between content and marks, the second trip succeeds for any content, and anything else is an error.

The loss mask is a list of runs per turn: code points without loss, then code points with loss (an assistant's text as
it stands in the output, escapes included), so it needs no offsets into the whole.

A conversation is one training record, so its turns come together in one row, whatever their number; that is the
only grouping.

Defined cases: null texts and roles are empty. Turns with the same number follow by role, then text. Repeated rows are
turns of their own. A null turn comes first, rows with a null ``conv_id`` are one conversation. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
CONTROL = r"(?:</?s>|\[/?ROLE\]|\[/?INST\])"
# A run of backslashes is entered at its start only and never given back.
ESCAPABLE = rf"(?<!\\)(\\*+)({CONTROL})"
ESCAPED = rf"(?<!\\)\\(\\*+{CONTROL})"
BARE = rf"(?<!\\){CONTROL}"
TURN = r"(?s)<s>\[ROLE\] .*? \[/ROLE\] .*? </s>"
OPEN, MIDDLE, CLOSE = "<s>[ROLE] ", " [/ROLE] ", " </s>"
MARKS = len("<s>[ROLE]  [/ROLE]  </s>")
BEFORE_TEXT = len("<s>[ROLE]  [/ROLE] ")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def render(turns: Column) -> Column:
    """The text of a conversation from its turns (role, text)."""
    each = F.transform(
        turns, lambda t: F.concat(F.lit("<s>[ROLE] "), t["role"], F.lit(" [/ROLE] "), t["text"], F.lit(" </s>"))
    )
    return F.array_join(each, "")


def _marked(formatted: Column) -> Column:
    """Turns as they stand in the output, from mark to mark."""
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def _raw(formatted: Column) -> Column:
    """Roles and texts as they stand in the output, escapes included."""

    def body(turn: Column) -> Column:
        return turn.substr(F.lit(len(OPEN) + 1), F.length(turn) - len(OPEN + CLOSE))

    def cut(inner: Column) -> Column:
        role = F.substring_index(inner, MIDDLE, 1)
        text = inner.substr(F.length(role) + len(MIDDLE) + 1, F.length(inner))
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(F.transform(_marked(formatted), body), cut)


def parse(formatted: Column) -> Column:
    """Turns (role, text) recovered from a formatted conversation; null if it breaks the grammar."""
    raw = _raw(formatted)
    lengths = F.aggregate(
        raw, F.lit(0), lambda n, t: n + F.length(t["role"]) + F.length(t["text"]) + MARKS
    )
    clean = F.forall(raw, lambda t: ~t["role"].rlike(BARE) & ~t["text"].rlike(BARE))
    turns = F.transform(
        raw, lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))
    )
    return F.when((lengths == F.length(formatted)) & clean, turns)


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_runs``, ``escaped``."""
    rows = conversations.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("ordered")
    )
    source = grouped.select(
        "conv_id", F.transform("ordered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )
    plain = source.withColumn("plain", render(F.col("turns")))
    tried = plain.withColumn("same", parse(F.col("plain")).eqNullSafe(F.col("turns")))
    guarded = F.transform(
        "turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))
    )
    formatted = tried.withColumn("formatted", F.when(F.col("same"), F.col("plain")).otherwise(render(guarded)))
    back = F.when(F.col("same"), F.col("turns")).otherwise(parse(F.col("formatted")))
    proved = F.when(back.eqNullSafe(F.col("turns")), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("no round trip: conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    )
    return formatted.select(
        "conv_id", proved.cast("string").alias("formatted"), loss_runs(F.col("formatted")).alias("loss_runs"),
        (~F.col("same")).alias("escaped"),
    )


def loss_runs(formatted: Column) -> Column:
    """Per turn the code points without loss (``off``), then with loss (``on``); a turn ends with five more off."""

    def run(t: Column) -> Column:
        learned = t["role"] == "assistant"
        head = F.length(t["role"]) + BEFORE_TEXT
        size = F.length(t["text"])
        return F.struct(
            F.when(learned, head).otherwise(head + size).alias("off"), F.when(learned, size).otherwise(0).alias("on")
        )

    return F.transform(_raw(formatted), run)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the parser recovers: turns, text under the loss mask, and lengths."""
    parsed = formatted.select("conv_id", "formatted", "loss_runs", parse(F.col("formatted")).alias("turns"))
    joined = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    # The mask is laid over the output: a run covers one turn of it, from mark to mark.
    learned = F.zip_with(
        _marked(F.col("formatted")), "loss_runs",
        lambda turn, r: F.when(r["on"] > 0, turn.substr(r["off"] + 1, r["on"])).otherwise(F.lit("")),
    )
    loss = F.array_join(F.transform(learned, unescape), "")
    return parsed.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
