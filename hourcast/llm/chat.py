"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

Events are rows ``conv_id, turn, seq, kind, role, text``:

* ``message``: the turn's text (and role) starts here;
* ``edit``: the turn's text is replaced;
* ``regenerate``: the turn's text is thrown away and starts again with this text;
* ``delta``: text appended to the turn.

A turn is folded by taking its last event that starts the text anew and appending,
in ``seq`` order, the deltas behind it (:func:`fold`).  :func:`render` writes the
messages of a conversation in turn order as

    <|im_start|>ROLE newline TEXT<|im_end|> newline

Inside roles and texts every ``<`` + n backslashes + ``|`` gets one more
backslash, so neither control string can occur there, and :func:`unescape` takes
it away again; a line feed in a role is written ``<|n|>``.

Messages are first rendered in chunks of ``CHUNK_TURNS`` turns, and only the
chunks' strings meet in their conversation, so sorting, folding and rendering of a
conversation that holds a third of all rows is spread over many tasks.

The loss mask is a list aligned with the turns: ``skip`` code points of the turn's
rendering do not count, the next ``take`` do (none for a role other than
assistant).

Defined results: null text and null role are empty strings; a null ``conv_id`` is
a conversation of its own; rows tied in turn and seq follow in order of role and
text, and each ``message`` row with its own ``seq`` value stays one message; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
CHUNK_TURNS = 64
ASSISTANT = "assistant"
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    """Make both control strings impossible inside ``text``; see :func:`unescape`."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    # <| cannot come from escape(), which puts a backslash into it
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n|>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n|>"), F.lit("\n")))


def message_events(rows: DataFrame) -> DataFrame:
    """A table of finished messages (conv_id, turn, role, text) as events.

    Rows of one conversation with the same turn stay separate messages.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    return rows.select("conv_id", "turn", F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"),
                       role.alias("role"), text.alias("text"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, chunk, turn, role, text) of streamed events.

    Events are dealt by conversation and chunk of turns once; folding and the
    rendering of chunks use that partitioning.
    """
    e = events.select(
        "conv_id", "turn", F.floor(F.col("turn") / CHUNK_TURNS).alias("chunk"), "seq",
        F.col("kind").isin(*RESETS).alias("resets"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = (e.repartition("conv_id", "chunk")
             .groupBy("conv_id", "chunk", "turn")
             .agg(F.sort_array(F.collect_list(F.struct("seq", "resets", "role", "text"))).alias("events")))
    last = F.coalesce(F.array_max(F.transform(F.filter("events", lambda x: x.resets), lambda x: x.seq)),
                      F.array_min(F.transform("events", lambda x: x.seq)))
    live = F.filter("events", lambda x: (x.seq >= F.col("last")) | F.col("last").isNull())
    # several events that start anew at the same seq are several messages
    starts = F.filter("live", lambda x: x.resets & x.seq.eqNullSafe(F.col("last")))
    deltas = F.array_join(F.transform(F.filter("live", lambda x: ~x.resets), lambda x: x.text), "")
    folded = turns.withColumn("last", last).withColumn("live", live).withColumn("starts", starts)
    messages = F.when(F.size("starts") > 1, F.transform("starts", lambda x, i: F.struct(
        x.role.alias("role"),
        F.when(i == F.size("starts") - 1, F.concat(x.text, deltas)).otherwise(x.text).alias("text"))
    )).otherwise(F.array(F.struct(
        F.col("live")[0]["role"].alias("role"),
        F.when(F.size("starts") == 1, F.concat(F.col("starts")[0]["text"], deltas))
        .otherwise(deltas).alias("text"))))
    return folded.select("conv_id", "chunk", "turn", messages.alias("messages"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_mask."""
    header = lambda m: F.concat(F.lit(START), escape_role(m.role), F.lit("\n"))
    turn = lambda m: F.concat(header(m), escape(m.text), F.lit(END + "\n"))      # noqa: E731
    mask = lambda m: F.struct(                                                    # noqa: E731
        F.char_length(header(m)).cast("long").alias("skip"),
        F.when(m.role == ASSISTANT, F.char_length(escape(m.text))).otherwise(0).cast("long").alias("take"))
    all_of = lambda c: F.flatten(F.transform(F.sort_array(c), lambda x: x.messages))
    # null conversations and turns are ordinary keys here; nulls sort first
    chunks = (messages.groupBy("conv_id", "chunk")
              .agg(F.collect_list(F.struct("turn", "messages")).alias("turns"))
              .select("conv_id", "chunk", all_of(F.col("turns")).alias("m"))
              .select("conv_id", "chunk", F.size("m").cast("long").alias("n"),
                      F.array_join(F.transform("m", turn), "").alias("formatted"),
                      F.transform("m", mask).alias("mask")))
    whole = chunks.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("chunk", "formatted", "mask"))).alias("c"))
    return whole.select(
        "conv_id", "n_turns", F.array_join(F.transform("c", lambda x: x.formatted), "").alias("formatted"),
        F.flatten(F.transform("c", lambda x: x.mask)).alias("loss_mask"))


def format_events(events: DataFrame) -> DataFrame:
    """Fold events and render every conversation."""
    return render(fold(events))


def parse(formatted: DataFrame) -> DataFrame:
    """Read renderings back: adds ``turns`` (role, text) and ``loss_texts``, the
    unescaped text under the loss mask of every turn."""
    pieces = F.filter(F.split("formatted", F.lit(r"(?<=<\|im_end\|>\n)")), lambda x: x != "")
    body = lambda x: F.substr(x, F.lit(len(START) + 1),                          # noqa: E731
                              F.char_length(x) - len(START) - len(END) - 1)
    cut = formatted.withColumn("__pieces", pieces)
    turns = F.transform("__pieces", lambda x: F.struct(
        unescape_role(F.substring_index(body(x), "\n", 1)).alias("role"),
        unescape(F.substr(body(x), F.char_length(F.substring_index(body(x), "\n", 1)) + 2)).alias("text")))
    loss = F.transform(F.arrays_zip(F.col("__pieces").alias("p"), F.col("loss_mask").alias("m")),
                       lambda z: unescape(F.substr(z.p, (z.m.skip + 1).cast("int"), z.m.take.cast("int"))))
    return cut.withColumn("turns", turns).withColumn("loss_texts", loss).drop("__pieces")
