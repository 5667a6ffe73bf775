"""Chat formatting: conversations are folded from an event log, then rendered.

Everything here is DataFrame expressions; no Python runs on the executors.

The log
-------
One row is one event: ``conv_id``, ``seq`` (the order inside a conversation),
``message`` (which message of the conversation the event belongs to; null: the
event is a message of its own), ``kind``, ``role``, ``text``.

* ``message``: the message's text is this text.
* ``delta``: this text is appended to the message.
* ``edit``: the message's text becomes this text.
* ``regenerate``: the text so far is dropped; this text (if any) starts anew,
  and later deltas are appended to it.

A message stands where its first event stands; its role is that of its first
event that names one, or null. Events with equal seq are taken in the order kind, role,
text, with nulls first. Any other kind changes nothing.

The template
------------
``<|im_start|>role`` + line end + ``text<|im_end|>`` + line end for each
message. In roles and texts ``&`` is written ``&amp;`` and ``<|`` is written
``&lt;|`` (in roles also the line end as ``&#10;``), so no control string can
come from a text, and reading the output back gives the texts unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PIECE = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def streamed(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The event log that a chat service would leave of ``turns`` (conv_id, turn, role, text).

    An assistant's message is begun with a draft, regenerated, and streamed in
    deltas of ``piece`` code points; any other is sent with a slip and edited.
    Each row is a message of its own, repeated rows too. seq is (turn, number of
    the event in its message). Null texts count as empty.
    """
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("message"))
    size = F.char_length("text")
    event = lambda number, kind, text: F.struct(number.cast("int").alias("number"), F.lit(kind).alias("kind"), text.alias("text"))
    draft = F.array(event(F.lit(0), "delta", F.lit("On second thoughts")), event(F.lit(1), "regenerate", F.lit(None).cast("string")))
    deltas = F.transform(F.sequence(F.lit(0), F.floor(size / piece).cast("int")), lambda k: event(k + 2, "delta", F.substr("text", k * piece + 1, F.lit(piece))))
    sent = F.array(event(F.lit(0), "message", F.concat(F.lit("*"), F.substr("text", F.lit(1), F.lit(piece)))), event(F.lit(1), "edit", F.col("text")))
    log = rows.select("conv_id", "turn", "message", "role", F.inline(F.when(F.col("role") == "assistant", F.concat(draft, deltas)).otherwise(sent)))
    return log.select("conv_id", F.struct("turn", "number").alias("seq"), "message", "kind", "role", "text")


def fold_messages(events: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text): the final messages of the log.

    Null texts count as empty. An empty log gives no rows. Columns besides the
    six of the log are ignored. Only one message's own events meet in a row;
    a message that is a single event goes by without a shuffle.
    """
    log = events.select("conv_id", "seq", "message", F.coalesce("kind", F.lit("message")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    alone = log.where("message is null and kind in ('message', 'edit', 'delta', 'regenerate')").select("conv_id", "seq", "role", "text")

    event = F.struct("seq", "kind", "role", "text")
    several = log.where("message is not null").groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(event)).alias("events"))
    step = lambda text, e: (
        F.when(e["kind"] == "delta", F.array_append(text, e["text"]))
        .when(e["kind"].isin("message", "edit", "regenerate"), F.array(e["text"]))
        .otherwise(text)
    )
    folded = several.select(
        "conv_id",
        F.col("events")[0]["seq"].alias("seq"),
        F.get(F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(0)).alias("role"),
        F.array_join(F.aggregate("events", F.array().cast("array<string>"), step), "").alias("text"),
    )
    return alone.unionByName(folded)


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, mask): one row per conversation.

    Messages are put in order of seq, then role, then text (nulls first);
    repeated messages all stay. mask has a struct (lead, body, tail, loss) of
    lengths in code points for each turn: over the formatted text, ``lead`` is
    the turn's header, ``body`` its escaped text, ``tail`` its end; loss is
    true where the body is to be learned, which is the assistant's.
    """
    turn = F.struct("seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("body"),
                (t["role"] == "assistant").alias("loss"),
            ),
        ).alias("parts"),
    )
    tail = f"{END}\n"
    return parts.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "").alias("formatted"),
        F.transform(
            "parts",
            lambda p: F.struct(F.char_length(p["head"]).alias("lead"), F.char_length(p["body"]).alias("body"), F.lit(len(tail)).alias("tail"), p["loss"].alias("loss")),
        ).alias("mask"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, turns, losses, formatted) from the formatted text alone.

    turns: array of (role, text), unescaped. losses: array of the unescaped
    texts under the mask, in order.
    """
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.greatest(F.size(F.split("formatted", r"<\|im_start\|>")) - 1, F.lit(0)))
    cut = rendered.select("conv_id", "formatted", "mask", pieces.alias("pieces"))
    role = lambda p: F.substring_index(p, "\n", 1)
    parse = lambda p: F.struct(
        unescape_role(role(p)).alias("role"),
        unescape(F.substr(p, F.char_length(role(p)) + 2, F.char_length(p) - F.char_length(role(p)) - len(f"\n{END}\n"))).alias("text"),
    )
    masked = F.filter(F.arrays_zip("pieces", "mask"), lambda z: z["mask"]["loss"])
    return cut.select(
        "conv_id",
        "formatted",
        F.transform("pieces", parse).alias("turns"),
        F.transform(masked, lambda z: unescape(F.substr(z["pieces"], z["mask"]["lead"] - len(START) + 1, z["mask"]["body"]))).alias("losses"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Event log in, (conv_id, n_turns, formatted, mask) out."""
    return render(fold_messages(events))
