"""Chat formatting: conversations as token-budgeted training windows, in built-in functions only.

Prefix sums of turn tokens cut a conversation into windows that begin and end
between turns.  Every window repeats the opening system turn and a little of
the turns before it; what is repeated is never under the loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window, and tokens of earlier turns repeated in the next one.
BUDGET, HISTORY = 1_024, 192
#: Tokens that the template itself adds to a turn.
MARKS = 4
#: Turn numbers that share one partial sum.
CHUNK = 64

OPEN, CLOSE = "### ", " </turn>\n"
#: Characters that control strings are made of, and what stands for them inside texts.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x09-\x0D ]"


def escape(c: Column, header: bool = False) -> Column:
    """Text without the characters of control strings; a header also loses its colons."""
    for plain, coded in ESCAPES[: 4 if header else 3]:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    """The inverse of ``escape`` for texts and headers; the backslash comes last."""
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def format_windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """One row per window: ``conv_id, window, text, loss, repeated, turns, tokens``.

    ``loss`` lists the spans (start, length, in code points of ``text``) of the
    assistant texts that are new in the window; ``repeated`` counts the leading
    turns that stand elsewhere already.  ``window`` orders the windows of a
    conversation.  Without its system turn and history a window takes at most
    what ``budget`` leaves for them; only one longer turn, kept whole and alone,
    can exceed that.  Null texts and roles count as empty; turns with equal
    numbers go by role and text, null numbers first; null conv_ids form one
    conversation.  An empty table gives no rows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turns = turns.select(
        "*",
        (F.regexp_count("text", F.lit(TOKEN)) + MARKS).cast("long").alias("n"),
        F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62))).alias("chunk"),
    )
    # the opening turn of each conversation, and what stands before each chunk of turns
    opening = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text", "n")).alias("o"))
    is_system = F.col("o.role") == "system"
    opening = opening.select(
        F.col("conv_id").alias("_c"),
        is_system.alias("has_system"),
        F.when(is_system, F.col("o.text")).alias("system"),
        F.when(is_system, F.col("o.n")).otherwise(0).alias("system_n"),
    )
    chunks = turns.groupBy("conv_id", "chunk").agg(F.sum("n").alias("k"), F.count("*").alias("m"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    chunks = chunks.select(
        F.col("conv_id").alias("_d"),
        F.col("chunk").alias("_chunk"),
        F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("turns_before"),
    )
    inner = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    sums = inner.rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.select(
        "*", F.sum("n").over(sums).alias("upto"), F.row_number().over(inner).alias("row")
    )
    turns = turns.join(
        chunks, _same(turns["conv_id"], chunks["_d"]) & (turns["chunk"] == chunks["_chunk"])
    )
    turns = turns.join(opening, _same(turns["conv_id"], opening["_c"]))
    room = F.greatest(F.lit(budget - history) - F.col("system_n"), F.lit(2 * MARKS))
    stride = F.floor(room / 2)
    turns = turns.select(
        "conv_id",
        "role",
        "text",
        "n",
        "has_system",
        "system_n",
        (F.col("turns_before") + F.col("row")).alias("at"),
        (F.col("tokens_before") + F.col("upto") - F.col("n") - F.col("system_n")).alias("start"),
        stride.alias("stride"),
    )
    # a turn belongs to the stride in which it starts; one longer than a stride ends it, alone
    long_turn = (F.col("n") > F.col("stride")).cast("long")
    plain = turns.filter(~(F.col("has_system") & (F.col("at") == 1)))
    plain = plain.withColumn("window", F.floor(F.col("start") / F.col("stride")) * 2 + long_turn)

    following = Window.partitionBy("conv_id").orderBy("window")
    windows = plain.groupBy("conv_id", "window").agg(F.min("start").alias("begins"))
    windows = windows.select(
        F.col("conv_id").alias("_c"),
        F.col("window").alias("_w"),
        F.row_number().over(following).alias("nth"),
        F.lead("window").over(following).alias("next"),
        F.lead("begins").over(following).alias("next_begins"),
    )
    placed = plain.join(
        windows.drop("nth"),
        _same(plain["conv_id"], windows["_c"]) & (plain["window"] == windows["_w"]),
    )
    new = F.struct(F.col("window"), F.lit(2).alias("kind"))
    again = F.struct(F.col("next").alias("window"), F.lit(1).alias("kind"))
    near = F.col("next_begins") - F.col("start") <= history
    copies = F.when(near, F.array(new, again)).otherwise(F.array(new))
    body = placed.select("conv_id", "role", "text", "n", "at", F.explode(copies).alias("p"))
    body = body.select("conv_id", "p.window", "p.kind", "at", "role", "text", "n")
    # the system turn opens every window; it is new in the first
    openings = opening.filter("has_system")
    heads = openings.join(windows, _same(openings["_c"], windows["_c"]), "left").select(
        openings["_c"].alias("conv_id"),
        F.coalesce("_w", F.lit(0)).alias("window"),
        F.when(F.coalesce("nth", F.lit(1)) == 1, 2).otherwise(0).alias("kind"),
        F.lit(0).cast("long").alias("at"),
        F.lit("system").alias("role"),
        F.col("system").alias("text"),
        F.col("system_n").alias("n"),
    )
    return _assemble(body.unionByName(heads))


def _assemble(parts: DataFrame) -> DataFrame:
    """Windows from their turns; kinds are 0 system again, 1 history, 2 new."""
    header = F.concat(F.lit(OPEN), escape(F.col("role"), header=True), F.lit(": "))
    coded = escape(F.col("text"))
    target = (F.col("kind") == 2) & (F.col("role") == "assistant")
    part = F.struct(
        "kind",
        "at",
        F.concat(header, coded, F.lit(CLOSE)).alias("piece"),
        F.when(target, F.length(header)).alias("skip"),
        F.length(coded).alias("length"),
        "n",
    )
    grouped = parts.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(part)).alias("t"))
    begins = lambda i: F.aggregate(
        F.slice("t", 1, i), F.lit(0), lambda total, x: total + F.length(x["piece"])
    )
    spans = F.transform(
        "t",
        lambda x, i: F.when(
            x["skip"].isNotNull(),
            F.struct((begins(i) + x["skip"]).alias("start"), x["length"].alias("length")),
        ),
    )
    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("text"),
        F.filter(spans, lambda s: s.isNotNull()).alias("loss"),
        F.size(F.filter("t", lambda x: x["kind"] < 2)).alias("repeated"),
        F.size("t").alias("turns"),
        F.aggregate("t", F.lit(0).cast("long"), lambda total, x: total + x["n"]).alias("tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per window the new turns as (role, text) and the loss texts, parsed from the output alone."""
    blocks = F.split("text", CLOSE.replace("\n", "\\n"))
    fresh = F.slice(blocks, F.col("repeated") + 1, F.greatest(F.col("turns") - F.col("repeated"), F.lit(0)))
    head = lambda b: F.substring_index(b, ": ", 1)
    turn = lambda b: F.struct(
        unescape(F.substr(head(b), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(b, F.length(head(b)) + 3)).alias("text"),
    )
    target = lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"]))
    return windows.select(
        "conv_id",
        "window",
        F.transform(fresh, turn).alias("new_turns"),
        F.transform("loss", target).alias("targets"),
        F.length("text").alias("chars"),
    )
