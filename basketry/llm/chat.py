"""Chat formatting in budgeted, turn-aligned windows; DataFrame functions only.

Template: every turn is ``<|turn|>role<|text|>text<|end|>``. Inside role and
text a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a
mark and :func:`unescape` restores it exactly.

Windows: prefix sums of turn tokens choose the longest span of whole turns
that fits the room left by the retained system turn and the repeated history.
A turn larger than that room gets a window of its own, whole. Every window
starts with the conversation's first system turn and up to ``history`` earlier
turns (at most a quarter of the budget); these repeats carry no loss. Loss
spans cover the text of each assistant turn in the one window where it is new.

A window also ends at every multiple of ``block_turns`` turns, counted in order:
a rule of the format, the same for every conversation. A budget that holds more
turns than that needs a larger ``block_turns``.

Scale: turns are numbered by ranges of (conversation, turn) and gathered by
those blocks, so no task gathers more than one block even when one conversation
holds a third of all rows or all turn numbers are null; the turns before a block
travel to it as history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import number_rows

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LAST = (1 << 63) - 1


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def turn_tokens(c: Column) -> Column:
    """Default size of a text: runs of letters or digits, and every other mark, plus 3 for the frame."""
    return F.regexp_count(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")).cast("long") + 3


def _framed(t: Column) -> Column:
    return F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT), escape(t["text"]), F.lit(END))


def format_windows(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    tokens_col: str | None = None,
    budget: int = 1024,
    history: int = 2,
    system_role: str = "system",
    target_role: str = "assistant",
    block_turns: int = 512,
) -> DataFrame:
    """One row per window: conv id, ``block``, ``window``, ``formatted``, ``n_repeated``, ``n_new``, ``n_tokens``, ``loss``.

    ``loss`` is an array of (start, stop) code-point offsets in ``formatted``,
    0-based, stop exclusive. Windows of a conversation are ordered by (block,
    window). Null texts and roles are empty; a null turn number comes last;
    equal turn numbers are ordered by role, then text; repeated rows stay, as
    turns of their own; rows with a null conversation id form one conversation
    of that id. Other columns of ``turns`` are ignored, and an empty table
    gives no windows. ``tokens_col`` names a column of token counts to use
    instead of :func:`turn_tokens`.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    size = turn_tokens(text) if tokens_col is None else F.coalesce(F.col(f"`{tokens_col}`").cast("long"), F.lit(0))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        text.alias("text"),
        size.alias("tokens"),
    )
    rows = number_rows(rows, "conv", ["turn", "role", "text"], "pos", "chat-turns")
    rows = rows.withColumn("block", F.floor(F.col("pos") / block_turns).cast("long"))
    # the last turns of a block are also the history of the next one
    own = F.struct(F.col("block").alias("b"), F.lit(0).alias("new"))
    next_one = F.struct((F.col("block") + 1).alias("b"), F.lit(1).alias("new"))
    carried = F.pmod("pos", F.lit(block_turns)) >= block_turns - history
    rows = rows.withColumn("place", F.explode(F.when(carried, F.array(own, next_one)).otherwise(F.array(own))))
    system = (
        rows.where((F.col("role") == system_role) & (F.col("place.new") == 0))
        .groupBy("conv")
        .agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("system"))
    )
    blocks = rows.groupBy("conv", F.col("place.b").alias("block")).agg(
        F.sort_array(
            F.collect_list(F.struct("pos", "turn", "role", "text", F.col("place.new").alias("carried"), "tokens"))
        ).alias("turns")
    )
    system = system.withColumnRenamed("conv", "conv_s")
    joined = blocks.join(system, F.col("conv").eqNullSafe(F.col("conv_s")), "left")
    room = F.lit(budget) - F.coalesce(F.col("system.tokens"), F.lit(0)) - F.lit(budget // 4)
    joined = joined.select("conv", "block", "system", "turns", F.greatest(F.lit(1).cast("long"), room).alias("room"))
    # running sums of tokens over the new turns; a turn that passes the room after the window's base opens a window
    start = F.struct(
        F.lit(0).cast("long").alias("sum"),
        F.lit(0).cast("long").alias("base"),
        F.array().cast("array<int>").alias("starts"),
        F.lit(0).alias("at"),
    )

    def step(s: Column, t: Column) -> Column:
        total = s["sum"] + t["tokens"]
        opens = (t["carried"] == 0) & ((F.size(s["starts"]) == 0) | (total - s["base"] > F.col("room")))
        return F.struct(
            F.when(t["carried"] == 0, total).otherwise(s["sum"]).alias("sum"),
            F.when(opens, s["sum"]).otherwise(s["base"]).alias("base"),
            F.when(opens, F.concat(s["starts"], F.array(s["at"]))).otherwise(s["starts"]).alias("starts"),
            (s["at"] + 1).alias("at"),
        )

    spans = joined.withColumn("starts", F.aggregate("turns", start, step)["starts"]).where(F.size("starts") > 0)
    spans = spans.select("conv", "block", "system", "turns", "starts", F.posexplode("starts").alias("window", "first"))
    after = F.coalesce(F.try_element_at("starts", F.col("window") + 2), F.size("turns"))
    spans = spans.withColumn("after", after).withColumn(
        "new", F.slice("turns", F.col("first") + 1, F.col("after") - F.col("first"))
    )
    # the nearest earlier turns, latest first, as long as they fit a quarter of the budget
    def fits(s: Column, t: Column) -> Column:
        ok = s["open"] & (s["sum"] + t["tokens"] <= budget // 4)
        return F.struct(
            F.when(ok, s["sum"] + t["tokens"]).otherwise(s["sum"]).alias("sum"),
            (s["n"] + F.when(ok, 1).otherwise(0)).alias("n"),
            ok.alias("open"),
        )

    none = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"), F.lit(True).alias("open"))
    spans = spans.withColumn(
        "behind", F.slice("turns", F.greatest(F.lit(1), F.col("first") - history + 1), F.least(F.col("first"), F.lit(history)))
    ).withColumn("n_history", F.aggregate(F.reverse("behind"), none, fits)["n"])
    spans = spans.withColumn(
        "behind", F.slice("behind", F.size("behind") - F.col("n_history") + 1, F.col("n_history"))
    )
    # the system turn is retained unless the window already shows it
    as_turn = F.struct(
        F.lit(-1).cast("long").alias("pos"), F.col("system.turn").alias("turn"), F.col("system.role").alias("role"), F.col("system.text").alias("text"),
        F.lit(0).alias("carried"), F.col("system.tokens").alias("tokens"),
    )
    same = lambda t: (t["turn"] == F.col("system.turn")) & (t["role"] == F.col("system.role")) & (t["text"] == F.col("system.text"))
    shown = F.col("system").isNull() | F.exists(F.concat("behind", "new"), same)
    spans = spans.withColumn("behind", F.when(shown, F.col("behind")).otherwise(F.concat(F.array(as_turn), F.col("behind"))))
    framed = spans.withColumn("frames", F.transform(F.concat("behind", "new"), _framed))
    lead = len(TURN) + len(TEXT)
    origin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"), F.array().cast("array<struct<start:int,stop:int>>").alias("loss"))

    def mark(s: Column, t: Column) -> Column:
        begin = s["at"] + F.length(escape(t["role"])) + lead
        stop = begin + F.length(escape(t["text"]))
        target = (t["role"] == target_role) & (s["k"] >= F.size("behind"))
        return F.struct(
            (stop + len(END)).alias("at"),
            (s["k"] + 1).alias("k"),
            F.when(target, F.concat(s["loss"], F.array(F.struct(begin.alias("start"), stop.alias("stop")))))
            .otherwise(s["loss"])
            .alias("loss"),
        )

    every = F.concat("behind", "new")
    return framed.select(
        F.col("conv").alias(conv_col),
        "block",
        "window",
        F.array_join("frames", "").alias("formatted"),
        F.size("behind").alias("n_repeated"),
        F.size("new").alias("n_new"),
        F.aggregate(every, F.lit(0).cast("long"), lambda s, t: s + t["tokens"]).alias("n_tokens"),
        F.aggregate(every, origin, mark)["loss"].alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window: an array of (role, text), unescaped."""
    parts = F.split(formatted, r"<\|end\|>")
    parts = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
            unescape(F.substring_index(p, TEXT, -1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask of a window, unescaped, in order, nothing between."""
    cut = F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["stop"] - s["start"])))
    return F.array_join(cut, "")


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the windows alone: ``turns_blob``, ``loss_blob``, ``n_turns``, ``formatted_chars``.

    ``turns_blob`` is role, newline, text, newline for every turn that is new
    in its window. One row holds a whole conversation, because its digest does.
    """
    own = F.slice(read_turns(F.col("formatted")), F.col("n_repeated") + 1, F.col("n_new"))
    blob = F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = windows.select(
        F.col(conv_col).alias("conv"),
        F.struct("block", "window", blob.alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("loss")).alias("part"),
        F.size(own).alias("n"),
        F.length("formatted").alias("chars"),
    )
    whole = parts.groupBy("conv").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("n").cast("long").alias("n_turns"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    return whole.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.col("parts.turns"), "").alias("turns_blob"),
        F.array_join(F.col("parts.loss"), "").alias("loss_blob"),
        "n_turns",
        "formatted_chars",
    )
