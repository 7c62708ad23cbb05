"""Chat formatting in budgeted windows, in DataFrame operations only.

Turns are written as `<|im_start|>role`, a line break, the text, `<|im_end|>` and a
line break. Prefix sums of turn tokens choose the windows: the leading system turn's
tokens are set aside, and of what is left half is a step; turns that begin in the same
step share a window, turns larger than a step stand alone. So a window's new turns
never hold more than two steps. Each window repeats the system turn and, as far as the
budget allows, a few earlier turns as context, which the loss mask leaves out; so each
assistant text is a target exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Workspace, only
from .ordering import PART, prefix_sums, range_parts

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of a window, context included, and earlier turns that a later window repeats at most.
BUDGET, HISTORY = 512, 2
#: Tokens that a turn's marks and role count for.
TURN_TOKENS = 4


def escaped(text: Column) -> Column:
    """No `<|` is left: a backslash becomes `\\b`, then `<|` becomes `\\l|`."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l|"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    """A role fills one line: line breaks become `\\n`."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _with_system(parted: DataFrame, order: list[Column], budget: int) -> DataFrame:
    """Adds system: the conversation's leading system turn (role, text, tokens), if it has one of at most half the budget.

    Inside a partition a window finds it; a conversation that goes on in later
    partitions takes it along in a table with a row for each partition at most.
    """
    first = F.struct("role", "text", "tokens")
    fits = lambda t: F.when((t["role"] == "system") & (t["tokens"] * 2 <= budget), t)
    inside = parted.withColumn("_first", fits(F.first(first).over(Window.partitionBy(PART, "group").orderBy(*order))))
    starts = parted.groupBy(F.col("group").alias("_g"), F.col(PART).alias("_p")).agg(fits(F.min(F.struct(*order, "tokens"))).alias("_s"))
    head = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Only conversations that began in an earlier partition: at most one for each partition.
    later = starts.withColumn("_s0", F.first("_s").over(head)).withColumn("_p0", F.first("_p").over(head)).where("_p > _p0").select("_g", "_p", F.lit(True).alias("_later"), F.struct(F.col("_s0.role").alias("role"), F.col("_s0.text").alias("text"), F.col("_s0.tokens").alias("tokens")).alias("_s"))
    joined = inside.join(F.broadcast(later), (F.col("group") == F.col("_g")) & (F.col(PART) == F.col("_p")), "left")
    found = F.when(F.coalesce("_later", F.lit(False)), F.when(F.col("_s.role").isNotNull(), F.col("_s"))).otherwise(F.col("_first"))
    return joined.select(*parted.columns, found.alias("system"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row for each window: conv_id, window, formatted, n_context (turns repeated), tokens, loss (spans start, length in characters).

    turns: conv_id, turn, role, text. Rows stand by turn; equal turns by role and text;
    null turns first. Null roles and texts are empty; rows with a null conv_id are one
    conversation. Only texts of role `assistant` that are new in a window are targets,
    their spans are over the formatted (escaped) text, starting from 0.

    A window holds at most budget tokens, context included, unless it is one turn that
    is larger by itself. The system turn is repeated first; a turn that leaves no room
    for it goes without, and a system turn of over half the budget is a turn like any
    other. Of the earlier turns the nearest are repeated while they fit. A conversation
    is never gathered: only a window's turns meet.
    """
    space = Workspace(turns.sparkSession, "chat")
    rows = only(turns, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").isNull().alias("no_id"), F.coalesce("conv_id", F.lit(0)).cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("tokens", (F.regexp_count("text", F.lit(WORD)) + TURN_TOKENS).cast("bigint"))
    rows = rows.withColumn("group", F.struct("no_id", "conv"))
    order = [F.col("group"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    parted = range_parts(rows, order, space, "parted")
    known = _with_system(parted, [F.col(n) for n in ("turn", "role", "text")], budget)
    known = known.withColumn("kept", F.coalesce(F.col("system.tokens"), F.lit(0)))  # tokens set aside
    known = space.save(known.withColumn("step", F.expr(f"greatest(1, ({budget} - kept) div 2)")), "known")
    # The system turn itself has index 0 and takes no part in the steps.
    summed = prefix_sums(known, "group", order[1:], {"before": F.col("tokens"), "idx": F.lit(1).cast("bigint"), "large": F.expr("cast(tokens > step as bigint)")})
    summed = summed.withColumn("alone", F.expr("tokens > step and (idx > 0 or kept = 0)")).withColumn("large", F.expr("large - if(idx > 0 and kept > step, 1, 0)"))
    at = F.expr("if(idx = 0, 0, before - kept) div step")
    summed = space.save(summed.withColumn("window", F.struct(at.alias("step"), "large", "alone")), "turns")
    own = summed.select("group", "window", "idx", "role", "text", "tokens", F.lit(True).alias("new"))
    # A window's first new turn, and the room that its new turns leave.
    firsts = summed.groupBy("group", "window").agg(F.min("idx").alias("first"), F.min("before").alias("from"), F.first("system").alias("system"), F.first("kept").alias("kept"), F.sum("tokens").alias("new_tokens")).where("first > 0")
    firsts = firsts.withColumn("room", F.expr(f"{budget} - new_tokens"))
    system = firsts.where("kept > 0 and room >= kept").select("group", "window", F.lit(0).cast("bigint").alias("idx"), "system.role", "system.text", F.col("kept").alias("tokens"), F.lit(False).alias("new"))
    lowest = F.greatest(F.expr("if(kept > 0, 1, 0)"), F.col("first") - history)
    wanted = firsts.where(F.lit(history) > 0).where(lowest < F.col("first")).select("group", "window", "from", F.expr("room - if(room >= kept, kept, 0)").alias("room"), F.explode(F.sequence(lowest, F.col("first") - 1)).alias("idx"))
    # Earlier turns from this one on fit together.
    past = wanted.where("room > 0").join(summed.select("group", "idx", "before", "role", "text", "tokens"), ["group", "idx"]).where(F.col("from") - F.col("before") <= F.col("room"))
    past = past.select("group", "window", "idx", "role", "text", "tokens", F.lit(False).alias("new"))
    every = own.unionAll(past).unionAll(system)
    piece = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"), escaped(F.col("text")), F.lit(END + "\n"))
    head = F.length(F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")))
    every = every.select("group", "window", F.struct("idx", piece.alias("piece"), F.length(piece).alias("n"), head.alias("head"), F.length(escaped("text")).alias("body"), (F.col("new") & (F.col("role") == "assistant")).alias("target"), "new", "tokens").alias("t"))
    built = every.groupBy("group", "window").agg(F.sort_array(F.collect_list("t")).alias("ts"))  # a window's turns
    # Span starts: characters of the pieces before.
    step = lambda acc, t: F.struct((acc["at"] + t["n"]).alias("at"), F.when(t["target"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["head"]).alias("start"), t["body"].alias("length"))))).otherwise(acc["spans"]).alias("spans"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return built.select(
        F.when(~F.col("group.no_id"), F.col("group.conv")).alias("conv_id"),
        "window",
        F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("formatted"),
        F.size(F.filter("ts", lambda t: ~t["new"])).alias("n_context"),
        F.aggregate("ts", F.lit(0).cast("bigint"), lambda n, t: n + t["tokens"]).alias("tokens"),
        F.aggregate("ts", zero, step)["spans"].alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from windows() alone.

    Windows are split at their marks, repeated turns are left out, roles and texts are
    unescaped; the loss text is cut out by the spans and unescaped. A digest is over
    the whole of a conversation, so here, and only here, its texts come together: a
    conversation of over 2 GB has no digest and ends the job.
    """
    turns = F.expr(r"slice(split(formatted, '<\\|im_start\\|>'), n_context + 2, greatest(0, size(split(formatted, '<\\|im_start\\|>')) - n_context - 1))")
    # A piece is: role, line break, text, end mark, line break.
    cut = F.transform(turns, lambda p: F.struct(F.substring_index(p, "\n", 1).alias("role"), p.alias("piece")))
    parsed = F.transform(cut, lambda t: F.struct(unescaped_role(t["role"]).alias("role"), unescaped(F.substring(t["piece"], F.length(t["role"]) + 2, F.length(t["piece"]) - F.length(t["role"]) - 2 - len(END))).alias("text")))
    loss = F.array_join(F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    own = formatted.select(
        "conv_id",
        F.struct("window", F.array_join(F.transform(parsed, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"), loss.alias("loss")).alias("w"),
        F.size(turns).alias("n"),
        F.length("formatted").alias("chars"),
    )
    grouped = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"), F.sum("n").cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"))
    text = {k: F.array_join(F.col(f"ws.{k}"), "") for k in ("turns", "loss")}
    return grouped.select(
        "conv_id",
        "n_turns",
        F.sha2(text["turns"].cast("binary"), 256).alias("turns_sha256"),
        F.length(text["loss"]).cast("bigint").alias("loss_chars"),
        F.sha2(text["loss"].cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """windows() written to the shared folder and read back."""
    space = Workspace(turns.sparkSession, "chat-out")
    return read_back(space.save(windows(turns, budget, history), "windows"))
