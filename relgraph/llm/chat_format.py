"""Chat formatting into budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens place the turns: a conversation's token line, without
its system turn, is cut into cells of ``stride`` tokens.  Turns that lie inside
one cell share its window; the turn that crosses a border has a window of its
own.  So spans are aligned with turns and a window needs no look at the ones
before it.  Each window begins with the system turn and as many of the turns
before it as fit the history budget.  Repeated turns carry no loss: each
assistant text is a target once.

A conversation may hold a large part of all rows.  Rows are therefore sorted by
range, which splits it over tasks, summed within tasks, and shifted by the sums
of the tasks before; windows are assembled by (conversation, window).

The template marks turns with ``<|im_start|>`` and ``<|im_end|>``.  Inside roles
and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so the marks cannot
occur there; a line break in a role becomes ``\\n``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relgraph.plans.staging import Staging

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY = 1024, 128
#: Tokens that the marks of a turn count for.
OVERHEAD = 4
SYSTEM, ASSISTANT = "system", "assistant"


def estimated_tokens(text: Column) -> Column:
    """A cautious count: two ASCII letters or digits, any other visible character, a byte beyond
    the first of a character, and a blank beside another make one token each.

    Byte-level vocabularies need fewer on texts in words; only runs of letters
    that stand in no vocabulary can take more, one a letter.  So the count grows
    with the length of a run, however long it is.
    """
    parts = F.regexp_count(text, F.lit("[A-Za-z0-9]{1,2}|[^A-Za-z0-9 ]| (?= )"))
    return (parts + F.octet_length(text) - F.length(text)).cast("bigint")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Inverse of both: what stands between doubled backslashes holds single ones only."""
    parts = F.split(text, "\\\\\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(plain, "\\")


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the right side's keys go."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`")) for k in keys]
    return left.join(right, condition, how).drop(*[f"__r_{k}" for k in keys])


def place_turns(turns: DataFrame, staging: Staging, budget: int, history: int, tokens: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(turns with their place, system turns).

    ``turns`` has conv, turn, role, text.  The first result adds pos (the order
    of all rows), tokens, at (tokens of the conversation before the turn, the
    system turn not counted), stride and window; the second has one row (conv,
    role, text, pos, tokens) for each conversation that begins with a system turn.
    """
    order = ["conv", "turn", "role", F.xxhash64("text"), "__id"]
    rows = turns.withColumn("__id", F.monotonically_increasing_id()).withColumn("tokens", tokens(F.col("text")) + OVERHEAD)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__id")
    rows = rows.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id())
    rows, _ = staging.keep(rows, "sorted")
    sums = rows.groupBy("conv", "part").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "conv", "part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "t")]
    )
    local = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = _join(rows, carried, ["conv", "part"]).select(
        "conv", "turn", "role", "text", "pos", "tokens",
        (F.col("n_before") + F.count("pos").over(local)).alias("number"),
        (F.col("t_before") + F.coalesce(F.sum("tokens").over(local), F.lit(0))).alias("at"),
    )
    rows, _ = staging.keep(rows, "numbered")
    first = (F.col("number") == 0) & (F.col("role") == SYSTEM)
    system = rows.where(first).select("conv", "role", "text", "pos", "tokens")
    system, _ = staging.keep(system, "system")
    others = _join(rows.where(~first), system.select("conv", F.col("tokens").alias("held")), ["conv"], "left")
    held = F.coalesce("held", F.lit(0))
    # a system turn that leaves no room still leaves a quarter of the budget for new turns
    stride = F.greatest(F.lit(budget - history) - held, F.lit(max(1, budget // 4)), F.lit(history)).cast("bigint")
    others = others.withColumn("stride", stride).withColumn("at", F.col("at") - held)
    cell = F.expr("at div stride")
    crosses = F.expr("(at + tokens - 1) div stride") > cell
    placed = others.withColumn("window", 2 * cell + crosses.cast("bigint")).drop("held", "number")
    placed, _ = staging.keep(placed, "placed")
    return placed, system


def format_chats(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens: Callable[[Column], Column] = estimated_tokens,
) -> DataFrame:
    """One row per window: conv_id, window, n_turns, n_repeated, tokens, over_budget, formatted, loss.

    ``window`` rises along the conversation (with gaps).  The first
    ``n_repeated`` turns of a window are repeats; ``loss`` are the (start, end)
    code points, end exclusive, of its new assistant texts in ``formatted``.
    Rows go by turn, nulls first, ties by role and a hash of the text; repeated
    rows are turns like any other.  Null roles and texts are empty; rows with a
    null id are one conversation.  A single turn longer than the budget is a
    window of its own, uncut.  ``over_budget`` marks windows with more tokens
    than the budget: those of such a turn, and those that a long system turn
    leaves too little room.
    """
    if history * 2 > budget or history < 0:
        raise ValueError("history must be at most half of the budget")
    staging = Staging(conversations.sparkSession)
    turns = conversations.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    placed, system = place_turns(turns, staging, budget, history, tokens)
    windows = placed.groupBy("conv", "window").agg(F.min("at").alias("begins"))
    # a conversation of a system turn alone has one window, without a start of its own
    alone = _join(system, placed.select("conv").distinct(), ["conv"], "left_anti").select(
        "conv", F.lit(0).cast("bigint").alias("window"), F.lit(0).cast("bigint").alias("begins")
    )
    windows, _ = staging.keep(windows.union(alone), "windows")
    earliest = windows.groupBy("conv").agg(F.min("window").alias("earliest"))

    columns = ["conv", "window", "pos", "role", "text", "tokens", "repeated"]
    new = placed.withColumn("repeated", F.lit(False)).select(*columns)
    last = 2 * F.expr(f"(at + {history}) div stride") + 1
    later = placed.withColumn("own", F.col("window")).withColumn("window", F.explode(F.sequence(F.col("own") + 1, F.greatest(last, F.col("own") + 1))))
    before = _join(later, windows, ["conv", "window"]).where(f"begins > at and begins - at <= {history}")
    before = before.withColumn("repeated", F.lit(True)).select(*columns)
    held = _join(_join(windows, system, ["conv"]), earliest, ["conv"])
    held = held.withColumn("repeated", F.col("window") > F.col("earliest")).select(*columns)

    # repeats come first and the system turn before all; positions are in the order of the conversation
    turn = F.struct((~F.col("repeated")).alias("new"), "pos", "role", "text")
    grouped = new.unionByName(before).unionByName(held).groupBy("conv", "window").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.sum("tokens").alias("tokens")
    )
    shaped = F.transform(
        "turns",
        lambda t: F.struct(
            t["new"].alias("new"),
            (t["new"] & (t["role"] == ASSISTANT)).alias("target"),
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    tail = f"{END}\n"
    sized = F.transform(
        "shaped",
        lambda t: F.struct(
            t["target"].alias("target"),
            F.length(t["head"]).cast("bigint").alias("head"),
            F.length(t["body"]).cast("bigint").alias("body"),
        ),
    )
    zero = F.lit(0).cast("bigint")
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    state = F.struct(zero.alias("at"), empty.alias("spans"))

    def span(s: Column, t: Column) -> Column:
        begin = s["at"] + t["head"]
        own = F.array(F.struct(begin.alias("start"), (begin + t["body"]).alias("end")))
        return F.struct(
            (begin + t["body"] + len(tail)).alias("at"),
            F.when(t["target"], F.concat(s["spans"], own)).otherwise(s["spans"]).alias("spans"),
        )

    formatted = F.array_join(F.transform("shaped", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "")
    return grouped.withColumn("shaped", shaped).select(
        F.col("conv").alias(conv_col),
        "window",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size(F.filter("turns", lambda t: ~t["new"])).cast("bigint").alias("n_repeated"),
        "tokens",
        (F.col("tokens") > budget).alias("over_budget"),
        formatted.alias("formatted"),
        F.aggregate(sized, state, span, lambda s: s["spans"]).alias("loss"),
    )


def read_turns(formatted: Column, skip: Column) -> Column:
    """The (role, text) of a formatted window behind its first ``skip`` turns."""
    pieces = F.split(formatted, "<\\|im_end\\|>\n", -1)
    pieces = F.filter(pieces, lambda p, i: (p != "") & (i >= skip))
    head = len(START)

    def turn(p: Column) -> Column:
        line = F.locate("\n", p)
        role = F.substring(p, F.lit(head + 1), line - head - 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(p, line + 1, F.length(p))).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, in one string."""
    return F.array_join(F.transform(F.arrays_zip(loss.alias("s"), F.array_repeat(formatted, F.size(loss)).alias("f")), lambda x: unescape(F.substring(x["f"], x["s"]["start"].cast("int") + 1, (x["s"]["end"] - x["s"]["start"]).cast("int")))), "")
