"""Chat formatting in budgeted windows.

DataFrame functions only. Prefix sums of turn tokens cut a conversation into spans of
whole turns. Every window repeats the system turn and a limited history in front of its
span; the loss mask covers assistant texts of the span alone, so each is a target once.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from formbook.llm.common import word_count

TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
MARK_TOKENS = 4  # markers and role of a turn
BUDGET = 512
HISTORY = 128


def escaped(text: Column) -> Column:
    """Text without control strings: ``\\`` becomes ``\\s`` and ``<|`` becomes ``\\l``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\s"), F.lit("\\"))


def windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """One row per window: ``conv_id, span, formatted, new_at, loss, n_tokens``.

    A turn has its words plus ``MARK_TOKENS`` tokens. A first turn of role ``system`` opens every window. The tokens
    after it are divided at multiples of ``budget - history - system`` (a quarter of the budget at least): turns
    within one division share a span, a turn across divisions is a span of its own. So windows
    keep to the budget unless one turn or the system turn alone is too long; turns are never split. ``new_at`` is the
    code point at which turns not seen before begin, ``loss`` the code point ranges (``at``, ``n``) of the targets.

    Turns are ordered by number, nulls last, then by role and text; repeated rows are turns of their own. Null roles and texts
    count as empty, null conversations as one conversation. Other columns are ignored.
    """
    order = [F.col("turn").asc_nulls_last(), "role", "text"]
    in_conv = Window.partitionBy("conv_id")
    ordered = in_conv.orderBy(*order)
    frame = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    frame = (
        frame.withColumn("tokens", word_count(F.col("text")) + MARK_TOKENS)
        .withColumn("head", (F.row_number().over(ordered) == 1) & (F.col("role") == "system"))
        .withColumn("lead", F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY)))
        .withColumn("piece", F.concat("lead", escaped(F.col("text")), F.lit(END)))
        .withColumn("system", F.coalesce(F.first(F.when(F.col("head"), F.col("piece")), True).over(in_conv), F.lit("")))
        .withColumn("system_tokens", F.max(F.when(F.col("head"), F.col("tokens")).otherwise(0)).over(in_conv))
        .withColumn("stride", F.greatest(F.lit(budget - history) - F.col("system_tokens"), F.lit(max(budget // 4, 1))))
        .withColumn(
            "start",
            F.when(F.col("head"), -1).otherwise(
                F.coalesce(F.sum("tokens").over(before), F.lit(0)) - F.col("system_tokens")
            ),
        )
    )
    first = F.floor(F.col("start") / F.col("stride"))
    last = F.floor((F.col("start") + F.col("tokens") - 1) / F.col("stride"))
    span = F.when(~F.col("head"), 2 * first + F.when(first == last, 0).otherwise(1))
    by_start = in_conv.orderBy("start")
    # Turns of the conversation's body that begin within ``history`` tokens before this one.
    recent = by_start.rangeBetween(-history, -1)
    frame = (
        frame.withColumn("span", span)
        .withColumn("span", F.coalesce("span", F.lead("span").over(by_start), F.lit(0)).cast("long"))
        .withColumn("recent", F.collect_list(F.when(~F.col("head"), F.col("piece"))).over(recent))
        .withColumn("recent_from", F.min(F.when(~F.col("head"), F.col("start"))).over(recent))
    )
    rows = F.sort_array(F.collect_list(F.struct("start", "role", "piece", "lead", "recent", "recent_from", "tokens", "head")))
    grouped = frame.groupBy("conv_id", "span").agg(
        rows.alias("rows"), F.first("system").alias("system"), F.first("system_tokens").alias("system_tokens")
    )
    opening = F.col("rows")[0]
    grouped = (
        grouped.withColumn("opening", opening)
        .withColumn("past", F.when(F.col("opening.head"), F.lit("")).otherwise(F.concat("system", F.array_join("opening.recent", ""))))
        .withColumn("new_at", F.length("past").cast("long"))
        .withColumn("formatted", F.concat("past", F.array_join("rows.piece", "")))
    )
    # Targets: positions follow from the lengths of the pieces before.
    placed = F.aggregate(
        "rows",
        F.struct(F.col("new_at").alias("at"), F.array().cast("array<struct<at:bigint,n:bigint>>").alias("loss")),
        lambda acc, r: F.struct(
            (acc["at"] + F.length(r["piece"])).alias("at"),
            F.when(
                r["role"] == "assistant",
                F.concat(
                    acc["loss"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(r["lead"])).alias("at"),
                            (F.length(r["piece"]) - F.length(r["lead"]) - len(END)).cast("long").alias("n"),
                        )
                    ),
                ),
            )
            .otherwise(acc["loss"])
            .alias("loss"),
        ),
        lambda acc: acc["loss"],
    )
    own = F.aggregate("rows", F.lit(0).cast("long"), lambda acc, r: acc + r["tokens"])
    past_tokens = F.when(F.col("opening.head"), 0).otherwise(
        F.col("system_tokens") + F.coalesce(F.col("opening.start") - F.col("opening.recent_from"), F.lit(0))
    )
    return grouped.select(
        "conv_id",
        "span",
        "formatted",
        "new_at",
        placed.alias("loss"),
        (own + past_tokens).cast("long").alias("n_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns, loss_text, formatted_chars`` parsed from the windows.

    ``turns`` has role, line feed, text, line feed per turn; ``loss_text`` all text under the mask, unescaped. A conversation
    is one string here, so its windows are gathered in one row.
    """
    new = F.slice(F.split(F.expr("substring(formatted, new_at + 1)"), r"<\|turn\|>", -1), 2, 1 << 30)
    turn = F.transform(
        new,
        lambda x: F.concat(
            unescaped(F.substring_index(x, BODY, 1)),
            F.lit("\n"),
            unescaped(F.substring_index(F.substring_index(x, BODY, -1), END, 1)),
            F.lit("\n"),
        ),
    )
    targets = F.transform(
        "loss", lambda r: unescaped(F.col("formatted").substr((r["at"] + 1).cast("int"), r["n"].cast("int")))
    )
    parts = formatted.select(
        "conv_id",
        "span",
        F.size(new).cast("long").alias("n"),
        F.array_join(turn, "").alias("turns"),
        F.array_join(targets, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("chars"),
    )
    rows = F.sort_array(F.collect_list(F.struct("span", "turns", "loss_text")))
    return (
        parts.groupBy("conv_id")
        .agg(F.sum("n").alias("n_turns"), rows.alias("rows"), F.sum("chars").alias("formatted_chars"))
        .select(
            "conv_id",
            "n_turns",
            F.array_join("rows.turns", "").alias("turns"),
            F.array_join("rows.loss_text", "").alias("loss_text"),
            "formatted_chars",
        )
    )
