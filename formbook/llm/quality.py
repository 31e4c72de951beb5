"""Quality rules per document, and a verdict per host from shrunk failure rates.

DataFrame functions only. Statistics are array expressions within a row, so no
words are shuffled. Host rates are pulled towards the corpus rate by a beta prior fitted to
the spread of rates between hosts.
"""

from pyspark.sql import Column, DataFrame, functions as F

from formbook.llm.common import SPACE_CLASS, WORD, other_columns, quoted, row_columns, row_of, staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50  # per cent of the words
MAX_HOST_RATE = 0.5


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Words are runs outside ``[\\x20\\x09-\\x0D]``; null text has none. Columns of these names, in any case, are replaced.
    """
    body = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.translate(x, " \t\r\x0b\x0c", "") != "")
    pairs = F.arrays_zip(
        F.col("_words").alias("a"),
        F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))).alias("b"),
        F.slice("_words", 3, F.greatest(F.size("_words"), F.lit(1))).alias("c"),
    )
    windows = F.transform(
        F.slice(pairs, 1, F.greatest(F.size("_words") - 2, F.lit(0))), lambda x: F.xxhash64(x["a"], x["b"], x["c"])
    )
    ranked = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Neighbours in hash order are equal where a window repeats.
    repeated = F.filter(
        F.arrays_zip(
            F.col("_ranked").alias("x"),
            F.concat(F.array(F.lit(None).cast("bigint")), F.col("_ranked.h")).alias("before"),
            F.slice(F.col("_ranked.h"), 2, F.greatest(F.size("_ranked"), F.lit(1))).alias("after"),
        ),
        lambda z: z["x"].isNotNull()
        & (z["x"]["h"].eqNullSafe(z["before"]) | z["x"]["h"].eqNullSafe(z["after"])),
    )
    starts = F.sort_array(F.transform(repeated, lambda z: z["x"]["i"]))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct(
            (acc["n"] + p + 3 - F.greatest(p, acc["end"])).alias("n"), (p + 3).alias("end")
        ),
        lambda acc: acc["n"],
    )
    none = F.array().cast("array<int>")
    named = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rest = other_columns(docs, named)
    return (
        docs.select(row_of(rest).alias("_row"), quoted(text).cast("string").alias("_text"))
        .withColumn("_words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
        .withColumn("_lines", lines)
        .withColumn("_windows", windows)
        .withColumn(
            "_ranked",
            # Most texts repeat nothing and need no sort.
            F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), ranked),
        )
        .withColumn("_starts", F.when(F.col("_ranked").isNull(), none).otherwise(starts))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(body, SPACE_CLASS, "")).cast("long"))
        .withColumn("n_symbols", (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", covered.cast("long"))
        .select(*row_columns(rest), *named)
    )


def with_base_rules(stats: DataFrame, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return stats.withColumn("base_failed", failed)


def host_rates(rules: DataFrame, host: str) -> DataFrame:
    """``host, n, failed, rate`` per host: the posterior mean of its failure rate.

    The beta prior has the corpus rate as its mean. Its strength comes from the variance between hosts
    beyond what sampling explains; without any such variance every host has the corpus rate.
    """
    hosts = staged(
        rules.filter(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")),
        "hosts",
    )
    # One row of sums, whatever the number of hosts.
    row = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("square"),
    ).first()
    if not row["hosts"]:
        return hosts.withColumn("rate", F.lit(None).cast("double"))
    mean = row["failed"] / row["n"]
    spread = row["square"] / row["n"] - mean * mean
    between = spread - row["hosts"] * mean * (1 - mean) / row["n"]
    if mean in (0, 1) or between <= 0:
        return hosts.withColumn("rate", F.lit(float(mean)))
    strength = max(mean * (1 - mean) / between - 1, 0.0)
    return hosts.withColumn("rate", (F.col("failed") + F.lit(strength * mean)) / (F.col("n") + F.lit(strength)))


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE, **rules
) -> DataFrame:
    """``docs`` without text, with the statistics, ``base_failed``, ``host_rate`` and ``kept``.

    A document is kept if it passes the base rules and its host's shrunk failure rate is at most ``max_rate``. Null hosts have
    no verdict: their documents stand for themselves. Repeated rows count as often as they occur. Columns named like the
    added ones are replaced.
    """
    base = staged(with_base_rules(statistics(docs, text).drop(text), **rules), "quality")
    rates = host_rates(base, host).select(F.col("host").alias(host), F.col("rate").alias("host_rate"))
    judged = base.drop("host_rate", "kept").join(rates, host, "left")
    fine = F.coalesce(F.col("host_rate") <= max_rate, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & fine)
