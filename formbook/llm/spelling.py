"""Spelling variants: words one edit apart, found by pivotal grams (Deng, Li and Feng, SIGMOD 2014).

A word's bigrams are ordered by how rare they are among all words. Its three rarest are its prefix; two of them that do
not overlap are its pivots. One edit leaves a pivot untouched, and the word whose prefix ends earlier in the order has a
pivot in the other's prefix. An untouched gram moves by at most the difference in length, so pivots are looked up under
gram, length and position.
"""

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from formbook.llm.bpe import short_batches
from formbook.llm.common import quoted, staged

MIN_LENGTH = 6
MIN_COUNT = 5
DOMINANCE = 5  # times as frequent as the word it is a form of
MISSPELT = 199  # one in so many runs loses a code point
COUNTED = 200_000  # different words a task counts before it passes them on
PREFIX = 3  # bigrams; edits * gram length + 1
# (change in length, shift of a gram) that one edit can cause: replaced; inserted behind, before; deleted behind, before.
MOVES = [(0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)]

_runs = re.compile("[A-Za-zÀ-ÿ]+").findall
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def spelt(key: bytes, run: str) -> str:
    """The run as it is counted: one in 199 loses a code point, by the checksum of ``key`` and run."""
    h = zlib.crc32(run.encode(), zlib.crc32(key))
    if h % MISSPELT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n``: words of enough code points and occurrences in all texts.

    Null text has no words; a null id is an empty key. Equal documents count as often as they occur.
    """

    def count(batches):
        words: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"]
            )

        for batch in short_batches(batches):
            for key, body in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                key = f"{key or ''}:".encode()
                for run, n in Counter(_runs((body or "").translate(_LOWER))).items():
                    word = spelt(key, run)
                    if len(word) >= min_length:
                        words[word] += n
            if len(words) > COUNTED:
                yield out()
                words.clear()
        if words:
            yield out()

    texts = docs.select(quoted(id).cast("string").alias("_id"), quoted(text).cast("string").alias("_text"))
    counts = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _grams(word: Column) -> Column:
    """Bigrams with their positions, from 1."""
    return F.transform(
        F.sequence(F.lit(1), F.char_length(word) - 1), lambda i: F.struct(F.substring(word, i, F.lit(2)).alias("gram"), i.alias("at"))
    )


def _with_prefix(words: DataFrame) -> DataFrame:
    """Words with their ``prefix`` in gram order, rarest first; equal grams by position.

    Rarity is the number of places a gram has in all words. Grams as rare are ordered by their letters.
    """
    places = words.select("word", F.explode(_grams(F.col("word"))).alias("g")).select("word", "g.*")
    rarity = staged(places.groupBy("gram").agg(F.count(F.lit(1)).alias("places")), "gram_order")
    entry = F.struct("places", "gram", "at")
    ordered = places.join(rarity, "gram").groupBy("word").agg(F.array_sort(F.collect_list(entry)).alias("grams"))
    last = F.get(F.col("grams"), F.lit(PREFIX - 1))
    # Further places of the last gram belong to the prefix too: which of them is meant is not known.
    reach = F.filter("grams", lambda g: F.struct(g["places"], g["gram"]) <= F.struct(last["places"], last["gram"]))
    return ordered.select(
        "word",
        F.char_length("word").alias("size"),
        F.struct(last["places"].alias("places"), last["gram"].alias("gram")).alias("last"),
        reach.alias("prefix"),
    )


def _pivots(prefix: Column) -> Column:
    """The two grams of a prefix that do not overlap and have the fewest places together.

    Dynamic programming over the positions: the state holds the cheapest choice of no, one and two grams that ends
    before a position, and the choice of one that held a gram earlier.
    """
    gram = "struct<places: bigint, gram: string, at: int>"
    choice = f"struct<cost: bigint, picked: array<{gram}>>"

    def nothing(picks: int) -> Column:
        cost = F.lit(0 if picks == 0 else None).cast("long")
        return F.struct(cost.alias("cost"), F.array().cast(f"array<{gram}>").alias("picked")).cast(choice)

    def cheaper(a: Column, b: Column) -> Column:
        return F.when(a["cost"].isNull() | (b["cost"] < a["cost"]), b).otherwise(a)

    def plus(before: Column, g: Column) -> Column:
        return F.struct(
            (before["cost"] + g["places"]).alias("cost"), F.concat(before["picked"], F.array(g)).alias("picked")
        ).cast(choice)

    def state(one: Column, two: Column, one_before: Column, at: Column) -> Column:
        return F.struct(one.alias("one"), two.alias("two"), one_before.alias("one_before"), at.alias("at"))

    def step(s: Column, g: Column) -> Column:
        # ``one`` may hold the gram at the position before, which overlaps ``g``; ``one_before`` does not.
        apart = F.when(g["at"] - s["at"] >= 2, s["one"]).otherwise(s["one_before"])
        return state(cheaper(s["one"], plus(nothing(0), g)), cheaper(s["two"], plus(apart, g)), s["one"], g["at"])

    by_place = F.array_sort(
        F.transform(prefix, lambda g: F.struct(g["at"].alias("at"), g["places"].alias("places"), g["gram"].alias("gram")))
    )
    grams = F.transform(by_place, lambda g: F.struct(g["places"].alias("places"), g["gram"].alias("gram"), g["at"].alias("at")).cast(gram))
    start = state(nothing(1), nothing(2), nothing(1), F.lit(-1))
    return F.aggregate(grams, start, step)["two"]["picked"]


def near_words(words: DataFrame) -> DataFrame:
    """``word, near``: both directions of every pair of words one inserted, deleted or replaced code point apart.

    ``words`` are distinct and have four code points at least, so that the prefix holds two grams without overlap.
    """
    prefixed = staged(_with_prefix(words.select("word")), "gram_prefixes")
    index = prefixed.select(
        F.col("word").alias("near"), F.col("last").alias("near_last"), "size", F.explode("prefix").alias("g")
    ).select("near", "near_last", "size", "g.gram", "g.at")
    moves = F.array(*[F.struct(F.lit(a).alias("longer"), F.lit(b).alias("shift")) for a, b in MOVES])
    probes = (
        prefixed.select("word", "last", "size", F.explode(_pivots(F.col("prefix"))).alias("g"))
        .select("word", "last", "size", "g.gram", "g.at", F.explode(moves).alias("m"))
        .select(
            "word", "last", "gram", (F.col("size") + F.col("m.longer")).alias("size"), (F.col("at") + F.col("m.shift")).alias("at")
        )
        .filter(F.col("at") >= 1)
    )
    # The side whose prefix ends earlier probes; if both end alike, both do, and the pair is kept once below.
    found = probes.join(index, ["gram", "size", "at"]).filter(
        (F.col("last") <= F.col("near_last")) & (F.col("word") != F.col("near"))
    )
    pairs = found.filter(F.levenshtein("word", "near", 1) == 1).select(
        F.least("word", "near").alias("word"), F.greatest("word", "near").alias("near")
    )
    pairs = staged(pairs.distinct(), "near_words")
    return pairs.union(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms followed to the last; each round doubles the steps followed.

    A form is more frequent than its word, so there are no rings and few rounds.
    """
    known = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        known = known.join(further, "root", "left")
        known = staged(
            known.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots"
        )
        if known.filter("_moved").isEmpty():
            return known.drop("_moved")


def spelling_variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``word, n`` with ``n_near``, ``form``, ``form_n`` and ``root``; a row per word.

    ``words`` are distinct and of four code points at least. ``form`` is the near word of largest ``n`` (ties: smallest
    in code-point order) if that is at least ``dominance`` times the word's own; ``root`` is the last word reached by
    forms, the word itself if it has none. Words alone have no near words and null forms; no words give no rows.
    """
    words = staged(words.select("word", "n"), "words")
    near = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    most = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    per_word = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), most.alias("most"))
    joined = words.join(per_word, "word", "left")
    dominant = -F.col("most.less") >= dominance * F.col("n")
    judged = staged(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(dominant, F.col("most.near")).alias("form"),
            F.when(dominant, -F.col("most.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
