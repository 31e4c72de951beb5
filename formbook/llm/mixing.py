"""Mixing sources to target weights by fixed-length blocks.

The documents of a source form one stream of words, cut into blocks of a fixed length. A source's
number of draws follows from its target; every draw goes to a random output shard, so
the counts of a source over the shards are one multinomial draw. Draws map to blocks through
pseudorandom permutations of the source's block numbers, one per pass, and meet their blocks by number.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from formbook.llm.common import WORD, other_columns, quoted, row_columns, row_of, staged, word_count
from formbook.llm.scan import slices

BLOCK_WORDS = 128
SHARD_BLOCKS = 4096
MOST_PASSES = 3
ORDER_ROWS = 50_000  # rows ordered by one task
DRAWS = 1 << 16  # draws made by one task row
SEED = 20240229


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_PASSES) -> DataFrame:
    """``source, size`` per source with ``weight`` and ``target``.

    Sources in code point order, null last, take the weights in turn. Targets share the sum of all sizes by weight. A target stops at
    ``most`` times its source's size and its excess is shared again: with sources in order of size per weight, those
    below the level that the rest can reach are at their limit.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = F.pmod(F.row_number().over(everything) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    by_need = Window.orderBy(F.col("size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("size").over(whole) - most * F.coalesce(F.sum("size").over(before), F.lit(0))
    level = left / F.sum("weight").over(rest)
    weighted = weighted.withColumn("level", level)
    free = F.col("level") * F.col("weight") < most * F.col("size")
    weighted = weighted.withColumn("level", F.first(F.when(free, F.col("level")), True).over(whole))
    limit = (most * F.col("size")).cast("double")
    return weighted.withColumn("target", F.least(limit, F.coalesce(F.col("level") * F.col("weight"), limit))).drop("level")


def _plan(targets: DataFrame, block_words: int, most: int) -> DataFrame:
    """Block length, number of blocks, whole passes and further draws of each source."""
    length = F.least(F.lit(block_words), F.greatest(F.lit(1), F.ceil(F.col("size") / 64)))
    passes = F.least(F.floor(F.col("target") / F.greatest("size", F.lit(1))), F.lit(most))
    more = F.round((F.col("target") - F.col("passes") * F.col("size")) / F.col("length"))
    return (
        targets.withColumn("length", length.cast("long"))
        .withColumn("blocks", F.ceil(F.col("size") / F.col("length")).cast("long"))
        .withColumn("passes", passes.cast("long"))
        .withColumn("more", F.when(F.col("passes") < most, F.least(more, "blocks")).otherwise(0).cast("long"))
        .withColumn("draws", F.col("passes") * F.col("blocks") + F.col("more"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    )


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ``index`` under a pseudorandom permutation of ``range(n)``.

    A four-round Feistel network on the next even number of bits; values outside are sent round again.
    """
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)

    def turn(x):
        left, right = x >> half, x & mask
        for i in range(4):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + i * 0xD1342543DE82EF95) & (1 << 64) - 1)
            left, right = right, left ^ (_mixed(right + salt) & mask)
        return left << half | right

    out = turn(index.astype(np.uint64))
    while (away := out >= np.uint64(n)).any():
        out[away] = turn(out[away])
    return out.astype(np.int64)


def draws(plan: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """``rank, pass, block, shard, slot``: every draw of the mix, its block and its place in the output."""
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shards = F.ceil(F.sum("draws").over(whole) / shard_blocks)
    parts = plan.filter("draws > 0").withColumn("shards", F.greatest(shards, F.lit(1)).cast("long"))
    parts = parts.select(
        "rank", "blocks", "draws", "shards", F.explode(F.expr(f"sequence(0L, draws - 1, {DRAWS}L)")).alias("first")
    )

    def draw(batches):
        for batch in batches:
            for r in batch.to_pylist():
                k = np.arange(r["first"], min(r["first"] + DRAWS, r["draws"]), dtype=np.int64)
                shard = _mixed(k.astype(np.uint64) + np.uint64((seed + r["rank"] * 0x9E3779B97F4A7C15) & (1 << 64) - 1))
                turn, index = k // r["blocks"], k % r["blocks"]
                block = np.empty(len(k), np.int64)
                for p in np.unique(turn).tolist():
                    block[turn == p] = permuted(index[turn == p], r["blocks"], seed + 1000 * r["rank"] + p)
                columns = [
                    np.full(len(k), r["rank"], np.int32),
                    turn,
                    block,
                    (shard % np.uint64(r["shards"])).astype(np.int64),
                    _mixed(shard).view(np.int64),
                ]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["rank", "pass", "block", "shard", "slot"])

    return parts.repartition("rank", "first").mapInArrow(draw, "rank int, pass long, block long, shard long, slot long")


def _streams(docs: DataFrame, key: list[str], order: Column) -> DataFrame:
    """Add ``start``, the place of a document in its source's stream.

    Documents are ordered within hash buckets of bounded size, and buckets by number, so that no
    task orders a whole source.
    """
    count = docs.count()
    chunks = max(1, -(-count // ORDER_ROWS))
    docs = docs.withColumn("chunk", F.pmod(order, F.lit(chunks)))
    sums = docs.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("_source"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("source", "chunk").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("chunk") == F.col("_chunk"))
    return docs.join(offsets, same, "left").withColumn("start", F.col("offset") + F.col("inside")).drop("_source", "_chunk", "chunk", "offset", "inside")


def _placed(
    docs: DataFrame, id: str, text: str, source: str, weights: tuple[int, ...], block_words: int, most: int, kept: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Every document at its place in its source's stream, with its ``text`` if ``kept``; and the plan of the sources."""
    columns = [
        F.col(id).alias("id"),
        F.xxhash64(text).alias("hash"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text).cast("string")).alias("size"),
    ]
    frame = staged(docs.select(*columns, *([F.col(text).cast("string").alias("text")] if kept else [])), "sizes")
    sizes = frame.groupBy("source").agg(F.sum("size").alias("size"))
    plan = staged(_plan(source_targets(sizes, weights, most), block_words, most), "plan")
    # The plan has one row per source; Spark checks its size before broadcasting it.
    per_source = plan.select(
        F.col("source").alias("_source"), F.col("size").alias("source_size"), "target", "rank", "length", "passes"
    )
    placed = _streams(frame, ["id", "hash"], F.xxhash64("id", "hash"))
    placed = placed.join(per_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return staged(placed, "streams"), plan


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    block_words: int = BLOCK_WORDS,
    most: int = MOST_PASSES,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``id, hash, source, size, source_size, target, passes, taken, parts``.

    Size is the number of words, ``taken`` how many of them the drawn blocks hold, repeats counted: ``passes`` times all, and
    once more those in ``parts`` (word ranges ``a, b``). ``hash`` is the text's xxhash64. A source's blocks have ``block_words`` words,
    fewer if it has below 64 such blocks; its taken words are within one block of its target. Null texts
    have no words; null ids and null sources are treated as values; equal rows each have a place of their own.
    """
    placed, plan = _placed(docs, id, text, source, weights, block_words, most)
    # A block's number of draws beyond the whole passes is 0 or 1.
    used = draws(plan, seed=seed).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    touched = F.expr("sequence(start div length, (start + size - 1) div length)")
    held = placed.filter("size > 0").select("rank", "start", "size", "length", "passes", F.explode(touched).alias("block"))
    held = held.join(used, ["rank", "block"])
    a = F.greatest(F.col("block") * F.col("length") - F.col("start"), F.lit(0))
    b = F.least((F.col("block") + 1) * F.col("length") - F.col("start"), F.col("size"))
    again = F.when(F.col("times") > F.col("passes"), F.struct(a.alias("a"), b.alias("b")))
    drawn = held.groupBy(F.col("rank").alias("_rank"), F.col("start").alias("_start")).agg(
        F.sum(F.col("times") * (b - a)).alias("taken"), F.sort_array(F.collect_list(again)).alias("parts")
    )
    mine = (F.col("rank") == F.col("_rank")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    joined = placed.join(drawn, mine, "left").withColumn("parts", F.coalesce("parts", none))
    return joined.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).select(
        "id", "hash", "source", "size", "source_size", "target", "passes", "taken", "parts"
    )


def shards(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    block_words: int = BLOCK_WORDS,
    most: int = MOST_PASSES,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> DataFrame:
    """The mix as packed blocks: ``shard, slot, source, pass, block, n_words, text``, one row per draw.

    Shards have ``shard_blocks`` blocks on average, slots count from 0 in random order. ``block`` is the number of a block in
    its source's stream, ``text`` its words joined by a space, over the ends of documents. The words of a document in all
    rows together are those ``mix`` takes.
    """
    placed, plan = _placed(docs, id, text, source, weights, block_words, most, kept=True)
    word = re.compile(WORD)

    def cut(batches):
        for batch in slices(batches):
            out = ([], [], [], [], [])
            for body, rank, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                words = word.findall(body)
                for block in range(start // length, (start + len(words) - 1) // length + 1):
                    some = words[max(0, block * length - start) : (block + 1) * length - start]
                    for column, value in zip(out, (rank, block, start, len(some), " ".join(some))):
                        column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out, kinds)), ["rank", "block", "start", "n", "piece"])

    pieces = placed.filter("size > 0").select("text", "rank", "length", "start")
    pieces = pieces.mapInArrow(cut, "rank int, block long, start long, n long, piece string")
    packed = pieces.groupBy("rank", "block").agg(
        F.sum("n").alias("n_words"),
        F.array_join(F.sort_array(F.collect_list(F.struct("start", "piece")))["piece"], " ").alias("text"),
    )
    place = Window.partitionBy("shard").orderBy("slot", "rank", "pass", "block")
    dealt = draws(plan, shard_blocks, seed).withColumn("slot", F.row_number().over(place) - 1)
    made = dealt.join(packed, ["rank", "block"]).join(plan.select("rank", "source"), "rank")
    return made.select("shard", "slot", "source", "pass", "block", "n_words", "text")


def mixed_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as documents: a row per whole pass, and one with the words of the further draws joined by a space.

    The other columns are those of the document, whatever their names; documents of which the mix takes nothing have no
    row, nor do those with null or empty text. Rows equal in id, text and source each get one plan of theirs.
    """
    words = F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    taken = mix(docs, id, text, source, **options).filter("taken > 0")
    # Equal rows have equal keys; their plans are numbered so that each row meets one.
    number = Window.partitionBy("_id", "_hash", "_from").orderBy("_order")
    rest = other_columns(docs, [text])
    keyed = docs.select(
        row_of(rest).alias("_row"), quoted(text).cast("string").alias("_text"), quoted(id).alias("_id"),
        F.xxhash64(quoted(text)).alias("_hash"), quoted(source).cast("string").alias("_from"), F.lit(0).alias("_order"),
    ).withColumn("_n", F.row_number().over(number))
    plans = taken.select(
        F.col("id").alias("_id2"), F.col("hash").alias("_hash2"), F.col("source").alias("_from2"), "passes", "parts",
        F.row_number().over(Window.partitionBy("id", "hash", "source").orderBy("taken", "parts")).alias("_n2"),
    )
    same = (
        F.col("_id").eqNullSafe(F.col("_id2"))
        & (F.col("_hash") == F.col("_hash2"))
        & F.col("_from").eqNullSafe(F.col("_from2"))
        & (F.col("_n") == F.col("_n2"))
    )
    piece = F.array_join(
        F.flatten(F.transform("parts", lambda p: F.slice("_words", (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))), " "
    )
    joined = keyed.join(plans, same).withColumn("_words", F.when(F.size("parts") > 0, words))
    copies = F.concat(
        F.array_repeat(F.col("_text"), F.col("passes").cast("int")),
        F.when(F.size("parts") > 0, F.array(piece)).otherwise(F.array().cast("array<string>")),
    )
    done = joined.select("_row", F.explode(copies).alias("_text"))
    fields = dict(zip(rest, row_columns(rest)))
    return done.select(*[fields.get(c, F.col("_text").alias(c)) for c in docs.columns])
