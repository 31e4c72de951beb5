"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint bit is the majority of that bit over the hashes of all word
shingles. Two fingerprints at most ``max_bits`` apart agree on all but ``max_bits`` of ``blocks``
blocks, so they share the key made of some ``blocks - max_bits`` blocks. Candidates are joined on those keys and
verified by Hamming distance. Only distinct fingerprints are joined; their
documents follow through the fingerprint, so copies are never paired.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from formbook.llm.common import quoted, row_columns, row_of, staged
from formbook.llm.graph import components
from formbook.llm.scan import as_bytes, groups_of

BLOCKS = 6
CROWDED = 64  # fingerprints under one key; above, the key is refined
SEED = 42


def _shingle_hashes(text: bytes, width: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends)]


def _majority(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprint of each list; empty lists have zero."""
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.fromiter((h for part in hashes for h in part), np.uint64, int(sizes.sum()))
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    for bit in range(64):
        ones = np.add.reduceat((flat >> np.uint64(bit)) & np.uint64(1), starts)
        out[full] |= (2 * ones > sizes[full].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``id``, ``hash`` (the text's xxhash64) and ``fp``, the 64-bit fingerprint as a long.

    Words are runs outside ``[\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased. Fewer words than
    ``shingle`` make one shingle; null, empty and blank texts have fingerprint zero.
    """

    def scan(batches):
        for batch in batches:
            texts = as_bytes(batch.column(2))
            sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
            for a, b in groups_of(sizes):
                rows = texts.slice(a, b - a).to_pylist()
                fp = _majority([_shingle_hashes(t, shingle) for t in rows]).view(np.int64)
                kept = [batch.column(i).slice(a, b - a) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(fp)], ["id", "hash", "fp"])

    body = F.col(text).cast("string")
    frame = docs.select(F.col(id).alias("id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    return frame.mapInArrow(scan, f"id {kind}, hash long, fp long")


def block_masks(width: int, blocks: int, max_bits: int, within: int = -1) -> list[int]:
    """Bit masks of all choices of ``blocks - max_bits`` blocks among the set bits of ``within``."""
    bits = [i for i in range(width) if within >> i & 1]
    edges = [len(bits) * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << i for i in bits[a:b]) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(fps: DataFrame, masks: Column) -> DataFrame:
    return fps.withColumn("mask", F.explode(masks)).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def _crowds(keyed: DataFrame, most: int) -> DataFrame:
    return keyed.groupBy("mask", "key").count().filter(F.col("count") > most).drop("count")


def links(fps: DataFrame, max_bits: int = 3, blocks: int = BLOCKS, crowded: int = CROWDED) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints at most ``max_bits`` apart.

    Keys shared by more than ``crowded`` fingerprints are refined: the bits outside the key are
    split into blocks again, which at the default settings fixes 48 bits.
    """
    first = block_masks(64, blocks, max_bits)
    deeper = F.create_map(
        *[
            F.lit(x)
            if not isinstance(x, list)
            else F.array(*[F.lit(_signed(m | mask)) for m in x])
            for mask in first
            for x in (_signed(mask), block_masks(64, blocks, max_bits, ~mask & (1 << 64) - 1))
        ]
    )
    keyed = _keyed(fps.select("fp").distinct(), F.array(*[F.lit(_signed(m)) for m in first]))
    keyed = staged(keyed, "blocks")
    crowds = _crowds(keyed, crowded)
    sparse = keyed.join(crowds, ["mask", "key"], "left_anti")
    dense = keyed.join(crowds, ["mask", "key"], "left_semi")
    refined = _keyed(dense.select("fp", F.explode(deeper[F.col("mask")]).alias("mask")), F.array("mask"))
    ready = sparse.unionByName(refined.select("mask", "key", "fp").distinct())
    left = ready.select("mask", "key", F.col("fp").alias("a"))
    right = ready.select("mask", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.join(right, ["mask", "key"]).filter(F.col("a") < F.col("b")).filter(near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    blocks: int = BLOCKS,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per document: ``id, hash, fp, root`` and ``component``, the smallest id it is linked to.

    Links are transitive; ``root`` is the component's smallest fingerprint. Documents without an id keep their row and give a component no id; a component
    without any id has null. Extra columns are ignored.
    """
    fps = staged(fingerprints(docs, id, text, shingle), "fingerprints")
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    found = components(links(distinct, max_bits, blocks, crowded))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    member = rooted.select("fp", "root").join(least, "root")
    return fps.join(member, "fp").select("id", "hash", "fp", "root", "component")


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of every group: that of the smallest id, null ids last, then of the smallest text hash.

    Rows equal in id and text are one document. All columns stay.
    """
    found = near_duplicates(docs, id, text, **options)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "hash")).alias("kept"))
    kept = least.select(F.col("kept.id").alias("_id"), F.col("kept.hash").alias("_hash"))
    keyed = docs.select(
        row_of(docs.columns).alias("_row"), quoted(id).alias("_own"), F.xxhash64(quoted(text).cast("string")).alias("_key")
    )
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
    single = keyed.join(kept, same, "left_semi").dropDuplicates(["_own", "_key"])
    return single.select(*row_columns(docs.columns))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
