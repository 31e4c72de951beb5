"""Nearest neighbours by an inverted multi-index.

Each half of a vector is quantised on its own, so ``k`` centroids per half make ``k * k``
cells. A query walks the pairs of centroids from the best summed score down, with a heap, until the cells visited hold the wanted
share of all entries; those entries are scored exactly. Entries and queries meet in blocks of bounded size, queries of one
cell together: a block of queries meets only the blocks of entries whose cells it has visited, and multiplies only those.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from formbook.llm.common import staged

SAMPLE = 20_000  # vectors the codebooks are fitted on
LEAST_CENTROIDS, MOST_CENTROIDS = 8, 64  # per half, which bounds the cells held by the driver
SHARE = 0.8  # of the entries, scored for each query
ENTRY_BLOCK = 16_384
QUERY_BLOCK = 512
HIT = np.dtype([("query", "<i8"), ("id", "<i8"), ("score", "<f8")])
SLACK = 1e-9  # block products are rounded in another order than the final scores


def codebook(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centroids of k-means; copies of a vector count once when starting."""
    rng = np.random.default_rng(seed)
    start = np.unique(x, axis=0)
    c = start[rng.choice(len(start), min(k, len(start)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> np.ndarray:
    """Cells by descending sum of the two scores until they hold ``wanted`` entries."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    fa, sb = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    width, held, out = len(sb), 0, []
    counts = sizes.tolist()
    heap = [(-(fa[0] + sb[0]), 0, 0)]
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * width + b[j]
        held += counts[cell]
        out.append(cell)
        if j + 1 < width:
            heapq.heappush(heap, (-(fa[i] + sb[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(fa):
            heapq.heappush(heap, (-(fa[i + 1] + sb[0]), i + 1, 0))
    return np.array(out, np.int64)


def _valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _matrix(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, "<f8").reshape(-1, width)


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    share: float = SHARE,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` entries of largest inner product found for each query.

    Queries are the rows where ``queries`` holds; a query's own id is no candidate. Ties go to the smaller id. Rows with null id take no
    part, nor do vectors that are null, empty, zero, of another length than most, or with null or non-finite components.
    Rows repeating an id are entries of their own. The number of centroids follows the number of vectors; only the
    codebooks are fitted on a sample, of the smallest id hashes, every vector is indexed.
    """
    spark = vectors.sparkSession
    frame = vectors.select(
        F.col(id).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(queries, F.lit(False)).alias("query"),
    )
    frame = frame.filter(F.col("id").isNotNull() & _valid(F.col("v")))
    lengths = frame.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    kind = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], kind)
    width, total = lengths["width"], lengths["count"]
    frame = frame.filter(F.size("v") == width)
    half = (width + 1) // 2
    # The smallest hashes; all but a few rows beyond ``sample`` are left out before anything is sorted.
    edge = min(-(1 << 63) + int((1 << 64) * min(1.0, 1.2 * sample / total)), (1 << 63) - 1)
    drawn = frame.filter(F.xxhash64("id") <= F.lit(edge)).orderBy(F.xxhash64("id"), "id").limit(sample).select("v")
    drawn = drawn.mapInArrow(
        lambda it: (pa.RecordBatch.from_arrays([pa.array([np.stack(b.column(0).to_numpy(zero_copy_only=False)).tobytes()], pa.binary())], ["v"]) for b in it if b.num_rows),
        "v binary",
    )
    x = np.concatenate([_matrix(r["v"], width) for r in drawn.collect()])  # ``sample`` rows at most
    centroids = max(LEAST_CENTROIDS, min(MOST_CENTROIDS, round(math.sqrt(total / 50))))
    books = (codebook(x[:, :half], centroids, 1), codebook(x[:, half:] if width > 1 else x * 0, centroids, 2))
    cells = len(books[0]) * len(books[1])

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.stack(batch.column("v").to_numpy(zero_copy_only=False))
            second = v[:, half:] if width > 1 else v * 0
            cell = nearest(v[:, :half], books[0]) * len(books[1]) + nearest(second, books[1])
            blobs = pa.array([r.tobytes() for r in v], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("query"), pa.array(cell), blobs], ["id", "query", "cell", "v"])

    index = staged(frame.mapInArrow(assign, "id long, query boolean, cell long, v binary"), "index")
    sizes = np.zeros(cells, np.int64)
    for r in index.groupBy("cell").count().collect():  # MOST_CENTROIDS squared at most
        sizes[r["cell"]] = r["count"]
    offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    blocks = max(1, -(-total // ENTRY_BLOCK))

    # Cells follow each other over the blocks; a crowded cell has several, a block several small cells.
    def place(batches):
        for batch in batches:
            ids, cell = batch.column("id").to_numpy(), batch.column("cell").to_numpy()
            spread = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) / 2**53
            block = np.minimum((offset[cell] + spread * sizes[cell]) * blocks / total, blocks - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(block), *(batch.column(c) for c in ("id", "cell", "v"))], ["block", "id", "cell", "v"])

    def pack(batches):
        """A block's entries as rows of ``ENTRY_BLOCK`` at most: by their number, whatever tasks they come from."""
        held, size, at = [], 0, None

        def done():
            ids, cell, data = (np.concatenate([h[k] for h in held]) for k in range(3))
            columns = [at, ids.tobytes(), cell.tobytes(), data.tobytes()]
            kinds = (pa.int32(), *[pa.binary()] * 3)
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, kinds)], ["block", "ids", "cells", "data"])

        for batch in batches:
            block = batch.column("block").to_numpy()
            ids, cell = batch.column("id").to_numpy(), batch.column("cell").to_numpy()
            data = np.frombuffer(b"".join(batch.column("v").to_pylist()), "<f8").reshape(-1, width)
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for lo, hi in zip(edges, edges[1:]):
                if held and (block[lo] != at or size + hi - lo > ENTRY_BLOCK):
                    yield done()
                    held, size = [], 0
                if hi > lo:
                    at = int(block[lo])
                    held.append((ids[lo:hi], cell[lo:hi], data[lo:hi]))
                    size += hi - lo
        if held:
            yield done()

    placed = index.select("id", "cell", "v").mapInArrow(place, "block int, id long, cell long, v binary")
    parts = placed.repartition(blocks, "block").sortWithinPartitions("block", "cell", "id")
    parts = parts.mapInArrow(pack, "block int, ids binary, cells binary, data binary")
    ends = np.minimum((offset + sizes) * blocks / total, blocks - 1).astype(np.int64)
    begins = np.minimum(offset * blocks / total, blocks - 1).astype(np.int64)

    def probe(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            data = batch.column("v").to_pylist()
            for lo in range(0, len(ids), QUERY_BLOCK):
                some = b"".join(data[lo : lo + QUERY_BLOCK])
                q = _matrix(some, width)
                first, second = q[:, :half] @ books[0].T, (q[:, half:] if width > 1 else q * 0) @ books[1].T
                seen = np.zeros((len(q), cells), bool)
                for i in range(len(q)):
                    seen[i, walk(first[i], second[i], sizes, max(math.ceil(share * total), k + 1))] = True
                asked = ids[lo : lo + QUERY_BLOCK]
                # Only blocks with a cell that some query of the block has visited are met.
                visited = np.flatnonzero(seen.any(0) & (sizes > 0))
                met = sorted({b for c in visited.tolist() for b in range(begins[c], ends[c] + 1)})
                columns = [int(asked[0]), asked.tobytes(), some, np.packbits(seen, axis=1).tobytes(), met]
                kinds = (pa.int64(), *[pa.binary()] * 3, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, kinds)], ["asked", "qids", "qdata", "seen", "met"])

    # An id asks once; queries of one cell come together, so that a block of them visits much the same cells.
    single = index.filter("query").groupBy("id").agg(F.min(F.struct("v", "cell")).alias("q"))
    single = single.select("id", F.col("q.v").alias("v"), F.col("q.cell").alias("cell"))
    tasks = max(1, -(-total // ENTRY_BLOCK))
    single = single.repartitionByRange(tasks, "cell", "id").sortWithinPartitions("cell", "id").select("id", "v")
    probed = staged(single.mapInArrow(probe, "asked long, qids binary, qdata binary, seen binary, met array<int>"), "queries")
    probes = probed.select("asked", "qids", "qdata", "seen", F.explode("met").alias("block"))

    def score(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qids, q = np.frombuffer(r["qids"], "<i8"), _matrix(r["qdata"], width)
                seen = np.unpackbits(np.frombuffer(r["seen"], np.uint8).reshape(len(q), -1), axis=1, count=cells).astype(bool)
                cell = np.frombuffer(r["cells"], "<i8")
                mine = seen.any(0)[cell]  # entries of cells that no query of the block has visited are left out
                ids, v, cell = np.frombuffer(r["ids"], "<i8")[mine], _matrix(r["data"], width)[mine], cell[mine]
                if not len(ids):
                    continue
                s = np.where(seen[:, cell] & (qids[:, None] != ids), q @ v.T, -np.inf)
                keep = min(k, len(ids))
                edge = np.partition(s, len(ids) - keep, axis=1)[:, len(ids) - keep]
                found = []
                for i in range(len(q)):
                    near = np.flatnonzero((s[i] >= edge[i] - SLACK) & (s[i] > -np.inf))
                    exact = (v[near] * q[i]).sum(1)
                    best = near[o := np.lexsort((ids[near], -exact))[:k]]
                    part = np.zeros(len(best), HIT)
                    part["query"], part["id"], part["score"] = qids[i], ids[best], exact[o]
                    found.append(part)
                hits = pa.array([np.concatenate(found).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r["asked"]], pa.int64()), hits], ["asked", "hits"])

    def best(batches):
        """Running best of a block of queries over the blocks of entries; a task holds one block's."""
        held, at = None, None

        def done():
            lead = np.concatenate([[True], held["query"][1:] != held["query"][:-1]])
            starts = np.flatnonzero(lead)
            rank = np.arange(len(held)) - starts[np.cumsum(lead) - 1] + 1
            columns = [held["query"], rank.astype(np.int32), held["id"], held["score"]]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for asked, blob in zip(*(c.to_pylist() for c in batch.columns)):
                hits = np.frombuffer(blob, HIT)
                if held is not None and asked != at:
                    yield done()
                    held = None
                both = hits if held is None else np.concatenate([held, hits])
                both = both[np.lexsort((both["id"], -both["score"], both["query"]))]
                lead = np.concatenate([[True], both["query"][1:] != both["query"][:-1]]) if len(both) else np.zeros(0, bool)
                place = np.arange(len(both)) - np.flatnonzero(lead)[np.cumsum(lead) - 1]
                held, at = both[place < k], asked
        if held is not None:
            yield done()

    met = probes.join(parts, "block").select("asked", "qids", "qdata", "seen", "ids", "cells", "data")
    hits = met.mapInArrow(score, "asked long, hits binary")
    return hits.repartition("asked").sortWithinPartitions("asked").mapInArrow(best, kind)
