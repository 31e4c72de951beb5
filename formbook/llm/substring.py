"""Repeated word windows found through difference-cover anchors.

Anchors are hashes of ``h`` words, taken only where the word position modulo ``PERIOD`` lies in ``COVER``. For any two
positions some common shift below ``PERIOD`` brings both onto the cover, so two equal windows of
``PERIOD + h - 1`` words share an aligned anchor. Anchors seen twice are extended to the windows around
them, and of equal windows all but the earliest are marked.

Hashes travel packed: each task sends, per bucket of the hash space, one entry for every different hash it has met. Further
occurrences are decided where they are, so a hash found everywhere costs one entry per task.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from formbook.llm.common import staged
from formbook.llm.scan import as_bytes, rolling, slices, span_hashes, word_spans

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)  # every residue is a difference of two cover members
BUCKET_BYTES = 16 << 20  # text per bucket of the hash space
FLUSH = 1 << 20  # entries held before they are sent
ROWS = 100_000  # positions in an output batch

KEY = ["late", "id", "t1"]  # document order: null ids last, then id, then text hash
_doc = np.dtype([("late", "i1"), ("id", "i8"), ("t1", "i8")])
_entry = np.dtype([("h1", "u8"), ("h2", "u8"), ("doc", "i4"), ("pos", "i4"), ("n", "i1")])
PLACES = "late byte, id long, t1 long, at int"


def _places(docs: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per position; their number does not depend on that of the buckets."""
    for lo in range(0, len(doc), ROWS):
        head = docs[doc[lo : lo + ROWS]]
        columns = [pa.array(np.ascontiguousarray(head[k])) for k in KEY]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(pos[lo : lo + ROWS].astype(np.int32))], [*KEY, "at"])


def _ranked(docs: np.ndarray) -> np.ndarray:
    """Rank of each document in document order; equal keys have equal ranks."""
    return np.unique(docs, return_inverse=True)[1]


def _pack(docs: np.ndarray, entries: np.ndarray) -> bytes:
    used, entries["doc"] = np.unique(entries["doc"], return_inverse=True)
    return np.int64(len(used)).tobytes() + docs[used].tobytes() + entries.tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    return np.frombuffer(blob, _doc, n, 8), np.frombuffer(blob, _entry, offset=8 + n * _doc.itemsize)


def _first_of(entries: np.ndarray) -> np.ndarray:
    same = (entries["h1"][1:] == entries["h1"][:-1]) & (entries["h2"][1:] == entries["h2"][:-1])
    return np.concatenate([[True], ~same])


def _send(docs: np.ndarray, entries: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blobs for the buckets: the earliest entry of each hash; and for a spare bucket the later ones."""
    rank = _ranked(docs)[entries["doc"]]
    order = np.lexsort((entries["pos"], rank, entries["h2"], entries["h1"]))
    entries, rank = entries[order], rank[order]
    first = _first_of(entries)
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = (rank > rank[head]) | (entries["pos"] > entries["pos"][head])
    sent = entries[first]
    sent["n"] = np.minimum(2, np.diff(np.flatnonzero(first), append=len(entries)))
    bucket = ((sent["h1"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    sent, bucket = sent[order], bucket[order]
    at = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
    rows = [(int(bucket[a]), _pack(docs, sent[a:b].copy())) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    if later.any():
        known = entries[later]
        rows.append((buckets + int(known["h1"][0] >> np.uint64(40)) % buckets, _pack(docs, known)))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "blob"])


def _gather(batches, rows_of: Callable, buckets: int) -> Iterator[pa.RecordBatch]:
    """Collect the entries of a task and send them in bounded portions.

    ``rows_of`` gives the document keys of a batch and, per document, ``h1, h2, pos``.
    """
    keys, parts, held = [], [], 0
    for batch in slices(batches):
        for key, found in rows_of(batch):
            if found is None or not len(found[0]):
                continue
            part = np.zeros(len(found[0]), _entry)
            part["h1"], part["h2"], part["pos"] = found
            part["doc"] = len(keys)
            keys.append(key)
            parts.append(part)
            held += len(part)
            if held >= FLUSH:
                yield from _send(np.array(keys, _doc), np.concatenate(parts), buckets)
                keys, parts, held = [], [], 0
    if held:
        yield from _send(np.array(keys, _doc), np.concatenate(parts), buckets)


def _settle(blobs: list[bytes], known: bool, earliest: bool) -> Iterator[pa.RecordBatch]:
    """Decide the entries of one bucket; known ones are passed on."""
    docs, entries, base = [], [], 0
    for blob in blobs:
        d, e = _unpack(blob)
        e = e.copy()
        e["doc"] += base
        base += len(d)
        docs.append(d)
        entries.append(e)
    docs, entries = np.concatenate(docs), np.concatenate(entries)
    if not known:
        rank = _ranked(docs)[entries["doc"]]
        order = np.lexsort((entries["pos"], rank, entries["h2"], entries["h1"]))
        entries, rank = entries[order], rank[order]
        first = _first_of(entries)
        group = np.cumsum(first) - 1
        if earliest:
            head = np.flatnonzero(first)[group]
            chosen = (rank > rank[head]) | (entries["pos"] > entries["pos"][head])
        else:
            chosen = np.bincount(group, entries["n"])[group] > 1
        entries = entries[chosen]
    yield from _places(docs, entries["doc"], entries["pos"])


def _resolve(blobs: DataFrame, buckets: int, earliest: bool) -> DataFrame:
    def settle(batches):
        bucket, held = None, []
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (b != bucket or b >= buckets):  # known entries need no company
                    yield from _settle(held, bucket >= buckets, earliest)
                    held = []
                bucket = b
                held.append(blob)
        if held:
            yield from _settle(held, bucket >= buckets, earliest)

    dealt = blobs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(settle, PLACES)
    return found.groupBy(*KEY).agg(F.collect_list("at").alias("at"))


def _positions(at: list[int] | None) -> np.ndarray:
    return np.unique(np.array(at or (), np.int64))


def _hashes(text: bytes, lane: int = 0) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return span_hashes(data, *word_spans(data), lane)


def remove_repeated_windows(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """One row per document: ``id, n_words, n_removed, kept``, words of windows seen earlier cut out.

    A word goes if a window of ``window`` words over it starts earlier as well: in a document with a smaller integer id,
    or further left in the same one. Null ids come last; equal ids go by text hash; rows equal in
    id and text are one document and get equal results. ``kept`` has the words left, joined by one space. Null text
    has no words. Other columns are ignored.
    """
    size = window - PERIOD + 1
    if size < 1:
        raise ValueError(f"a window needs {PERIOD} words or more")
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    frame = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    frame = frame.select(
        F.col("id").isNull().cast("byte").alias("late"),
        F.coalesce("id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("t1"),
        "text",
    )
    total = frame.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(16, -(-total // bucket_bytes))

    def keys(batch):
        return zip(*(batch.column(k).to_pylist() for k in KEY))

    def anchors(batch):
        for key, data in zip(keys(batch), as_bytes(batch.column("text"))):
            h = rolling(_hashes(data.as_py()), size)
            pos = np.flatnonzero(cover[np.arange(len(h)) % PERIOD])
            yield key, (h[pos], 0, pos)

    found = frame.mapInArrow(lambda it: _gather(it, anchors, buckets), "bucket int, blob binary")
    repeated = staged(_resolve(found, buckets, earliest=False), "anchors")

    def windows(batch):
        places = batch.column("at").to_pylist()
        for key, data, at in zip(keys(batch), as_bytes(batch.column("text")), places):
            lanes = [rolling(_hashes(data.as_py(), lane), window, lane) for lane in (0, 1)]
            start = np.unique((_positions(at)[:, None] - np.arange(PERIOD)).ravel())
            start = start[(start >= 0) & (start < len(lanes[0]))]
            yield key, (lanes[0][start], lanes[1][start], start)

    # One shuffle of the texts serves both joins: the exchange is reused.
    near = frame.join(repeated, KEY).select(*KEY, "text", "at")
    extended = near.mapInArrow(lambda it: _gather(it, windows, buckets), "bucket int, blob binary")
    later = _resolve(extended, buckets, earliest=True)

    def apply(batches):
        for batch in slices(batches):
            out = ([], [], [])
            for data, at in zip(as_bytes(batch.column("text")).to_pylist(), batch.column("at").to_pylist()):
                words = data.split()
                gone = np.zeros(len(words) + 1, np.int32)
                start = _positions(at)
                gone[start] += 1
                np.subtract.at(gone, start + window, 1)
                keep = (np.cumsum(gone[:-1]) == 0).tolist()
                kept = [w for w, k in zip(words, keep) if k]
                for column, value in zip(out, (len(words), len(words) - len(kept), b" ".join(kept).decode())):
                    column.append(value)
            ids = pa.compute.if_else(pa.compute.equal(batch.column("late"), 0), batch.column("id"), pa.scalar(None, pa.int64()))
            new = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([ids, *new], ["id", "n_words", "n_removed", "kept"])

    joined = frame.join(later, KEY, "left").select("late", "id", "text", "at")
    return joined.mapInArrow(apply, "id long, n_words long, n_removed long, kept string")
