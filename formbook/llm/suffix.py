"""Repeated byte strings by enhanced suffix arrays over candidate groups.

A repeat of ``length`` bytes or more may start anywhere, so the corpus is first cut into
segments: runs of window starts whose windows share the smallest hash of their
``GRAM``-byte pieces. Equal windows have the same smallest hash, hence only segments
with an equal hash are compared, and hashes seen once are dropped. Each group
of segments goes through a suffix array, its common prefixes and a stack scan of the
prefix intervals. An interval whose occurrences have different bytes on their left
is a maximal repeat and yields all its occurrences. Groups beyond ``group_bytes``
are resolved window by window through 128-bit digests instead, in a grouping that
combines before the shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from formbook.llm.common import other_columns, quoted, row_columns, row_of, schema_after, staged
from formbook.llm.scan import as_bytes, byte_values, rolling, slices, sliding_min

LENGTH = 200
GRAM = 40
SLICE = 1 << 20  # window starts hashed at once
BATCH_BYTES = 512 << 10  # one suffix array
GROUP_BYTES = 2 << 20  # segments of one hash; above, windows are compared by digest
ROWS = 20_000  # rows in an output batch
PLACE_BITS = 21  # of a place for the number of windows, at most SLICE; the rest is the first window's start


def segments(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest hash, first window start and number of windows of every segment."""
    found = []
    values = np.frombuffer(data, np.uint8)
    for lo in range(0, len(values) - length + 1, SLICE):
        part = byte_values(values[lo : lo + SLICE + length - 1])
        least = sliding_min(rolling(part, gram), length - gram + 1)
        at = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        found.append((least[at].view(np.int64), at + lo, np.diff(at, append=len(least))))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def selected(data: bytes, length: int, gram: int) -> np.ndarray:
    """Hash at every position that is the smallest of some window.

    A hash that occurs once in the corpus belongs to windows that occur once.
    """
    found = [np.zeros(0, np.uint64)]
    values, reach = np.frombuffer(data, np.uint8), length - gram + 1
    for lo in range(0, len(values) - length + 1, SLICE):
        hashes = rolling(byte_values(values[lo : lo + SLICE + length - 1]), gram)
        pad = np.zeros(reach - 1, np.uint64)
        most = ~sliding_min(~np.concatenate([pad, sliding_min(hashes, reach), pad]), reach)
        found.append(hashes[hashes == most])
    return np.concatenate(found).view(np.int64)


def suffix_array(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Order of all suffixes by their first ``depth`` symbols at least, and the ranks by prefix length.

    A rank is the first place of those equal. Prefixes double; only suffixes that are still equal to another are
    sorted again, within their places.
    """
    n = len(symbols)
    levels = [(1, symbols.astype(np.int32))]
    bits = int(symbols.max() + 1).bit_length()
    reach = next(p for p in (4, 2, 1) if p * bits < 63)
    padded = np.zeros(n + reach, np.int64)
    padded[:n] = symbols + 1
    key = np.zeros(n, np.int64)
    for k in range(reach):  # the first symbols as one number
        key = key << bits | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    ranked, slots = key[order], np.arange(n)
    lead, rank = np.ones(n, bool), np.empty(n, np.int32)
    while True:
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        lead[slots] = fresh
        rank[order[slots]] = np.maximum.accumulate(np.where(fresh, slots, 0))
        slots = np.flatnonzero(~(lead & np.append(lead[1:], True)))
        if not len(slots) or reach > depth:
            return order, levels
        if reach > levels[-1][0]:
            levels.append((reach, rank.copy()))
        same = order[slots]
        after = np.minimum(same + reach, n - 1)
        key = rank[same].astype(np.int64) * (n + 1) + np.where(same + reach < n, rank[after] + 1, 0)
        sort = np.argsort(key, kind="stable")
        order[slots], ranked = same[sort], key[sort]
        reach *= 2


def common_prefixes(order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the one before it; 0 for the first."""
    a, b, n = order[:-1].copy(), order[1:].copy(), len(levels[0][1])
    got, longer = np.zeros(len(a), np.int64), None
    for reach, rank in reversed(levels):
        left = longer // reach - 1 if longer else n  # as often as the next longer prefix can hide this one
        while left:
            inside = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[inside] = rank[a[inside]] == rank[b[inside]]
            if not same.any():
                break
            got[same] += reach
            a[same] += reach
            b[same] += reach
            left -= 1
        longer = reach
    return np.concatenate([[0], got])


def maximal_repeats(texts: list[bytes], length: int) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """The suffix array, and length and range in it of every maximal repeat of ``length`` bytes or more.

    The range holds all occurrences: positions in the texts joined with one separator each. Inner ranges come
    before outer ones. Repeats do not cross texts. The start of a text counts as different from every left byte.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32) + len(texts)
    joined[ends] = np.arange(len(texts))  # separators differ, so no common prefix crosses them
    order, levels = suffix_array(joined, int(sizes.max()))
    left = np.where(order > 0, joined[order - 1], -1)
    return order, _intervals(common_prefixes(order, levels), left, length)


def _intervals(prefix: np.ndarray, left: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of the common prefixes for intervals with different bytes on the left."""
    inside = prefix >= length
    # Runs of suffixes sharing ``length`` bytes; only those with different left bytes hold maximal repeats.
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    firsts, lasts = np.flatnonzero(edge == 1) - 1, np.flatnonzero(edge == -1) - 1
    differs = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        if differs[last] == differs[first]:
            continue
        if last == first + 1:
            yield int(prefix[last]), first, last + 1
            continue
        stack: list[tuple[int, int]] = []  # common prefix, first suffix of each open interval
        for i, shared in enumerate([*prefix[first + 1 : last + 1].tolist(), 0], first + 1):
            start = i - 1
            while stack and stack[-1][0] > shared:
                depth, start = stack.pop()
                if differs[i - 1] != differs[start]:
                    yield depth, start, i
            if shared and (not stack or stack[-1][0] < shared):
                stack.append((shared, start))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as disjoint, not touching, ascending ranges."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]


def _covered(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Ranges of each text that lie in a repeat."""
    order, repeats = maximal_repeats(texts, length)
    reach = np.zeros(len(order), np.int64)  # longest repeat at each place of the suffix array
    done: list[tuple[int, int]] = []  # disjoint ranges that inner repeats have filled
    for size, lo, hi in repeats:
        end = hi
        while done and done[-1][0] >= lo:
            a, b = done.pop()
            reach[b:end] = size
            end = a
        reach[lo:end] = size
        done.append((lo, hi))
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if done:
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        starts, ends = merged(at := order[reach > 0], at + reach[reach > 0])
        owner = np.searchsorted(begin, starts, "right") - 1
        for i, s, e in zip(owner.tolist(), (starts - begin[owner]).tolist(), (ends - begin[owner]).tolist()):
            out[i].append((s, e))
    return out


def _digest(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


RANGES = "array<struct<a:long,b:long>>"
_ranges = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _pairs(ranges: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"a": a, "b": b} for a, b in x] for x in ranges], _ranges)


def repeated_ranges(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``t1, pieces``: pieces of the texts (``t1, text`` among the columns) with their ranges that lie in repeats.

    Every row counts, so equal texts are repeats of each other. ``pieces`` (``place, d, ranges``) overlap, and their ranges
    start at the piece. Texts meet on ``t1``, their xxhash64; of texts that share it by chance, ``d`` tells which one a
    piece belongs to.
    """

    def hashes(batches):
        for batch in slices(batches):
            for text in as_bytes(batch.column(0)):
                least = selected(text.as_py(), length, gram)
                if len(least):
                    yield pa.RecordBatch.from_arrays([pa.array(least)], ["m"])

    def locate(batches):
        for batch in slices(batches):
            held, n = [], 0
            for t1, text in zip(batch.column(0).to_numpy(), as_bytes(batch.column(1)).to_pylist()):
                least, at, windows = segments(text, length, gram)
                ends = (at + windows + length - 1).tolist()
                d = np.array([_digest(text[a:b]) for a, b in zip(at.tolist(), ends)], np.int64)
                held.append((least, d, np.full(len(at), t1), at << PLACE_BITS | windows))
                n += len(at)
                if n >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], AT)
                    held, n = [], 0
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], AT)

    AT = ["m", "d", "t1", "place"]
    again = texts.select("text").mapInArrow(hashes, "m long").groupBy("m").agg(F.count(F.lit(1)).alias("c"))
    located = texts.select("t1", "text").mapInArrow(locate, "m long, d long, t1 long, place long")
    # Equal pieces have the same ``m`` and the same digest ``d``.
    # Copies of a text have the same places: one row each, with the number of copies.
    places = located.join(again.filter("c > 1").select("m"), "m", "left_semi")
    places = staged(places.groupBy("m", "d", "t1", "place").agg(F.count(F.lit(1)).alias("n")), "places")
    key, found = ["m", "d"], f"m long, d long, ranges {RANGES}"
    size = (F.expr(f"place & {(1 << PLACE_BITS) - 1}L") + length - 1).alias("size")
    owner = F.min(F.struct("t1", "place", size)).alias("owner")
    distinct = places.groupBy(*key).agg(F.sum("n").alias("c"), owner).repartition("m")
    groups = distinct.groupBy("m").agg(F.count(F.lit(1)).alias("k"), F.sum("owner.size").alias("bytes"))
    distinct = staged(distinct.join(groups, "m"), "distinct")

    # A piece seen twice repeats as a whole; it is compared with others only where there are others.
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("owner.size").alias("b")))
    twice = distinct.filter("c > 1").select(*key, whole.alias("ranges"))
    crowded = (F.col("bytes") > group_bytes).alias("crowded")
    asked = distinct.filter("k > 1 or c = 1").groupBy("owner.t1").agg(
        F.collect_list(F.struct("owner.place", "owner.size", *key, "c", crowded)).alias("asked")
    )

    def fetch(batches):
        """Bytes of one piece of each kind."""
        last = None
        for batch in slices(batches):
            rows, size = tuple([] for _ in PIECE), 0
            for t1, text, want in zip(*(batch.column(c).to_pylist() for c in ("t1", "text", "asked"))):
                if (t1, len(text)) == last:  # equal texts come together after the join, mostly
                    continue
                last, text = (t1, len(text)), text.encode()
                for x in want:
                    at = x["place"] >> PLACE_BITS
                    piece = text[at : at + x["size"]]
                    if _digest(piece) != x["d"]:  # another text with this ``t1``
                        continue
                    for column, value in zip(rows, (x["m"], x["d"], piece, x["c"], x["crowded"])):
                        column.append(value)
                    size += len(piece)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, rows)), PIECE)
                    rows, size = tuple([] for _ in PIECE), 0
            if size:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, rows)), PIECE)

    PIECE = ["m", "d", "piece", "c", "crowded"]
    kinds = "m long, d long, piece binary, c long, crowded boolean"
    # All columns go along, so that this shuffle of the texts is the one the caller's join reads, too.
    # Should rows of equal text bring a piece twice, one is kept after the shuffle by group.
    pieces = texts.join(asked, "t1").mapInArrow(fetch, kinds)
    usual = pieces.filter("not crowded").repartition("m").sortWithinPartitions(*key)

    def scan(batches):
        held: list[tuple] = []
        size = 0  # bytes

        def done(rows):
            ranges = _covered([r[2] for r in rows], length)
            keep = [i for i, r in enumerate(rows) if ranges[i] and r[3] == 1]
            columns = [pa.array([rows[i][c] for i in keep], pa.int64()) for c in range(2)]
            return pa.RecordBatch.from_arrays([*columns, _pairs([ranges[i] for i in keep])], [*key, "ranges"])

        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:2] == held[-1][:2]:
                    continue
                if size > BATCH_BYTES and row[0] != held[-1][0]:
                    yield done(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield done(held)

    compared = usual.mapInArrow(scan, found)

    def windows(batches):
        for batch in slices(batches):
            for m, d, piece in zip(*(c.to_pylist() for c in batch.columns)):
                for lo in range(0, len(piece) - length + 1, ROWS):
                    part = np.frombuffer(piece, np.uint8)[lo : lo + ROWS + length - 1]
                    w = [rolling(byte_values(part, i), length, i).view(np.int64) for i in (0, 1)]
                    n = len(w[0])
                    same = [pa.array(np.full(n, x)) for x in (m, d)]
                    at = pa.array(np.arange(lo, lo + n))
                    yield pa.RecordBatch.from_arrays([*same, pa.array(w[0]), pa.array(w[1]), at], [*key, "w1", "w2", "at"])

    opened = staged(
        pieces.filter("crowded").select(*key, "piece").mapInArrow(windows, "m long, d long, w1 long, w2 long, at long").distinct(),
        "windows",
    )
    # A window found everywhere is one row of ``seen``; both sides are read from files, so the join may split its key.
    seen = staged(opened.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("w1", "w2"), "seen")
    starts = opened.join(seen, ["w1", "w2"], "left_semi").groupBy(*key).agg(F.collect_list("at").alias("starts"))

    def runs(batches):
        """Windows that touch, as one range."""
        for batch in slices(batches):
            out = []
            for at in batch.column("starts").to_pylist():
                at = np.array(at, np.int64)
                out.append(list(zip(*(x.tolist() for x in merged(at, at + length)))))
            yield pa.RecordBatch.from_arrays([batch.column("m"), batch.column("d"), _pairs(out)], [*key, "ranges"])

    packed = starts.mapInArrow(runs, found)

    verdict = twice.unionByName(compared).unionByName(packed)
    placed = places.select(*key, "t1", "place").join(verdict, key)
    # Ranges stay those of their piece, one array for each piece of a text.
    return placed.groupBy("t1").agg(F.collect_list(F.struct("place", "d", "ranges")).alias("pieces"))


def _own(text: bytes, pieces: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The ranges that belong to ``text``, told by the digests of their pieces."""
    out = []
    for p in pieces or ():
        at, n = p["place"] >> PLACE_BITS, p["place"] & (1 << PLACE_BITS) - 1
        if _digest(text[at : at + n + length - 1]) == p["d"]:
            out += [(at + r["a"], at + r["b"]) for r in p["ranges"]]
    return out


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group_bytes: int = GROUP_BYTES,
    as_text: bool = False,
) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept``: bytes in repeats of ``length`` or more cut out.

    ``kept`` replaces the text column. It is binary, since a cut may fall inside a character; with
    ``as_text`` it is a string without the halves of cut characters. Null text counts as empty. Other columns stay;
    those with the names added here, in any case, are replaced. Rows of equal text repeat each other.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    rest = other_columns(docs, [text, *added])
    packed = docs.select(row_of(rest).alias("row"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    packed = packed.select("row", "text", F.xxhash64("text").alias("t1"))
    ranges = repeated_ranges(packed, length, gram, group_bytes)

    def apply(batches):
        for batch in slices(batches):
            out = ([], [], [], [])
            for data, spans in zip(as_bytes(batch.column("text")).to_pylist(), batch.column("pieces").to_pylist()):
                flat = np.array(_own(data, spans, length), np.int64).reshape(-1, 2)
                starts, ends = merged(flat[:, 0], flat[:, 1])
                edges = [0, *np.column_stack([starts, ends]).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                row = (len(data), int((ends - starts).sum()), len(starts))
                for column, value in zip(out, (*row, kept.decode("utf-8", "ignore") if as_text else kept)):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string() if as_text else pa.binary())
            new = [pa.array(x, t) for x, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *new], ["row", *added])

    joined = packed.join(ranges, "t1", "left").select("row", "text", "pieces")
    last = "string" if as_text else "binary"
    done = joined.mapInArrow(apply, schema_after(packed, ["row"], f"n_bytes long, n_removed long, n_spans long, kept {last}"))
    return done.select(*row_columns(rest, "row"), *added)
