"""Byte-level BPE with word ends, through an automaton of frequent words.

The corpus's frequent words are compiled, with the token ids they encode to, into a minimal acyclic transducer: words
share prefixes and suffixes, and the number of words passed on the way to a final state is the
index of the word's output. Tasks memory-map it; words outside are merged pair by pair.
"""

import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from formbook.llm.common import is_frequent, other_columns, quoted, row_columns, row_of, schema_after, staged
from formbook.llm.scan import as_bytes, groups_of, slices

LEXICON_WORDS = 200_000
LEXICON_BYTES = 1 << 25  # of its words in all
LEXICON_LENGTH = 4096  # bytes of one of them
COUNTED = 200_000  # different chunks a task counts before it passes their words on
MEMO = 400_000  # different chunks and words a task remembers
MEMO_CHARS = 20_000_000  # and their characters in all
LONG_WORD = 64  # bytes; longer words are merged with a heap
BLOCK = 4096  # words merged side by side
NO_ID = (1 << 31) - 1

_ODD_SPACE = re.compile("[\x1c-\x1f]").search  # space to ``str.split``, not to the tokenizer
_UNSPACED = regex.compile(r"\S+").findall
_MARKS = ".,;:!?"  # each a word of its own after letters
_LOWER_ALONE = "Σ"  # the only letter whose lower case depends on its neighbours


def _byte_chars() -> list[str]:
    """Printable stand-in of every byte, as byte-level vocabularies write them."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


BYTE_CHARS = _byte_chars()


@dataclass
class Tokenizer:
    """The pieces of a tokenizer file: pattern, special tokens, vocabulary and merges."""

    path: str

    def __post_init__(self):
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._find = regex.compile(pattern).findall
        ascii_pattern = pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        self._find_ascii = re.compile(ascii_pattern, re.ASCII).findall  # the same on ASCII text, and faster
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.inner = [vocab[c] for c in BYTE_CHARS]
        self.last = [vocab[c + self.end] for c in BYTE_CHARS]
        self.ranks, self.merged = {}, []
        for a, b in model["merges"]:
            self.ranks.setdefault(vocab[a] << 32 | vocab[b], len(self.merged))
            self.merged.append(vocab[a + b])
        self._pairs = np.array(sorted(self.ranks), np.int64)
        self._pair_ranks = np.array([self.ranks[p] for p in self._pairs.tolist()], np.int64)
        self._assigned: set[str] = set()
        self._exact = None

    def chunks(self, text: str) -> list[str | bytes]:
        """Runs without white space of a text without special tokens, normalised; no word reaches over white space."""
        if not text.isascii():
            fresh = set(text) - self._assigned
            if fresh:
                # Libraries differ on code points that this Python's Unicode does not know.
                if any(unicodedata.category(c) == "Cn" for c in fresh):
                    return self._library_words(text)
                self._assigned |= fresh
            text = unicodedata.normalize("NFC", text)
            if _LOWER_ALONE in text:
                text = "".join(c.lower() for c in text)
        text = text.lower()
        return _UNSPACED(text) if _ODD_SPACE(text) else text.split()

    def words(self, chunk: str | bytes) -> list[str | bytes]:
        """Words of a chunk; bytes are a word already. A word split again is that word alone."""
        if isinstance(chunk, bytes) or chunk.isalpha():  # letters are one word
            return [chunk]
        if chunk[-1] in _MARKS and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self._find_ascii(chunk) if chunk.isascii() else self._find(chunk)

    def _library_words(self, text: str) -> list[bytes]:
        """Words by the tokenizers library, whose Unicode tables decide on unknown code points."""
        if self._exact is None:
            import tokenizers

            self._exact = tokenizers.Tokenizer.from_file(self.path)
            self._back = {c: b for b, c in enumerate(BYTE_CHARS)}
        found = self._exact.pre_tokenizer.pre_tokenize_str(self._exact.normalizer.normalize_str(text))
        return [bytes(self._back[c] for c in piece) for piece, _ in found]

    def parts(self, text: str) -> Iterable[tuple[str | None, list[str | bytes]]]:
        """Special tokens (with no chunks) and the chunks between them, in order."""
        for i, part in enumerate(self.cut(text)):
            yield (part, []) if i % 2 else (None, self.chunks(part))

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word: the pair merged earliest in training goes first, leftmost first."""
        ids = [*(self.inner[b] for b in word[:-1]), self.last[word[-1]]]
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        rank, none = self.ranks.get, len(self.merged)
        ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i : i + 2] = [self.merged[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | ids[i], none)
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 32 | ids[i + 1], none)
        return ids

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; the number of merges where a pair has none."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        return np.where(self._pairs[at] == pair, self._pair_ranks[at], len(self.merged))

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` for many words."""
        return [np.frombuffer(ids, np.int32).tolist() for ids in self.merge_packed(words)]

    def merge_packed(self, words: list[bytes]) -> list[bytes]:
        """``merge`` for many words, ids as 32-bit integers: each round merges one pair in every word of a block."""
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        while order and len(words[order[-1]]) > LONG_WORD:
            k = order.pop()
            out[k] = array("i", self.merge(words[k])).tobytes()
        for lo in range(0, len(order), BLOCK):
            self._merge_block(words, order[lo : lo + BLOCK], out)
        return out

    def _merge_block(self, words: list[bytes], block: list[int], out: list[bytes]) -> None:
        width = len(words[block[-1]])
        data = np.frombuffer(b"".join([words[k].ljust(width, b"\0") for k in block]), np.uint8).reshape(-1, width)
        size, col = np.array([len(words[k]) for k in block]), np.arange(width)
        ids = np.where(col < size[:, None] - 1, np.array(self.inner)[data], np.array(self.last)[data])
        ids[col >= size[:, None]] = NO_ID
        ranks, which, merged = self._rank(ids[:, :-1], ids[:, 1:]), np.array(block), np.array(self.merged)
        while len(which):
            row = np.arange(len(which))
            if ids.shape[1] > 1:
                best = ranks.argmin(1)  # the leftmost of equals
                rank = ranks[row, best]
                more = rank < len(merged)
            else:
                more = np.zeros(len(which), bool)
            done = ids[~more]
            flat, at = done.astype(np.int32).tobytes(), range(0, 4 * done.size, 4 * ids.shape[1])
            for k, lo, n in zip(which[~more].tolist(), at, (4 * (done != NO_ID).sum(1)).tolist()):
                out[k] = flat[lo : lo + n]
            if not more.any():
                return
            ids, ranks, which, best, rank = ids[more], ranks[more], which[more], best[more], rank[more]
            row, col, at = np.arange(len(which)), col[:-1], best[:, None]
            ids[row, best] = merged[rank]
            ids = np.take_along_axis(ids, col + (col > at), 1)
            ranks = np.take_along_axis(ranks, col[:-1] + (col[:-1] >= at), 1)
            for there, left in ((best > 0, best - 1), (best < len(col) - 1, best)):
                r, c = row[there], left[there]
                ranks[r, c] = self._rank(ids[r, c], ids[r, c + 1])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for words of any length."""
        n, rank = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != left or ids[j] != right:
                continue  # one side has been merged meanwhile
            ids[i], ids[j], after[i] = self.merged[best], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n and (r := rank(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]


@lru_cache(maxsize=2)
def tokenizer_of(path: str) -> Tokenizer:
    """One per file and Python worker."""
    return Tokenizer(path)


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic transducer of ``words`` as one block of bytes."""
    states: list[tuple[bool, tuple]] = []  # final, ((label, state), ...)
    register: dict[tuple, int] = {}
    open_: list[list] = [[False, []]]  # states along the previous word

    def close(down_to: int, previous: bytes) -> None:
        while len(open_) > down_to + 1:
            final, edges = open_.pop()
            key = (final, tuple(edges))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            open_[-1][1].append((previous[len(open_) - 1], register[key]))

    previous, order = b"", sorted(words)
    for word in order:
        shared = 0
        while shared < min(len(word), len(previous)) and word[shared] == previous[shared]:
            shared += 1
        close(shared, previous)
        open_.extend([False, []] for _ in word[shared:])
        open_[-1][0] = True
        previous = word
    close(0, previous)
    states.append((open_[0][0], tuple(open_[0][1])))
    count = [0] * len(states)  # words that end in or below a state; targets come before
    edges_of, targets, passed = array("q"), array("i"), array("i")  # by state and label
    for i, (final, edges) in enumerate(states):
        count[i] = int(final)
        for label, target in edges:
            edges_of.append(i << 8 | label)
            targets.append(target)
            passed.append(count[i])
            count[i] += count[target]
    finals = bytes(final for final, _ in states)
    starts = array("i", [0])
    ids = array("i")
    for word in order:
        ids.extend(words[word])
        starts.append(len(ids))
    blocks = [edges_of.tobytes(), targets.tobytes(), passed.tobytes(), starts.tobytes(), ids.tobytes(), finals]
    return struct.pack("<6q", *map(len, blocks)) + b"".join(blocks)


class Lexicon:
    """A compiled lexicon, read through a memory map of a local temporary file."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        at, blocks, kinds = 48, [], (np.int64, np.int32, np.int32, np.int32, np.int32, np.bool_)
        for kind, n in zip(kinds, struct.unpack("<6q", self._map[:48])):
            blocks.append((at, np.frombuffer(self._map, kind, n // np.dtype(kind).itemsize, at)))
            at += n
        (_, self._edges), (_, self._targets), (_, self._passed), (_, self._starts), (self._first, _), (_, self._finals) = blocks

    def ids(self, words: list[bytes]) -> list[list[int] | None]:
        """Token ids of each word; None if it is not in the lexicon."""
        return [ids if ids is None else np.frombuffer(ids, np.int32).tolist() for ids in self.packed(words)]

    def packed(self, words: list[bytes]) -> list[bytes | None]:
        """The same as 32-bit integers. All words walk the automaton together."""
        data, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64)
        at = np.cumsum(size) - size
        state, index = np.full(len(words), len(self._finals) - 1), np.zeros(len(words), np.int64)
        on, i = np.flatnonzero(size), 0
        while len(on) and len(self._edges):
            key = state[on] << 8 | data[at[on] + i]
            edge = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
            there = self._edges[edge] == key
            state[on[~there]] = -1
            on, edge = on[there], edge[there]
            index[on] += self._passed[edge]
            state[on] = self._targets[edge]
            i += 1
            on = on[size[on] > i]
        state[on] = -1  # words with letters, and a lexicon without
        out: list[bytes | None] = [None] * len(words)
        found = np.flatnonzero((state >= 0) & self._finals[state])
        starts, ends = (self._first + 4 * self._starts[index[found] + i] for i in (0, 1))
        for k, lo, hi in zip(found.tolist(), starts.tolist(), ends.tolist()):
            out[k] = self._map[lo:hi]
        return out


def frequent_words(docs: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """At most ``most`` words, the most frequent of all texts, counted over the whole corpus.

    Words as frequent as a word left out may be left out as well: whole bins of frequency are taken.
    """

    def count(batches):
        tokenizer, counter = tokenizer_of(path), Counter()

        def out():
            words = Counter()
            for chunk, n in counter.items():
                for word in tokenizer.words(chunk):
                    words[word] += n
            names = pa.array([w if isinstance(w, str) else w.decode() for w in words], pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches):
            for body in batch.column(0).to_pylist():
                for _, chunks in tokenizer.parts(body or ""):
                    counter.update(chunks)
                if len(counter) > COUNTED:
                    yield out()
                    counter.clear()
        if counter:
            yield out()

    counts = docs.select(F.col(text).cast("string")).mapInArrow(count, "word string, n long")
    words = staged(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = words.filter(is_frequent(words, "word", most, LEXICON_BYTES, LEXICON_LENGTH))
    return [r["word"] for r in top.select("word").orderBy("word").collect()]  # within the bounds above


def lexicon(docs: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> bytes:
    tokenizer = tokenizer_of(path)
    words = [w.encode() for w in frequent_words(docs, path, text, most)]
    return compile_lexicon(dict(zip(words, tokenizer.merge_all(words))))


def short_batches(batches) -> Iterable[pa.RecordBatch]:
    """The batches in slices of about a megabyte of ``_text``; a longer text comes alone."""
    for batch in batches:
        sizes = as_bytes(batch.column("_text"))
        for lo, hi in groups_of(pc.binary_length(sizes).to_numpy(zero_copy_only=False)):
            yield batch.slice(lo, hi - lo)


def encoded(docs: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``decoded``, the tokens joined by a space.

    Special tokens in a text become their ids. Null text counts as empty. ``path`` is a tokenizer file that every executor reads.
    Columns of the names added here, in any case, are replaced.
    """
    added = ["n_tokens", "ids", "decoded"]
    rest = other_columns(docs, added)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, path, text, most))  # ``most`` words

    def encode(batches):
        tokenizer, words = tokenizer_of(path), Lexicon(shared.value)
        names = pa.array([tokenizer.tokens.get(i, "") for i in range(max(tokenizer.tokens) + 1)], pa.string())
        special = {mark: array("i", [i]).tobytes() for mark, i in tokenizer.special.items()}
        code: dict[str | bytes, bytes] = {}  # ids, as 32-bit integers, of the chunks and words met so far
        held = 0

        def learn(chunks):
            """Adds chunks and their words to the memo; returns the characters added."""
            parts = {c: ws for c in chunks if len(ws := tokenizer.words(c)) != 1 or ws[0] != c}
            fresh = chunks.difference(parts).union(*parts.values()).difference(code)
            order = list(fresh)
            data = [w if isinstance(w, bytes) else w.encode() for w in order]
            ids = words.packed(data)
            rest = [k for k, found in enumerate(ids) if found is None]
            for k, found in zip(rest, tokenizer.merge_packed([data[k] for k in rest])):
                ids[k] = found
            code.update(zip(order, ids))
            for c, ws in parts.items():
                code[c] = b"".join([code[w] for w in ws])
            return sum(map(len, order)) + sum(map(len, parts))

        for batch in short_batches(batches):
            split = [list(tokenizer.parts(body or "")) for body in batch.column("_text").to_pylist()]
            if len(code) > MEMO or held > MEMO_CHARS:
                code.clear()
                held = 0
            held += learn(set().union(*[chunks for parts in split for _, chunks in parts]).difference(code))
            flat = []
            for parts in split:
                ids = []
                for mark, chunks in parts:
                    ids.extend(map(code.__getitem__, chunks))
                    if mark:
                        ids.append(special[mark])
                flat.append(b"".join(ids))
            n = np.array([len(ids) // 4 for ids in flat], np.int64)
            ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            ids = pa.array(np.frombuffer(b"".join(flat), np.int32))
            decoded = pc.binary_join(pa.ListArray.from_arrays(ends, names.take(ids)), " ")
            columns = [batch.column("_row"), pa.array(n), pa.ListArray.from_arrays(ends, ids), decoded]
            yield pa.RecordBatch.from_arrays(columns, ["_row", *added])

    packed = docs.select(row_of(rest).alias("_row"), quoted(text).cast("string").alias("_text"))
    done = packed.mapInArrow(encode, schema_after(packed, ["_row"], "n_tokens long, ids array<int>, decoded string"))
    return done.select(*row_columns(rest), *added)
