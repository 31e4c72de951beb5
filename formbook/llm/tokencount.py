"""Token counts of whole texts, without their ids.

Every distinct pre-token of the corpus is split into pieces once. A document's count is the sum, over its pre-tokens,
of frequency times pieces: frequent pre-tokens come from a dictionary of bounded size, the others by a join. So no
frequent pre-token is shuffled per document, and no token id is kept.
"""

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from formbook.llm.bpe import BYTE_CHARS, short_batches
from formbook.llm.common import is_frequent, other_columns, quoted, row_columns, row_of, schema_after, staged
from formbook.llm.scan import as_bytes

TOKEN_LIMIT = 1024
HEAD_WORDS = 200_000  # pre-tokens in the dictionary, at most
HEAD_BYTES = 1 << 25  # and their bytes in all
HEAD_LENGTH = 4096  # and bytes of one of them
COUNTED = 200_000  # different chunks a task counts before it passes their pre-tokens on
MEMO = 200_000  # different chunks a task remembers
MEMO_CHARS = 20_000_000  # and their characters in all

# Fixed value: how byte-level tokenizers of this kind cut text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same cuts at white space only; a chunk's pre-tokens do not depend on its neighbours.
CHUNK = r" ?\S+|\s+(?!\S)|\s+"

_odd_space = re.compile("[\x1c-\x1f]").search  # space to ``re``, not to the tokenizer


class PreTokens:
    """Cuts texts into chunks and pre-tokens, and pre-tokens into pieces, as a byte-level tokenizer file says."""

    def __init__(self, path: str):
        import tokenizers

        library = tokenizers.Tokenizer.from_file(path)
        self._pieces, self._library = library.model.tokenize, library.pre_tokenizer
        special = sorted((t.content for t in library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")").split if special else None
        self._find, self._chunks = regex.compile(PATTERN).findall, re.compile(CHUNK).findall
        self._exact_chunks = regex.compile(CHUNK).findall
        ascii_pattern = PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\sa-zA-Z0-9]")
        ascii_pattern = ascii_pattern.replace(r"\p{L}", "[a-zA-Z]").replace(r"\p{N}", "[0-9]")
        self._find_ascii = re.compile(ascii_pattern, re.ASCII).findall  # the same on ASCII text, and faster
        self._assigned: set[str] = set()
        self._bytes = {c: b for b, c in enumerate(BYTE_CHARS)}
        self._printed = {b: c for b, c in enumerate(BYTE_CHARS) if chr(b) != c}

    def parts(self, text: str) -> Iterable[tuple[int, list[str | bytes]]]:
        """Number of special tokens, and chunks, of each part of a text."""
        if self._special is None:
            yield 0, self._cut(text)
            return
        for i, part in enumerate(self._special(text)):
            yield (1, []) if i % 2 else (0, self._cut(part))

    def _cut(self, text: str) -> list[str | bytes]:
        if not text.isascii():
            fresh = set(text) - self._assigned
            if fresh:
                # The library's Unicode tables decide on code points that this Python does not know.
                if any(unicodedata.category(c) == "Cn" for c in fresh):
                    return [bytes(map(self._bytes.__getitem__, p)) for p, _ in self._library.pre_tokenize_str(text)]
                self._assigned |= fresh
        return self._exact_chunks(text) if _odd_space(text) else self._chunks(text)

    def words(self, chunk: str | bytes) -> list[str]:
        """Pre-tokens of a chunk; bytes are a pre-token already."""
        if isinstance(chunk, bytes):
            return [chunk.decode()]
        return self._find_ascii(chunk) if chunk.isascii() else self._find(chunk)

    def pieces(self, word: str) -> int:
        printed = word.encode().decode("latin-1").translate(self._printed)
        return len(self._pieces(printed))


@lru_cache(maxsize=2)
def pre_tokens_of(path: str) -> PreTokens:
    """One per file and Python worker."""
    return PreTokens(path)


def distinct_pre_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``token, n``: every distinct pre-token of all texts and its frequency."""

    def count(batches):
        cutter, chunks = pre_tokens_of(path), Counter()

        def out():
            words = Counter()
            for chunk, n in chunks.items():
                for word in cutter.words(chunk):
                    words[word] += n
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(words.values(), pa.int64())], ["token", "n"]
            )

        for batch in short_batches(batches):
            for body in batch.column("_text").to_pylist():
                for _, found in cutter.parts(body or ""):
                    chunks.update(found)
            if len(chunks) > COUNTED:
                yield out()
                chunks.clear()
        if chunks:
            yield out()

    texts = docs.select(quoted(text).cast("string").alias("_text"))
    return texts.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def with_pieces(tokens: DataFrame, path: str) -> DataFrame:
    """``token, n`` and the number of ``pieces`` of each; a token is split once."""

    def split(batches):
        cutter = pre_tokens_of(path)
        for batch in batches:
            pieces = [cutter.pieces(w) for w in batch.column("token").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int32())], ["token", "n", "pieces"])

    return tokens.mapInArrow(split, "token string, n long, pieces int")


def _frequencies(docs: DataFrame, path: str, text: str, rest: list[str], head: dict[str, int]) -> DataFrame:
    """A row per document: pieces of its frequent pre-tokens, and the frequencies of the others."""
    known = docs.sparkSession.sparkContext.broadcast(head)

    def count(batches):
        cutter, pieces = pre_tokens_of(path), known.value
        sums: dict[str | bytes, int] = {}  # chunks met so far: pieces of frequent pre-tokens
        others: dict[str | bytes, list[str]] = {}  # and the others, if any
        held = 0
        for batch in short_batches(batches):
            if len(sums) > MEMO or held > MEMO_CHARS:
                sums.clear()
                others.clear()
                held = 0
            base, tails = [], []
            for body in batch.column("_text").to_pylist():
                total, tail = 0, Counter()
                for special, chunks in cutter.parts(body or ""):
                    total += special
                    for chunk in set(chunks).difference(sums):
                        words = cutter.words(chunk)
                        sums[chunk] = sum([pieces.get(w, 0) for w in words])
                        rare = [w for w in words if w not in pieces]
                        if rare:
                            others[chunk] = rare
                        held += len(chunk)
                    total += sum(map(sums.__getitem__, chunks))
                    for chunk in chunks:
                        if chunk in others:
                            tail.update(others[chunk])
                base.append(total)
                tails.append(tail)
            ends = [0]
            for tail in tails:
                ends.append(ends[-1] + len(tail))
            pairs = pa.StructArray.from_arrays(
                [
                    pa.array([w for t in tails for w in t], pa.string()),
                    pa.array([n for t in tails for n in t.values()], pa.int64()),
                ],
                ["token", "n"],
            )
            sizes = pc.binary_length(as_bytes(batch.column("_text"))).cast(pa.int64())
            columns = [
                batch.column("_key"), batch.column("_row"), sizes, pa.array(base, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_key", "_row", "_bytes", "_base", "_tail"])

    packed = docs.select(
        F.monotonically_increasing_id().alias("_key"), row_of(rest).alias("_row"), quoted(text).cast("string").alias("_text")
    )
    added = "_bytes long, _base long, _tail array<struct<token: string, n: long>>"
    return packed.mapInArrow(count, schema_after(packed, ["_key", "_row"], added))


def token_counts(
    docs: DataFrame, path: str, text: str = "text", limit: int = TOKEN_LIMIT, most: int = HEAD_WORDS
) -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``path`` is a byte-level BPE file that every executor reads. Special tokens inside a text count one each. Null text
    counts as empty: no bytes, no tokens. Equal rows are counted one by one, whatever their ids. An empty table gives
    an empty result. Columns named like the added ones, in any case, are replaced. ``most`` bounds the dictionary of
    frequent pre-tokens that each task holds; the result does not depend on it.
    """
    rest = other_columns(docs, [text, "n_bytes", "n_tokens", "over_limit"])
    tokens = staged(with_pieces(distinct_pre_tokens(docs, path, text), path), "pre_tokens")
    is_head = is_frequent(tokens, "token", most, HEAD_BYTES, HEAD_LENGTH)
    head = {r["token"]: r["pieces"] for r in tokens.filter(is_head).select("token", "pieces").collect()}  # bounded above
    counted = staged(_frequencies(docs, path, text, rest, head), "token_frequencies")
    tail = counted.select("_key", F.explode("_tail").alias("t")).select("_key", "t.token", "t.n")
    pieces = tokens.filter(~is_head).select("token", "pieces")
    sums = tail.join(pieces, "token").groupBy("_key").agg(F.sum(F.col("n") * F.col("pieces")).alias("_rest"))
    n = F.col("_base") + F.coalesce("_rest", F.lit(0))
    return counted.drop("_tail").join(sums, "_key", "left").select(
        *row_columns(rest), F.col("_bytes").alias("n_bytes"), n.alias("n_tokens"), (n > limit).alias("over_limit")
    )
