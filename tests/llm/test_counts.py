"""Token counts against the library, whitening against numpy, spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tokenizers

from formbook.llm import queries, spelling, tokencount, whitening

BYTE_BPE = queries.tokenizer_file("byte_bpe_50k.json")
PARTS = [
    "a", "bc", "Z", " ", "  ", "\n", "\t", "'s", "'", "'ll", "1", "²", "é", "ß", "中", "\x1c", "\x85", "\xa0", "　",
    "!", "<|endoftext|>", "՘", "👍🏽", "̀", "<|endo", "Ⅷ", "_", "\r\n", "\U0010ffff",
]


# --- token counts --------------------------------------------------------------------------


def lengths(texts):
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("most", [tokencount.HEAD_WORDS, 40, 0])
def test_token_counts_equal_the_library(docs, most):
    pick = random.Random(5)
    texts = ["".join(pick.choices(PARTS, k=pick.randint(0, 30))) for _ in range(400)]
    texts += [None, "", " ", "ab " * 50_000, "x" * 300_000, "same", "same", "the " * 1025]
    got = tokencount.token_counts(docs(texts), BYTE_BPE, most=most).collect()
    want = [(i, len((t or "").encode()), n, n > 1024) for i, (t, n) in enumerate(zip(texts, lengths([t or "" for t in texts])))]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want


def test_token_counts_of_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "one two", 5, "k"), (1, "one two", 5, "k"), (None, None, None, None), (2, "three", 6, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens long, _key string").selectExpr("*", "'q' AS `_row`", "1 AS `a.b`")
    got = tokencount.token_counts(df, BYTE_BPE)
    assert got.columns == ["doc_id", "_key", "_row", "a.b", "n_bytes", "n_tokens", "over_limit"]
    found = Counter((r["doc_id"], r["_key"], r["_row"], r["a.b"], r["n_bytes"], r["n_tokens"]) for r in got.collect())
    one, three = lengths(["one two", "three"])
    assert found == {(1, "k", "q", 1, 7, one): 2, (None, None, "q", 1, 0, 0): 1, (2, "l", "q", 1, 5, three): 1}
    assert tokencount.token_counts(df.limit(0), BYTE_BPE).count() == 0


def test_pieces_are_counted_once_per_pre_token(docs):
    tokens = tokencount.distinct_pre_tokens(docs(["a b a", "a b\n", None]), BYTE_BPE)
    assert sorted(map(tuple, tokens.collect())) == [("\n", 1), (" a", 1), (" b", 2), ("a", 2)]


# --- whitening -----------------------------------------------------------------------------


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute_whitening(rows):
    """Rows, and what eigenvectors of the covariance give for them."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows], np.int64)
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, ((n * x - sums) ** 2).sum(1), centred, values[::-1], vectors[:, ::-1].T


def test_whitening_equals_eigenvectors_of_the_covariance(spark):
    pick = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(pick.standard_normal((300, 40)) * np.linspace(1, 4, 40))]
    rows[7] = (7, rows[6][1])  # a repeated vector
    odd = [(900, None), (901, [None] * 40), (902, [float("nan")] * 40), (903, [float("inf")] * 40), (904, []), (905, [1.0])]
    df = vectors_of(spark, rows + odd)
    model = whitening.fit(df)
    got = whitening.whitened(df, model).collect()
    n, deviations, centred, values, vectors = brute_whitening(rows)
    assert len(got) == 300 * 32 and {r["n"] for r in got} == {n}
    signs = np.sign((model.components * vectors[:32]).sum(1))
    want = centred @ (vectors[:32] * signs[:, None]).T / np.sqrt(values[:32])
    for r in got:
        k = r["component"] - 1
        assert int(r["deviation"]) == int(deviations[r["vec_id"]])
        assert abs(r["whitened"] - want[r["vec_id"], k]) < 1e-9
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_whitening_of_few_rows_keeps_only_directions_with_spread(spark):
    rows = [(1, [0.0, 0.0, 1.0]), (1, [0.0, 0.0, 1.0]), (2, [2.0, 0.0, 1.0]), (3, [0.0, 0.0, 3.0])]
    df = vectors_of(spark, rows)
    got = whitening.whitened(df, whitening.fit(df)).collect()
    assert Counter(r["component"] for r in got) == {1: 4, 2: 4}
    for alike in (rows[:2], rows[:1], []):
        df = vectors_of(spark, alike)
        assert whitening.whitened(df, whitening.fit(df)).count() == 0


def test_whitening_replaces_its_own_columns_and_keeps_others(spark):
    df = vectors_of(spark, [(i, [float(i), float(i * i % 7)]) for i in range(9)]).selectExpr(
        "vec_id", "embedding", "'x' AS `_row`", "7 AS N", "vec_id + 1 AS `_x`"
    )
    got = whitening.whitened(df, whitening.fit(df))
    assert got.columns == [
        "vec_id", "_row", "_x", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]
    assert {(r["_row"], r["_x"] - r["vec_id"], r["n"]) for r in got.collect()} == {("x", 1, 9)}


@pytest.mark.parametrize("kind", ["flat", "falling", "repeated", "low rank", "more columns"])
def test_bidiagonalisation_finds_leading_singular_pairs(kind):
    pick = np.random.default_rng(1)
    d, k = 48, 10
    x = pick.standard_normal((200, d))
    if kind == "falling":
        x *= np.logspace(0, -7, d)
    if kind == "repeated":
        sides = np.linalg.qr(pick.standard_normal((200, d)))[0], np.linalg.qr(pick.standard_normal((d, d)))[0]
        x = sides[0] * np.repeat(np.arange(d // 4, 0, -1), 4) @ sides[1]
    if kind == "low rank":
        x = x[:, :4] @ pick.standard_normal((4, d))
    if kind == "more columns":
        x = x[:6]
    steps = []

    def product(t):
        steps.append(t)
        return x.T @ (x @ t), float((x @ t) @ (x @ t))

    values, vectors = whitening.bidiagonalise(product, d, float((x * x).sum()), k)
    want = np.zeros(k)
    found = np.linalg.svd(x, compute_uv=False)[:k]
    want[: len(found)] = found
    assert len(steps) <= d and (kind != "falling" or len(steps) < 40)
    np.testing.assert_allclose(values, want, atol=1e-12 * want[0])
    np.testing.assert_allclose(vectors @ vectors.T, np.eye(k), atol=1e-11)
    np.testing.assert_allclose(x.T @ (x @ vectors.T), vectors.T * values**2, atol=1e-11 * want[0] ** 2)


# --- spelling variants ---------------------------------------------------------------------


def edit_apart(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, dominance=5):
    near = {w: [v for v in counts if edit_apart(w, v)] for w in counts}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= dominance * n:
            forms[w] = best

    def root(w):
        return root(forms[w]) if w in forms else w

    return {(w, n, len(near[w]), forms.get(w), counts.get(forms.get(w)), root(w)) for w, n in counts.items()}


def variants(spark, counts):
    got = spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    rows = [tuple(r) for r in got.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghij"])
def test_spelling_variants_equal_brute_force(spark, letters):
    pick = random.Random(len(letters))
    words = {"".join(pick.choices(letters, k=pick.randint(6, 8))) for _ in range(250)}
    for w in list(words)[:60]:
        i = pick.randrange(len(w))
        words |= {w[:i] + pick.choice(letters) + w[i + 1 :], w[:i] + pick.choice(letters) + w[i:]}
    counts = {w: int(5 * 5 ** pick.uniform(0, 5)) for w in words}
    assert variants(spark, counts) == brute_variants(counts)


def test_repeated_letters_chains_and_lone_words(spark):
    counts = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaab": 200, "aaaaaaabb": 1000, "lonely": 9, "gleich": 6, "gleicht": 30, "gleichd": 30}
    got = variants(spark, counts)
    assert got == brute_variants(counts)
    by_word = {r[0]: r for r in got}
    assert by_word["aaaaaa"][5] == "aaaaaaabb" and by_word["lonely"][2:] == (0, None, None, "lonely")
    assert by_word["gleich"][3] == "gleichd"  # equal counts: the smaller word


def test_word_counts_equal_brute_force(spark):
    texts = ["Straße ÀÉÎ÷×abc Pétanque" * 3, None, "", "Petanque petanque PETANQUE", "longer-words_splitting around " * 700, "x" * 200_000]
    rows = [(i % 400, texts[i % len(texts)]) for i in range(600)] + [(None, "without anything here")] * 6
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = {(w, n) for w, n in counts.items() if len(w) >= 6 and n >= 5}
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS N", "3 AS `_id`")
    assert {tuple(r) for r in spelling.word_counts(df).collect()} == want
    assert any(w not in "".join(t or "" for t in texts).lower() for w, _ in want)  # a misspelt word is among them


def test_no_words_give_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string")
    assert spelling.spelling_variants(spelling.word_counts(df)).count() == 0
