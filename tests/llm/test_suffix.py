import random
from collections import Counter

import pytest

from formbook.llm import suffix


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cut = set()
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                cut.update(range(i, i + length))
        spans = sum(1 for i in cut if i - 1 not in cut)
        out.append((len(d), len(cut), spans, bytes(b for i, b in enumerate(d) if i not in cut)))
    return out


def sample(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(30), text(14)
    texts = [text(rng.randint(0, 60)) for _ in range(12)]
    texts += [text(8) + passage + text(5), passage + text(9), text(3) + passage, other + text(2) + other]
    texts += [text(4) + passage[:50] + text(3) + passage[20:], "z" * 300, "q" + "z" * 70, "ab" * 100, "", None, "x"]
    texts += [texts[0]] * 3 + [texts[3][:-2]]
    return texts


@pytest.mark.parametrize("seed,group_bytes", [(1, 1 << 20), (2, 300), (3, 0)])
def test_against_brute_force(docs, seed, group_bytes):
    texts = sample(seed)
    got = suffix.remove_repeats(docs(texts), length=24, gram=8, group_bytes=group_bytes).collect()
    want = brute(texts, 24)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id], r.doc_id


def all_repeats(texts, length):
    order, found = suffix.maximal_repeats(texts, length)
    return {(n, tuple(sorted(order[lo:hi].tolist()))) for n, lo, hi in found}


def test_maximal_repeats_have_all_occurrences():
    assert all_repeats([b"xabcabcy", b"zabcw"], 2) == {(3, (1, 4, 10))}
    text = b"mississippi"
    assert all_repeats([text], 1) == {(1, (1, 4, 7, 10)), (4, (1, 4)), (1, (2, 3, 5, 6)), (1, (8, 9))}


def test_periodic_text_takes_linear_time():
    assert suffix._covered([b"ab" * 20_000], 200) == [[(0, 40_000)]]


def test_empty_and_other_columns(spark, docs):
    assert suffix.remove_repeats(docs([])).collect() == []
    frame = spark.createDataFrame([("k" * 300, 1, 7), ("k" * 300, 1, None)], "body string, kept int, doc_id long")
    got = suffix.remove_repeats(frame, text="body", as_text=True)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert [(r.n_removed, r.kept) for r in got.collect()] == [(300, "")] * 2
