import random

import pytest

from formbook.llm import substring


def brute(rows, window):
    seen, out = {}, {}
    for i, t in sorted(rows):
        words = (t or "").split()
        for a in range(len(words) - window + 1):
            seen.setdefault(tuple(words[a : a + window]), (i, a))
    for i, t in rows:
        words = (t or "").split()
        cut = set()
        for a in range(len(words) - window + 1):
            if seen[tuple(words[a : a + window])] < (i, a):
                cut.update(range(a, a + window))
        out[i] = (len(words), len(cut), " ".join(w for k, w in enumerate(words) if k not in cut))
    return out


def sample(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["a", "bé", "ccc", "d.", "E"]) for _ in range(n))
    passage, other = text(70), text(26)
    texts = [text(rng.randint(0, 90)) for _ in range(15)]
    texts += [text(8) + " " + passage + " " + text(5), passage, text(3) + " " + passage[:60] + " x " + passage[30:]]
    texts += [other + " " + text(2) + " " + other, "z " * 100, "p q " * 40, "", None, "one", " \t\n "]
    return texts + [texts[0]] * 3 + [texts[16]] * 2


@pytest.mark.parametrize("seed,flush", [(1, 1 << 20), (2, 50), (3, 1)])
def test_against_brute_force(docs, monkeypatch, seed, flush):
    monkeypatch.setattr(substring, "FLUSH", flush)
    texts = sample(seed)
    frame = docs(texts).repartition(3)
    want = brute(list(enumerate(texts)), 20)
    got = substring.remove_repeated_windows(frame, bucket_bytes=200).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) == want[r.id], r.id
    assert sum(w[1] for w in want.values()) > 100


def test_cover_has_every_difference():
    p = substring.PERIOD
    assert {(a - b) % p for a in substring.COVER for b in substring.COVER} == set(range(p))


def test_null_ids_equal_rows_and_empty(spark):
    text = " ".join(map(str, range(30)))
    rows = [(None, text, 1), (5, text, 2), (5, text, 2), (None, None, 3)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, kept int")
    got = sorted((r.id if r.id is not None else 99, r.n_words, r.n_removed) for r in substring.remove_repeated_windows(frame).collect())
    assert got == [(5, 30, 0), (5, 30, 0), (99, 0, 0), (99, 30, 30)]
    assert substring.remove_repeated_windows(frame.limit(0)).collect() == []
