import random

import xxhash

from formbook.llm import simhash


def brute_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in fps}


def sample():
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("ab cd EF gé hij k").lower() + str(rng.randint(0, 30)) for _ in range(n))
    base = text(300)
    near = [" ".join([*base.split()[:i], "zz", *base.split()[i + 1 :]]) for i in range(0, 240, 8)]
    return [text(rng.randint(1, 50)) for _ in range(40)] + [base, *near, "", None, " \n", "One two", "one TWO", "x" * 5000]


def check(docs, **options):
    texts = sample()
    got = {r.id: (r.fp & (1 << 64) - 1, r.component) for r in simhash.near_duplicates(docs(texts), **options).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: f for i, (f, _) in got.items()} == fps
    assert {i: c for i, (_, c) in got.items()} == brute_components(fps)
    return got


def test_against_brute_force(docs):
    got = check(docs)
    assert len({c for _, c in got.values()}) < len(got) - 10


def test_crowded_keys_lose_no_link(docs):
    check(docs, crowded=1)


def test_null_ids_repeats_and_empty(spark):
    rows = [(None, "a b c d", 1), (4, "a b c d", 2), (4, "a b c d", 3), (9, None, 4), (None, "", 5), (7, "q r s t u", None)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, fp int")
    kept = {(r.doc_id, r.text) for r in simhash.deduplicated(frame).collect()}
    assert kept == {(4, "a b c d"), (9, None), (7, "q r s t u")}
    assert simhash.near_duplicates(frame.limit(0)).collect() == []
