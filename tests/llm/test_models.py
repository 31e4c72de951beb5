import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from formbook.llm import ann, bpe, mixing, toxicity
from formbook.llm.queries import op7_toxicity, op8_ann, tokenizer_file


def water_level(sizes, weights, most=3):
    total, target, open_ = sum(sizes.values()), {}, dict(weights)
    while open_:
        left = total - sum(target.values())
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            del open_[s]
    return target


def mixed_rows():
    rng = random.Random(2)
    rows = []
    for s, n in (("a", 3), ("b", 200), ("c", 60), ("É", 40), ("z", 5), (None, 30)):
        rows += [(len(rows) + i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 90))), s, i) for i in range(n)]
    rows += [(0, rows[0][1], "a", 1), (None, None, "b", 1), (7000, "v " * 9000, "b", 0), (7001, "", "only empty", 0)]
    return rows


@pytest.mark.parametrize("order_rows", [1, 50_000])
def test_mix_meets_targets(spark, monkeypatch, order_rows):
    monkeypatch.setattr(mixing, "ORDER_ROWS", order_rows * 20)
    rows = mixed_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_level(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(1, min(128, sizes[s] / 32))
    again = mixing.mix(frame.repartition(5)).collect()
    key = lambda r: (r.id is None, r.id, r.hash, r.taken, r.parts)
    assert sorted(got, key=key) == sorted(again, key=key)
    docs = mixing.mixed_documents(frame)
    assert docs.columns == frame.columns
    words = {s: sum(len(r.text.split()) for r in docs.collect() if r.source == s) for s in sizes}
    assert words == taken
    assert mixing.mix(frame.limit(0)).collect() == []


def test_mix_by_shards(spark):
    frame = spark.createDataFrame(mixed_rows(), "doc_id long, text string, source string, size int")
    blocks = mixing.shards(frame, block_words=8, shard_blocks=100).collect()
    slots, per_source, words, taken = {}, Counter(), {}, Counter()
    for r in blocks:
        slots.setdefault(r.shard, []).append(r.slot)
        per_source[r.source, r.shard] += 1
        words.setdefault(r.source, Counter()).update(r.text.split())
        assert len(r.text.split()) == r.n_words <= 8
    assert len({(r.source, r["pass"], r.block) for r in blocks}) == len(blocks)
    assert sorted(slots) == list(range(-(-len(blocks) // 100)))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Counts of a source over the shards are multinomial.
    for source in words:
        n, m = sum(per_source[source, s] for s in slots), len(slots)
        spread = sum((per_source[source, s] - n / m) ** 2 for s in slots) / (n / m)
        assert spread < m - 1 + 4 * (2 * (m - 1)) ** 0.5
        assert n < 100 or spread > m - 1 - 3 * (2 * (m - 1)) ** 0.5
    for r in mixing.mix(frame, block_words=8).collect():
        taken[r.source] += r.taken
    assert {s: sum(c.values()) for s, c in words.items()} == {s: n for s, n in taken.items() if n}
    whole = {}
    for r in mixing.mixed_documents(frame, block_words=8).collect():
        whole.setdefault(r.source, Counter()).update(r.text.split())
    assert words == {s: c for s, c in whole.items() if c}
    assert mixing.shards(frame.limit(0)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000])
def test_permutations(n):
    images = [mixing.permuted(np.arange(n), n, key) for key in (1, 2)]
    for x in images:
        assert sorted(x.tolist()) == list(range(n))
    assert n < 64 or (images[0] != images[1]).mean() > 0.9


def test_toxicity_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = op7_toxicity(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in got if r.toxic == 1 and r.quality == 1]  # junk texts carry labels at random
    clean = [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.9
    assert sum(r.predicted for r in clean) / len(clean) < 0.01


def test_toxicity_locates_sentences(spark):
    rng = random.Random(4)
    plain = lambda: " ".join(rng.choice(["tree", "river", "stone", "cloud", "bird"]) for _ in range(6)).capitalize() + "."
    rows = []
    for i in range(200):
        body = [plain() for _ in range(5)]
        if i % 4 == 0:
            body.insert(rng.randint(0, 5), "You vile gribnok there.")
        rows.append((i, " ".join(body), int(i % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.fit(frame)
    found = {r.id: r.sentences for r in toxicity.offending(frame, model).collect()}
    assert found == {i: ["You vile gribnok there"] for i in range(0, 200, 4)}
    odd = spark.createDataFrame([(None, None, "s"), (1, "", "s"), (1, "", "s")], "doc_id long, text string, score string")
    scores = [r.score for r in toxicity.scored(odd, model).collect()]
    assert len(scores) == 3 and max(scores) < 0.5
    assert toxicity.scored(odd.limit(0), model).collect() == []
    assert [r.score < 0.1 for r in toxicity.scored(odd, toxicity.fit(frame.limit(0))).collect()] == [True] * 3


def test_toxicity_of_long_clean_texts(spark):
    """Length alone is no sign of toxicity, though some toxic labels have no feature to explain them."""
    rows = []
    for i in range(400):
        body = "The river runs by the stone. " * (i % 7 + 1) + "You vile gribnok there. " * (i % 4 == 0)
        rows.append((i, body, int(i % 4 == 0 or i % 50 == 1)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    plain = "The river runs by the stone. "
    short, long = (model.score(plain * n, {}) for n in (1, 100_000))
    assert short == long == model.score("", {}) < 0.1
    assert model.score(plain * 100_000 + "You vile gribnok there.", {}) > 0.9
    assert model.offending(plain * 3 + "You vile gribnok there.", {}, 0.5) == ["You vile gribnok there"]


def test_toxicity_sample_counts_distinct_texts(spark):
    """Copies of two texts outnumber the sample, whichever hashes come first."""
    rows = [(f"The river{chr(97 + i // 26)}{chr(97 + i % 26)} runs." + " You vile gribnok." * (i % 2), i % 2) for i in range(60)]
    rows += [r for r in rows for _ in range(60)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"), train_docs=60)
    scores = [model.score(text, {}) for text, _ in rows[:60]]
    assert all((s >= 0.7) == bool(y) for s, (_, y) in zip(scores, rows))
    few = [("The stone lies.", 0)] * 100 + [("You vile gribnok.", 1)] * 100
    model = toxicity.fit(spark.createDataFrame(few, "text string, label int"), train_docs=20)
    assert model.score("You vile gribnok.", {}) > 0.7 > model.score("The stone lies.", {})


def test_ann_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    got = op8_ann(spark, folder).toPandas()
    asked = ids[ids % 20 == 0]
    assert len(got) == 20 * len(asked)
    place = {v: i for i, v in enumerate(ids)}
    hits = 0
    for q in asked:
        s = x @ x[place[q]]
        s[place[q]] = -np.inf
        hits += len(set(ids[np.argsort(-s)[:20]]) & set(got.vec_id[got.query_id == q]))
    assert hits / len(got) >= 0.9
    for r in got.head(200).itertuples():
        assert r.score == pytest.approx(float(x[place[r.query_id]] @ x[place[r.vec_id]]), abs=1e-12)


def test_ann_ties_and_invalid_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [1.0, 0.5, 0.25], "x") for i in range(40)] + [(40, [0.0, 1.0, 0.0], "x"), (41, [0.0, 0.0, 0.0], "x")]
    rows += [(60, None, "x"), (80, [1.0, None, 0.0], "x"), (100, [nan, 0.0, 1.0], "x"), (120, [inf, 0.0, 1.0], "x")]
    rows += [(140, [1.0], "x"), (None, [1.0, 0.5, 0.25], "x"), (160, [], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0, share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: list(range(1, 21)), 20: list(range(20)), 40: list(range(20))}
    assert ann.search(frame.limit(0), F.col("vec_id") == 0).collect() == []
    two = frame.filter("vec_id in (0, 40)")
    assert sorted((r.query_id, r.vec_id) for r in ann.search(two, F.col("vec_id") % 20 == 0).collect()) == [(0, 40), (40, 0)]


@pytest.mark.parametrize("seed", range(5))
def test_walk_order(seed):
    rng = np.random.default_rng(seed)
    a, b, sizes = rng.normal(size=6), rng.normal(size=5), rng.integers(0, 4, 30)
    cells = ann.walk(a, b, sizes, int(sizes.sum()) + 1)
    assert cells.tolist() == np.argsort(-(a[:, None] + b).ravel(), kind="stable").tolist()


def nasty_texts():
    rng = random.Random(8)
    pool = "aé’'Σ ß🙂1٣<|endoftext|> İ\u0301\u200b\x85ǅ中\n\t.!?'re\U0001e6c0\u0558\ufffd"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return texts + ["", None, "<|startoftext|>It's ΣΑΣ we'll<|endoftext|> <|endoftext|>x", "a" * 20000, " \n ", "the the"]


@pytest.mark.parametrize("most", [0, 50, 30_000])
def test_bpe_equals_library(docs, most):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    texts = nasty_texts()
    frame = docs(texts).withColumn("ids", F.lit(1))
    got = {r.doc_id: r for r in bpe.encoded(frame, tokenizer_file(), most=most).collect()}
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert list(got[i].ids) == want, repr(t)
        assert got[i].n_tokens == len(want)
        assert got[i].decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encoded(frame.limit(0), tokenizer_file()).collect() == []


def test_both_ways_to_merge_agree():
    tokenizer, rng = bpe.Tokenizer(tokenizer_file()), random.Random(6)
    words = ["".join(rng.choice("aeinrstthé") for _ in range(rng.randint(1, 60))).encode() for _ in range(500)]
    words.append(b"the" * 100)
    assert tokenizer.merge_all(words) == [tokenizer.merge(w) for w in words]
    for word in words:
        ids = [*(tokenizer.inner[b] for b in word[:-1]), tokenizer.last[word[-1]]]
        assert tokenizer.merge(word) == tokenizer._merge_long(ids)


def test_lexicon_is_minimal_and_exact():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "é", "", "stops"])}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words))
    assert lexicon.ids(list(words)) == list(words.values())
    assert lexicon.ids([b"ta", b"tapss", b"s", b"x", "éé".encode()]) == [None] * 5
    assert bpe.Lexicon(bpe.compile_lexicon({})).ids([b"", b"a"]) == [None, None]
    assert len(lexicon._finals) == 10  # a trie would have 15
