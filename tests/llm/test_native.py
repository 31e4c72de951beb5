import hashlib
import random

import pytest
from pyspark.sql import functions as F

from formbook.llm import chat, quality, urls

TURNS = "conv_id long, turn long, role string, text string, span string"


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join(rng.choice(["ab", "cé", "<|end|>", "\\l", "\\s", "d\n", "<|", "🙂"]) for _ in range(n))


def conversations():
    rows = [(1, 0, "system", words(20)), (1, 1, "user", words(30, 1)), (1, 2, "assistant", words(40, 2))]
    rows += [(2, i, ("user", "assistant")[i % 2], words(7 * i, i)) for i in range(40)]
    rows += [(3, 0, "system", words(900)), (3, 1, "assistant", None), (4, 0, "system", "alone"), (5, 0, None, "x")]
    rows += [(6, 0, "assistant", "\\### Assistant: </turn> ok"), (7, 1, "user", "a"), (7, 1, "user", "a"), (None, 0, "assistant", "n")]
    return [(*r, "extra") for r in rows]


@pytest.mark.parametrize("budget,history", [(512, 128), (40, 12), (30, 0)])
def test_chat_round_trip(spark, budget, history):
    rows = conversations()
    made = chat.windows(spark.createDataFrame(rows, TURNS).repartition(4), budget=budget, history=history).cache()
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns == "".join(f"{r}\n{t}\n" for r, t in mine)
        assert got[conv].loss_text == "".join(t for r, t in mine if r == "assistant")
    assert set(got) == {r[0] for r in rows}
    for r in made.collect():
        conv = [x for x in rows if x[0] == r.conv_id]
        cost = {(x[1], x[2]): len((x[3] or "").split()) + chat.MARK_TOKENS for x in conv}
        if max(cost.values()) <= budget / 4:
            assert r.n_tokens <= budget
        if conv[0][2] == "system":
            assert r.formatted.startswith("<|turn|>system<|text|>")
        if r.new_at and history:
            assert r.formatted.count("<|turn|>") > r.formatted[r.new_at :].count("<|turn|>")


def test_chat_empty(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], TURNS))).collect() == []


def brute_quality(text):
    w = (text or "").split()
    w = [x for x in (text or "").replace("\x1c", "x").replace("\x85", "x").replace("\xa0", "x").split()] if text else w
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    cut = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cut))


def test_quality_statistics(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(20)]
    texts += ["", None, " \n\t\x0b", "x # $", "a b c a b c a b", "l1 é\nl1 é\n\nl1\tx\n \n", "a\xa0b 🙂🙂", "a b\r\nc", "w " * 3000]
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, n_words int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in quality.statistics(frame).collect():
        assert tuple(r[n] for n in names) == brute_quality(texts[r.doc_id]), repr(texts[r.doc_id])[:80]


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "short"
    rows = [(f"h{h}", good if i >= h * 3 else bad) for h in range(8) for i in range(30)]
    rows += [("once", bad), (None, good), (None, bad), ("h7", good)]
    frame = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)], "doc_id long, text string, source string")
    got = quality.judge(frame).collect()
    assert len(got) == len(rows)
    rate = {r.source: r.host_rate for r in got}
    assert rate["h7"] > 0.5 > rate["h3"] and rate["once"] < 1 and rate[None] is None
    for r in got:
        assert r.kept == (not r.base_failed and not (rate[r.source] or 0) > 0.5)
    assert quality.judge(frame.limit(0)).collect() == []
    same = quality.judge(frame.withColumn("source", F.lit("a"))).select("host_rate").distinct().collect()
    assert len(same) == 1


URLS = [
    ("https://www.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://example.com/en/1?x=/a", "example.com", "/en/1", "example.com/en/", "block"),
    ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("http://m.example.com/en", "m.example.com", "/en", "com/", "allow"),
    ("http://a.net/es/#x", "a.net", "/es/", "net/es/", "block"),
    ("http://notnet/es/", "notnet", "/es/", None, "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("http://a.com?q=://b.net/es/", "a.com", "", None, "allow"),
    ("ÄB://ÄB.org/x://y", "Äb.org", "/x://y", None, "allow"),
    ("nothing", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_listed_rules(spark):
    frame = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.page_id: r for r in urls.judge(frame, none).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)
    assert urls.judge(frame.limit(0), none).collect() == []


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        a, b = rng.choice("pqrs"), rng.choice("xyz")
        rows.append((i, f"http://{a}.org/{b}/{rng.choice('mn')}/{i}", (a == "p" and b == "x") or (b == "z" and rng.random() < 0.85)))
    frame = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows if i % 2] + [(1, None)], "page_id long, bad boolean")
    sets = {i: {f"h:{h}" for h in u.split("/")[2].split(".")} | {f"p:{p}" for p in u.split("/")[3:]} for i, u, _ in rows}
    seen = [(sets[i], bad) for i, _, bad in rows if i % 2]
    from itertools import combinations

    tokens = [t for t in {t for s, _ in seen for t in s} if sum(t in s for s, _ in seen) >= 0.02 * len(seen)]
    rules = []
    for n in range(1, 5):
        for c in combinations(sorted(tokens), n):
            hit = [bad for s, bad in seen if set(c) <= s]
            if hit and sum(hit) >= 0.02 * len(seen) and sum(hit) / len(hit) >= 0.8:
                rules.append(set(c))
    got = {r.page_id: r.verdict for r in urls.judge(frame, labels, min_support=0.02, rules=()).collect()}
    assert got == {i: "block" if any(r <= sets[i] for r in rules) else "allow" for i in sets}
    assert "block" in got.values() and "allow" in got.values()


def test_mining_uses_all_tokens_of_deep_urls(spark):
    """The rule holds the commonest of some twenty frequent tokens and is seen in deep urls only."""
    rows = []
    for i in range(240):
        a, b, deep = i % 4 < 3, i % 3 < 2, i % 5 < 2
        path = ["a" if a else "n", "b" if b else "m"] + [f"t{j}" for j in range(16)] * deep + [f"r{i % 8}", f"s{i % 7}"]
        rows.append((i, "http://h/" + "/".join(path), a and b and deep))
    rows += [(1000, "http://h/a/b/x/x/x/t3", None), (1001, "http://h/a/m/x/x/x/t3", None), (1002, "http://h/a/b", None)]
    frame = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "page_id long, bad boolean")
    got = {r.page_id for r in urls.judge(frame, labels, min_support=0.05, rules=()).filter("verdict = 'block'").collect()}
    assert got == {i for i, _, bad in rows if bad} | {1000}


def test_tokens_of_the_same_urls_each_have_their_rules(spark):
    rows = [(["x", "y", "y2", "u"], True)] * 10 + [(["x", "u"], False)] * 10 + [(["y", "y2", "v"], False)] * 10 + [(["v"], False)] * 10
    frame = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    got = {tuple(r["items"]): (r.confidence, r.support) for r in urls.mined_rules(frame, 0.1, 0.8).collect()}
    assert got == {tuple(sorted((a, b))): (1.0, 0.25) for a in "xu" for b in ("y", "y2")}


def test_many_tokens_of_the_same_urls_are_matched_without_writing_rules_out(spark):
    """Three kinds of urls, each with 200 tokens of its own; bad are those that have all three kinds: 8 million choices, one rule."""
    kinds = [[f"{k}{i}" for i in range(200)] for k in "abc"]
    rows = []
    for i in range(80):
        chosen = [k for j, k in enumerate(kinds) if i >> j & 1]
        rows.append((i, "http://h/" + "/".join(t for k in chosen for t in k), i & 7 == 7))
    rows += [(1000, "http://h/a7/b190/c3", None), (1001, "http://h/a7/a8/c3", None), (1002, "http://h/", None)]
    frame = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "page_id long, bad boolean")
    judged = urls.judge(frame, labels, min_support=0.05, rules=())
    assert {r.page_id for r in judged.filter("verdict = 'block'").collect()} == {i for i, _, bad in rows if bad} | {1000}
    tokens = urls.parsed(frame).withColumn("tokens", urls.tokens()).join(labels, "page_id").select("tokens", "bad")
    rules, classes = urls.class_rules(tokens, 0.05)
    assert [r["items"] for r in rules.collect()] == [["p:a0", "p:b0", "p:c0"]]
    assert classes.count() == 601  # and the host


def test_tokens_carry_their_kind_and_no_place(spark):
    frame = spark.createDataFrame([("http://a.b/a/c.d?a=1&c=2#x",), ("http://b.a/d/c/a?c&a",), (None,)], "url string")
    got = [sorted(r[0]) for r in urls.parsed(frame).select(urls.tokens()).collect()]
    assert got == [["h:a", "h:b", "p:a", "p:c", "p:d", "q:a", "q:c"]] * 2 + [[]]
