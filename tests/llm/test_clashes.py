"""Columns of the caller named like the operators' own, in either case, come back as they were."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from formbook.llm import bpe, mixing, quality, simhash, suffix, tokencount, toxicity, urls
from formbook.llm.queries import tokenizer_file

NAMES = [
    "_row", "_doc", "_key", "_id", "_hash", "_from", "_order", "_n", "_text", "_words", "_lines", "_windows", "_ranked",
    "_starts", "_tokens", "_listed", "_salt", "row", "pieces", "ranges", "t1", "h", "copies", "rank", "taken", "a.b",
]
OWN = ["Score", "SCORES", "Kept", "N_Bytes", "N_Removed", "N_Spans", "N_tokens", "Ids", "Decoded", "Host", "Path", "Rule", "Verdict", "N_words", "Base_Failed"]
TEXTS = ["one two three four", "one two three four", "five six seven eight nine", None, "", "eleven twelve\nthirteen"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"was {n}").alias(n) for n in [*NAMES, *OWN]])


def untouched(df, names):
    rows = df.select(*[F.col(f"`{n}`") for n in names]).distinct().collect()
    return [tuple(r) for r in rows] == [tuple(f"was {n}" for n in names)]


def test_operators(spark, clashing):
    model = toxicity.NoisyOr({}, -5.0)
    lower = {
        "score": toxicity.scored(clashing, model),
        "ids": bpe.encoded(clashing, tokenizer_file(), most=10),
        "kept": suffix.remove_repeats(clashing),
        "n_tokens": tokencount.token_counts(clashing, tokenizer_file("byte_bpe_50k.json")),
        "n_words": quality.statistics(clashing),
    }
    for added, df in lower.items():
        assert added in df.columns and len({c.lower() for c in df.columns}) == len(df.columns)
        assert df.count() == len(TEXTS) + 1 and untouched(df, NAMES), added
    assert untouched(simhash.deduplicated(clashing), [*NAMES, *OWN])
    assert untouched(mixing.mixed_documents(clashing), [*NAMES, *OWN])


def test_a_document_keeps_its_own_id_in_the_mix(spark, clashing):
    mixed = mixing.mixed_documents(clashing.withColumn("_id", F.col("doc_id") + 100))
    assert {(r["doc_id"], r["_id"]) for r in mixed.collect()} <= {(i, i + 100) for i in range(len(TEXTS))} | {(None, None)}


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (None, None)], "page_id long, url string")
    pages = pages.select("*", *[F.lit(f"was {n}").alias(n) for n in [*NAMES, "Host"]])
    labels = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    got = urls.judge(pages, labels)
    assert got.count() == 2 and untouched(got, NAMES) and got.columns[:2] == ["page_id", "url"] and "Host" not in got.columns


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages(spark, clashing, name, stage):
    kept = [*NAMES, *[n for n in OWN if name != "bpe_encoding" or n not in ("N_tokens", "Ids", "Decoded")]]
    docs = clashing.select("doc_id", "text", "lang", "source", "n_chars", *[F.col(f"`{n}`") for n in [*NAMES, *OWN]])
    got = stage(spark, docs, "/root/testdata/sf0.001")
    assert got.count() > 0 and untouched(got, kept)
    assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
