"""The registered queries of this package and their oracle SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from formbook.llm import (
    ann, bpe, chat, mixing, oracles, quality, simhash, spelling, substring, suffix, tokencount, toxicity, urls, whitening,
)
from formbook.llm.common import table

CONTROL = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.windows(turns)).select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labels = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, labels).select("page_id", "host", "path", "rule", "verdict")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, length=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_mixing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.shards(docs).select("shard", "slot", "source", "pass", "block", "n_words", F.sha2("text", 256).alias("text_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.scored(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, tokenizer_file()).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeated_windows(table(spark, sf_dir, "documents"), window=20)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.token_counts(docs, tokenizer_file("byte_bpe_50k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whitened(vectors, whitening.fit(vectors)).withColumn("deviation", F.col("deviation").cast("long"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_url_filter": op2_url_filter,
    "op3_simhash": op3_simhash,
    "op4_quality_rules": op4_quality_rules,
    "op5_suffix_array": op5_suffix_array,
    "op6_mixing": op6_mixing,
    "op6_mixing_shards": op6_mixing_shards,
    "op7_toxicity": op7_toxicity,
    "op8_ann": op8_ann,
    "op9_bpe": op9_bpe,
    "op10_substring": op10_substring,
    "op11_token_counts": op11_token_counts,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}
ORACLES: dict[str, str] = oracles.ORACLES
