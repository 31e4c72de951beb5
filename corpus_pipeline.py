"""Corpus pipeline: from raw documents to tokens, one operator per stage."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from formbook.llm import bpe, mixing, simhash, suffix, toxicity
from formbook.llm.common import other_columns, quoted, row_of, staged, table
from formbook.llm.queries import tokenizer_file


def packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one struct, which no operator's column names can meet."""
    return docs.select(row_of(other_columns(docs, ["text"])).alias("_doc"), "text")


def unpacked(rows: DataFrame, like: DataFrame, text: Column, **changed: Column) -> list[Column]:
    """The columns of ``like`` out of packed rows, with the given text and changes."""
    fields = {c: F.col("_doc").getField(c).alias(c) for c in other_columns(like, ["text"])}
    fields |= {c: value.alias(c) for c, value in {"text": text, **changed}.items() if c in like.columns}
    return [fields[c] for c in like.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the model is fitted on labels that are not held out.

    Null and empty texts are judged as the model judges empty ones. Rows equal in everything stay or go together.
    """
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.scored(packed(docs), model).filter(F.col("score") < toxicity.THRESHOLD)
    return scored.select(*unpacked(scored, docs, F.col("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by SimHash: 3-word shingles, 3 bits.

    The one of the smallest id, null ids last; texts without words are one group. Rows equal in id and text are one.
    """
    return simhash.deduplicated(docs, shingle=3, max_bits=3)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 200 or more that occur elsewhere as well; null texts become empty.

    No document goes, even if nothing of it is left; ``n_chars`` follows the text.
    """
    cut = suffix.remove_repeats(packed(docs), length=200, as_text=True)
    return cut.select(*unpacked(cut, docs, F.col("kept"), n_chars=F.length("kept").cast("long")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last time in part; those without words are never taken."""
    mixed = mixing.mixed_documents(docs)
    return mixed.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else quoted(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and the text decoded from them; columns of these names are replaced."""
    added = ["n_tokens", "ids", "decoded"]
    done = bpe.encoded(packed(docs), tokenizer_file())
    kept = docs.select(*map(quoted, other_columns(docs, added)))
    return done.select(*unpacked(done, kept, F.col("text")), *added)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written as Parquet and reread.

    An empty table gives an empty result. Columns beyond those of the stages pass through, whatever their names.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeats),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode),
]

#: Fitted models, hashes and merges have no SQL form; the tests compare with brute force.
ORACLE_SQL = None
