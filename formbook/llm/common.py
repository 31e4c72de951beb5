"""Shared pieces: reading the given tables, staging, and clash-free columns."""

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from formbook.session import new_path

_shipped: set[str] = set()

WORD = r"[^\x20\x09-\x0D]+"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="formbook-code-"), "formbook.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)  # Spark serves it from the driver
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage and keeps costly results from being computed twice. The
    files outlive lost executors.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_split(key: Column, salt: Column, parts: int) -> list[Column]:
    """Grouping columns that spread one key over ``parts`` groups."""
    return [key, F.pmod(F.xxhash64(salt), F.lit(parts)).alias("_salt")]


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def other_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` named like none of ``names`` in any case, as Spark resolves them."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def row_of(names: list[str]) -> Column:
    """The caller's columns as one struct, whose fields clash with no helper column."""
    return F.struct(*map(quoted, names)) if names else F.struct(F.lit(0))


def row_columns(names: list[str], row: str = "_row") -> list[Column]:
    return [F.col(row).getField(n).alias(n) for n in names]


def schema_after(df: DataFrame, kept: list[str], added: str) -> T.StructType:
    """Columns of ``df`` as they are, then those of a DDL text."""
    return T.StructType([*(df.schema[c] for c in kept), *T.StructType.fromDDL(added).fields])


def is_frequent(counts: DataFrame, column: str, most: int, most_bytes: int, longest: int) -> Column:
    """Condition of the most frequent of the texts in ``column``, by ``n``, within all three bounds.

    Whole bins of frequency, 16 between a number and its double, are taken from the top. ``counts`` should be staged.
    """
    size, number = F.octet_length(column), F.floor(F.log2("n") * 16)
    bins = counts.filter(size <= longest).groupBy(number.alias("bin")).agg(
        F.count(F.lit(1)).alias("texts"), F.sum(size).alias("bytes")
    )
    least, texts, held = None, 0, 0
    for r in sorted(bins.collect(), reverse=True):  # a thousand rows at most
        texts, held = texts + r["texts"], held + r["bytes"]
        if texts > most or held > most_bytes:
            break
        least = r["bin"]
    return F.lit(False) if least is None else (size <= longest) & (number >= least)
