"""Chronological splits and expanding-window folds."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from formbook.functions.columns import require
from formbook.functions.season import ntz
from formbook.operators.chunks import ROWS_PER_CHUNK, time_chunks, with_position
from formbook.schemas import CV_FOLDS, TEST_WEEKS


def split_label(df: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """Add ``split``: train before the cut-off, test from it on, null without a date."""
    require(df, ["date"], "split")
    date = F.col("date")
    return df.withColumn("split", F.when(date < ntz(cutoff), "train").when(date >= ntz(cutoff), "test"))


def cutoff_for(as_of: dt.datetime, weeks: int = TEST_WEEKS) -> dt.datetime:
    return as_of - dt.timedelta(weeks=weeks)


def temporal_split(
    df: DataFrame, as_of: dt.datetime, weeks: int = TEST_WEEKS
) -> tuple[DataFrame, DataFrame]:
    """(train, test); the test set covers the last ``weeks`` weeks."""
    require(df, ["date"], "split")
    cutoff = ntz(cutoff_for(as_of, weeks))
    return df.filter(F.col("date") < cutoff), df.filter(F.col("date") >= cutoff)


def split_ranges(labelled: DataFrame) -> DataFrame:
    """Rows and date range per split."""
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )


def time_series_folds(
    df: DataFrame, folds: int = CV_FOLDS, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Add ``position`` and ``fold``.

    The last ``folds`` blocks of ``total // (folds + 1)`` rows are the test
    blocks 1, 2, ...; fold k trains on every row before its block, that is on
    rows with a smaller ``fold``. Rows before the first block have fold 0.
    """
    chunks = time_chunks(df, rows_per_chunk)
    if 0 < chunks.rows <= folds:
        raise ValueError(f"{chunks.rows} rows cannot fill {folds} folds and a first training block")
    df = with_position(df, chunks)
    size = F.floor(F.col("total") / (folds + 1))
    start = F.col("total") - folds * size
    block = F.floor((F.col("position") - start) / size) + 1
    fold = F.when(F.col("position") < start, 0).otherwise(block).cast("int")
    return df.withColumn("fold", fold).drop("total")
