"""Exclusive trailing windows per team, exact over rows cut into chunks."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from formbook.schemas import WINDOW


def match_order() -> list[Column]:
    return [F.col("date").asc_nulls_last(), F.col("match_id").asc()]


def part_keys(df: DataFrame) -> list[str]:
    """Windows run within a chunk where the rows have been cut into chunks."""
    return ["chunk"] if "chunk" in df.columns else []


def full_sum(column: str, window, size: int = WINDOW) -> Column:
    """Sum over the window if all of its ``size`` entries are known, else null."""
    return F.when(F.count(column).over(window) == size, F.sum(column).over(window))


def history_rows(
    known: DataFrame,
    keys: list[str],
    payload: list[str],
    starts: DataFrame | None = None,
    size: int = WINDOW,
) -> DataFrame:
    """For every chunk, the last ``size`` known rows of each key from earlier chunks.

    Put in front of a chunk's own rows they make its trailing frames exact.
    Only the newest ``size`` rows per (chunk, keys) are shuffled, and these
    alone meet per key, however many rows the key has. ``starts`` lists the
    (chunk, keys) that need history; by default those that hold known rows.
    """
    order = match_order()
    newest = Window.partitionBy("chunk", *keys).orderBy(
        F.col("date").desc_nulls_first(), F.col("match_id").desc()
    )
    item = F.struct("date", "match_id", *payload)
    tails = (
        known.select("chunk", "date", "match_id", *keys, *payload)
        .withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") <= size)
    )
    if starts is None:
        # A chunk's first tail row follows the last rows before the chunk.
        line = Window.partitionBy(*keys).orderBy("chunk", *order)
        before = F.collect_list(item).over(line.rowsBetween(-size, -1))
        previous = F.lag("chunk").over(line)
        at_start = tails.withColumns({"_items": before, "_previous": previous}).filter(
            F.col("_previous") < F.col("chunk")
        )
    else:
        # Each start takes over the state left by the tail rows of earlier chunks.
        upto = Window.partitionBy(*keys).orderBy("chunk", *order).rowsBetween(1 - size, 0)
        sofar = (
            Window.partitionBy(*keys)
            .orderBy("chunk", "_kind", *order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        states = tails.select(
            "chunk", *keys, F.lit(1).alias("_kind"), "date", "match_id",
            F.collect_list(item).over(upto).alias("_items"),
        )
        starts = starts.select("chunk", *keys, F.lit(0).alias("_kind"))
        at_start = (
            states.unionByName(starts, allowMissingColumns=True)
            .withColumn("_items", F.last("_items", ignorenulls=True).over(sofar))
            .filter(F.col("_kind") == 0)
        )
    return at_start.select("chunk", *keys, F.explode("_items").alias("_item")).select(
        "chunk", *keys, "_item.*"
    )
