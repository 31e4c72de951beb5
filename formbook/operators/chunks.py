"""Cutting a time-ordered table into chunks of bounded size.

Trailing windows and ordinals are sequential per team, or over the whole
table. A busy team would put its entire history into one task, so
tables are first cut along (date, id) into chunks of ``rows_per_chunk`` rows at
most, about. Cut points are approximate quantiles; they are compared exactly and only decide
how the work is split, never what is computed.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_CHUNK = 500_000
NO_DATE = 4_000_000_000_000_000_000  # after every instant that a timestamp can hold, doubled ones too
FIRST = -(1 << 63)  # before every id


def _instant(date: str, late: str | None) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session time zone; nulls come last.

    With ``late``, two steps per microsecond: rows where it holds come second.
    """
    since = F.col(date) - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    micros = (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("long")
    if late:
        micros = micros * 2 + F.col(late).cast("long")
    return F.coalesce(micros, F.lit(NO_DATE))


@dataclass(frozen=True)
class TimeChunks:
    """Ascending cut points along (instant, id); a row belongs to the last one not after it."""

    rows: int
    cuts: list[tuple[int, int]] = field(default_factory=list)
    date: str = "date"
    id: str = "match_id"
    late: str | None = None

    def __bool__(self) -> bool:
        return bool(self.cuts)

    @property
    def crowded(self) -> set[int]:
        """Instants that are cut by id."""
        return {at for at, id in self.cuts if id != FIRST}

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``chunk``, ascending in (date, id)."""
        if not self:
            return df.withColumn("chunk", F.lit(0).cast("long"))
        # Folded to two array literals; each row is placed by binary search.
        ats, ids = (F.from_json(F.lit(json.dumps([c[i] for c in self.cuts])), "array<bigint>") for i in (0, 1))
        steps = [1 << b for b in reversed(range(len(self.cuts).bit_length()))]
        id = F.coalesce(F.col(self.id).cast("long"), F.lit(FIRST))
        df = df.withColumns({"_at": _instant(self.date, self.late), "_id": id})

        def onward(place: Column, step: Column) -> Column:
            at, first = F.get(ats, place + step - 1), F.get(ids, place + step - 1)
            passed = (at < F.col("_at")) | ((at == F.col("_at")) & (first <= F.col("_id")))
            return F.when(passed, place + step).otherwise(place)

        place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), onward)
        return df.withColumn("chunk", place.cast("long")).drop("_at", "_id")


def time_chunks(
    df: DataFrame,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    date: str = "date",
    id: str = "match_id",
    late: str | None = None,
) -> TimeChunks:
    """Measure ``df`` and choose cut points; none up to ``rows_per_chunk`` rows.

    Order within one instant is by ``late`` (false first), then by ``id``. An instant with more rows than a chunk
    gets cuts by id in proportion to its rows, so there are at most a few cuts per chunk.
    """
    spark = df.sparkSession
    keys = df.select(_instant(date, late).alias("at"), F.col(id).cast("long").alias("id"))
    rows = keys.count()
    if rows <= rows_per_chunk:
        return TimeChunks(rows, date=date, id=id, late=late)
    # Several chunks per task, so that hashing them over the tasks comes out even.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(max(-(-rows // rows_per_chunk), 4 * tasks), rows)
    size = -(-rows // n)
    accuracy = max(10_000, 20 * n)
    shares = [i / n for i in range(1, n)]
    found = keys.select(F.percentile_approx("at", shares, accuracy)).first()[0] if shares else []
    cuts = {(at, FIRST) for at in found}
    # An instant with more than ``rows / n`` rows holds one of the quantiles, so only these few are counted.
    held = spark.createDataFrame([(at,) for at in sorted(set(found))], "at long")
    busy = keys.join(F.broadcast(held), "at").groupBy("at").count().filter(F.col("count") > size).collect()
    by_parts: dict[int, list[int]] = {}
    for r in busy:
        parts = -(-r["count"] // size)
        by_parts.setdefault(1 << (parts - 1).bit_length(), []).append(r["at"])
        cuts |= {(r["at"], FIRST), (r["at"] + 1, FIRST)}
    for parts, instants in by_parts.items():  # one pass per power of two
        few = spark.createDataFrame([(at,) for at in instants], "at long")
        shares = [i / parts for i in range(1, parts)]
        split = keys.join(few, "at").groupBy("at").agg(F.percentile_approx("id", shares, accuracy).alias("ids"))
        cuts |= {(r["at"], first) for r in split.collect() for first in r["ids"] or ()}
    return TimeChunks(rows, sorted(cuts), date, id, late)


def with_position(df: DataFrame, chunks: TimeChunks) -> DataFrame:
    """Add ``position``, the 0-based ordinal by (date, id), and ``total`` rows."""
    order = [F.col(chunks.date).asc_nulls_last(), F.col(chunks.id)]
    total = F.lit(chunks.rows).cast("long")
    if not chunks:  # one chunk of bounded size
        whole = F.row_number().over(Window.orderBy(*order)).cast("long")
        return df.withColumn("position", whole - 1).withColumn("total", total)
    df = chunks.assign(df)
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy("chunk").agg(F.count(F.lit(1)).alias("_n"))  # one row per chunk
    offsets = sizes.select("chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("chunk").orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(inside))
        .join(offsets, "chunk")
        .withColumn("position", F.col("_offset") + F.col("_row") - 1)
        .withColumn("total", total)
        .drop("chunk", "_row", "_offset")
    )
