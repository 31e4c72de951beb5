"""Multi-season extraction and its coverage."""

import datetime as dt
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from formbook.functions.columns import nan_to_null
from formbook.functions.season import in_season, season_label, season_of
from formbook.schemas import DROPPABLE_COLUMNS


class NoSeasons(ValueError):
    """No season could be read, or none held a row."""


SMALL_FILE = 1 << 20  # bytes; a Parquet file without rows is smaller


def _name(file: Column) -> Column:
    """The last part of a path, by which listings and readers agree."""
    return F.substring_index(file, "/", -1)


def file_problems(df: DataFrame, path: str) -> list[tuple[str, str]]:
    """``(file, reason)`` of every file below ``path`` that does not give all its rows to ``df``, a lenient read of it.

    One scan decodes every column; the rows it gives are counted per file and held against those that the file's
    footer tells. Files that are rightly empty are no problem.
    """
    spark, file = df.sparkSession, _name(F.col("_metadata.file_path")).alias("name")
    footers = df.groupBy(file).agg(F.count(F.lit(1)).alias("rows"))
    # Counted by a checksum over all columns, so that the reader can skip none.
    low = F.xxhash64(*df.columns) < 0
    decoded = df.select(file, low.alias("low")).groupBy("name").agg(
        (F.count(F.when(F.col("low"), 1)) + F.count(F.when(~F.col("low"), 1))).alias("read")
    )
    listed = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(path)
    files = listed.select(F.col("path").alias("file"), "length", _name(F.col("path")).alias("name"))
    joined = files.join(footers, "name", "left").join(decoded, "name", "left")
    suspect = joined.filter(F.col("rows").isNull() | (F.coalesce("read", F.lit(0)) < F.col("rows"))).collect()  # bad files
    partly = [(r["file"], "corrupt: not all rows can be read") for r in suspect if r["rows"] is not None]
    small = [r["file"] for r in suspect if r["rows"] is None and r["length"] < SMALL_FILE]
    marked = set()
    if small:
        mark = F.lit("PAR1").cast("binary")
        whole = (F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark)
        marked = {r["path"] for r in spark.read.format("binaryFile").load(small).filter(whole).select("path").collect()}
    return partly + [
        (r["file"], "no Parquet file") for r in suspect if r["rows"] is None and r["file"] not in marked
    ]


def read_seasons(spark: SparkSession, paths: dict[int, str]) -> tuple[DataFrame, list[int]]:
    """Union of all readable seasons by column name, and the seasons that failed as a whole."""
    rows, problems = read_seasons_reported(spark, paths)
    return rows, sorted(season for season, file, _ in problems if file is None)


def read_seasons_reported(
    spark: SparkSession, paths: dict[int, str]
) -> tuple[DataFrame, list[tuple[int, str | None, str]]]:
    """Union of all readable seasons, and ``(season, file, reason)`` for what was left out.

    A season that is missing, has no readable file or holds no row fails as a whole (``file`` null). Of a season with
    some corrupt files only these are left out, whole. Only if no season is left is that an error. Every file is
    decoded once before, to see whether it can be.
    """
    frames, problems = [], []
    for season, path in sorted(paths.items()):
        try:
            # The schema comes from all files; a single one might be a corrupt one.
            df = spark.read.options(ignoreCorruptFiles=True, mergeSchema=True).parquet(path)
            broken = file_problems(df, path)
            if broken:
                names = [file.rsplit("/", 1)[-1] for file, _ in broken]
                df = df.filter(~_name(F.col("_metadata.file_path")).isin(names))
            empty = df.isEmpty()
        except (PySparkException, Py4JJavaError) as error:  # missing, or no file with a schema
            condition = error.getCondition() if isinstance(error, PySparkException) else None
            problems.append((season, None, condition or "unreadable"))
            continue
        problems += [(season, file, reason) for file, reason in broken]
        if empty:
            problems.append((season, None, "no rows"))
            continue
        frames.append(df.withColumn("season", F.lit(season)))
    if not frames:
        raise NoSeasons(f"no season could be read, or all are empty: {problems}")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return nan_to_null(union), problems


def season_coverage(matches: DataFrame, base: int, as_of: dt.datetime) -> DataFrame:
    """Expected seasons from ``base`` to the running one, with landed row counts."""
    expected = matches.sparkSession.range(base, season_of(as_of) + 1).select(
        F.col("id").cast("int").alias("season")
    )
    landed = matches.groupBy("season").agg(F.count(F.lit(1)).alias("n"))
    return expected.join(landed, "season", "left").select(
        "season",
        season_label(F.col("season")).alias("label"),
        F.coalesce("n", F.lit(0)).alias("rows"),
        F.col("n").isNull().alias("missing"),
    )


def matches_by_season(matches: DataFrame, season: int) -> DataFrame:
    """Matches of one season.

    The date range reaches the file scan; on a table partitioned by season
    the second predicate leaves only that partition to read.
    """
    rows = matches.filter(in_season(F.col("date"), season))
    return rows.filter(F.col("season") == season) if "season" in matches.columns else rows


def matches_by_team(matches: DataFrame, team: str) -> DataFrame:
    """Matches of one team, home or away."""
    return matches.filter((F.col("home_team") == team) | (F.col("away_team") == team))


def drop_columns(df: DataFrame, columns: list[str] = DROPPABLE_COLUMNS) -> DataFrame:
    """Drop the listed columns that are present."""
    return df.drop(*columns)
