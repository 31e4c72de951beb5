"""Season and calendar rules. A season runs from August to July."""

import datetime as dt

from pyspark.sql import Column, functions as F


def season_start(date: Column) -> Column:
    """Year in which the season holding ``date`` began."""
    return (F.year(date) - F.when(F.month(date) >= 8, 0).otherwise(1)).cast("int")


def season_label(start: Column) -> Column:
    return F.concat_ws("/", start.cast("string"), (start + 1).cast("string"))


def parse_season(label: Column) -> Column:
    """Start year out of a label such as ``2025/2026``."""
    return F.split(label, "/")[0].cast("int")


def season_of(as_of: dt.datetime) -> int:
    return as_of.year if as_of.month >= 8 else as_of.year - 1


def in_season(date: Column, season: int) -> Column:
    """Range form of the season test, so that it reaches the file scan."""
    first = F.lit(dt.datetime(season, 8, 1)).cast("timestamp_ntz")
    last = F.lit(dt.datetime(season + 1, 8, 1)).cast("timestamp_ntz")
    return (date >= first) & (date < last)


def ntz(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
