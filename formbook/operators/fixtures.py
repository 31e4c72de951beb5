"""Picking fixtures and matchweeks relative to a clock."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from formbook.functions.season import ntz


def gameweek(fixtures: DataFrame, as_of: dt.datetime, days: int = 4) -> DataFrame:
    """Future fixtures up to ``days`` after the first of them, inclusive."""
    upcoming = fixtures.filter(F.col("date") > ntz(as_of))
    first = upcoming.agg(F.min("date")).scalar()
    return upcoming.filter(F.col("date") <= first + F.expr(f"INTERVAL {days} DAYS"))


def with_match_key(fixtures: DataFrame) -> DataFrame:
    """Add the ``home vs away`` key and the calendar day."""
    return fixtures.withColumns(
        {
            "match_key": F.concat_ws(" vs ", "home_name", "away_name"),
            "match_date": F.date_format("date", "yyyy-MM-dd"),
        }
    )


def latest_per_key(fixtures: DataFrame) -> DataFrame:
    """One row per match key: the last one in date order wins."""
    columns = [c for c in fixtures.columns if c != "match_key"]
    last = F.max_by(F.struct(*columns), F.struct("date", "fixture_id"))
    return fixtures.groupBy("match_key").agg(last.alias("f")).select("match_key", "f.*")


def matchweeks(matches: DataFrame) -> DataFrame:
    """``next_matchweek`` and ``previous_matchweek``, one row.

    Next: matchday of the first scheduled match. Previous: highest matchday among finished ones.
    """
    status = F.col("status")
    first_scheduled = F.when(
        status == "SCHEDULED", F.struct(F.col("date").isNull(), "date", "match_id", "matchday")
    )
    return matches.agg(
        F.min(first_scheduled)["matchday"].alias("next_matchweek"),
        F.max(F.when(status == "FINISHED", F.col("matchday"))).alias("previous_matchweek"),
    )


def matchweek_window(matches: DataFrame) -> DataFrame:
    """All matches of the next and the previous matchday; a matchday that is both yields its rows twice."""
    weeks = matchweeks(matches).unpivot([], ["next_matchweek", "previous_matchweek"], "week", "matchday")
    # Two rows by construction.
    return matches.join(F.broadcast(weeks), "matchday")


def keyword_feed(
    articles: DataFrame, phrases: list[str], language: str, n: int = 10
) -> DataFrame:
    """Newest ``n`` articles in a language that contain any of the phrases; equal times go by the other columns."""
    text = F.lower("text")
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(text, F.lit(phrase.lower()))
    return (
        articles.filter((F.col("lang") == language) & found)
        .orderBy(F.col("published").desc(), *[c for c in articles.columns if c != "published"])
        .limit(n)
    )
