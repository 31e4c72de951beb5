"""Standings, matchweeks, news and the matchweeks' numbers as one set of frames."""

from pyspark.sql import DataFrame, functions as F

from formbook.operators.fixtures import keyword_feed, matchweek_window, matchweeks
from formbook.operators.leaderboard import league_table


def dashboard(
    matches: DataFrame, season: int, articles: DataFrame, phrases: list[str], language: str = "en"
) -> dict[str, DataFrame]:
    running = matches.filter(F.col("season") == season)
    weeks = matchweek_window(running)
    return {
        "standings": league_table(running),
        "fixtures": weeks.filter(F.col("week") == "next_matchweek"),
        "results": weeks.filter(F.col("week") == "previous_matchweek"),
        "news": keyword_feed(articles, phrases, language),
        "metadata": matchweeks(running).select(
            F.col("next_matchweek").alias("next_mw"), F.col("previous_matchweek").alias("prev_mw")
        ),
    }
