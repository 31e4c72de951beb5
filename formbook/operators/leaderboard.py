"""Top-N tables for players and teams, and the league table."""

from functools import wraps

from pyspark.sql import Column, DataFrame, Window, functions as F

from formbook.functions.columns import require
from formbook.operators.timeline import team_rows
from formbook.schemas import PLAYER_STATS, TEAM_STATS, ContractError

TOP = 5


def _empty_on_contract_error(build):
    """``on_error="empty"`` turns a missing column into an empty frame."""

    @wraps(build)
    def run(stats: DataFrame, *args, on_error: str = "raise", **kwargs) -> DataFrame:
        try:
            return build(stats, *args, **kwargs)
        except ContractError:
            if on_error != "empty":
                raise
            return stats.sparkSession.createDataFrame([], "rank int")

    return run


def _ranked(df: DataFrame, n: int, order: list[Column], columns: list[str]) -> DataFrame:
    """First ``n`` rows with their rank; only those ``n`` rows meet in one task."""
    top = df.select(*columns).orderBy(*order).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), *columns)


def _team_totals(stats: DataFrame, sums: dict[str, Column]) -> DataFrame:
    return (
        stats.filter(F.col("team").isNotNull())
        .groupBy("team")
        .agg(*[F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in sums.items()])
    )


def _created_chances() -> Column:
    return F.col("xg_chain") + F.col("xg_buildup")


@_empty_on_contract_error
def top_players(stats: DataFrame, stat: str, n: int = TOP) -> DataFrame:
    require(stats, ["player", "team", stat], "top_players")
    order = [F.col(stat).desc_nulls_last(), F.col("player").asc(), F.col("team").asc()]
    return _ranked(stats, n, order, ["player", "team", stat])


@_empty_on_contract_error
def top_teams(stats: DataFrame, stat: str, n: int = TOP) -> DataFrame:
    require(stats, ["team", stat], "top_teams")
    totals = _team_totals(stats, {stat: F.col(stat)})
    return _ranked(totals, n, [F.col(stat).desc(), F.col("team").asc()], ["team", stat])


@_empty_on_contract_error
def top_teams_created_chances(stats: DataFrame, n: int = TOP) -> DataFrame:
    require(stats, ["team", "xg_chain", "xg_buildup"], "top_teams_created_chances")
    totals = _team_totals(stats, {"created_chances": _created_chances()})
    order = [F.col("created_chances").desc(), F.col("team").asc()]
    return _ranked(totals, n, order, ["team", "created_chances"])


def leaderboard_tables() -> list[str]:
    return [
        *[f"top_players_{s}" for s in PLAYER_STATS],
        *[f"top_teams_{s}" for s in TEAM_STATS],
        "top_teams_created_chances",
    ]


def leaderboards_all(stats: DataFrame, n: int = TOP) -> DataFrame:
    """All eleven tables in long form: two scans, one ranking each.

    The per-table rank limit is applied before the shuffle, so each task sends
    at most ``n`` rows per table.
    """
    require(stats, ["player", "team", *PLAYER_STATS, "xg_chain", "xg_buildup"], "leaderboards_all")
    players = stats.select(
        "player", "team", *[F.col(s).cast("double").alias(f"top_players_{s}") for s in PLAYER_STATS]
    ).unpivot(["player", "team"], [f"top_players_{s}" for s in PLAYER_STATS], "table_name", "value")
    sums = {f"top_teams_{s}": F.col(s).cast("double") for s in TEAM_STATS}
    sums["top_teams_created_chances"] = _created_chances()
    teams = _team_totals(stats, sums).unpivot(["team"], list(sums), "table_name", "value")
    teams = teams.withColumn("player", F.lit(None).cast("string"))
    ranks = Window.partitionBy("table_name").orderBy(
        F.col("value").desc_nulls_last(), F.col("player").asc(), F.col("team").asc()
    )
    parts = [
        part.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= n)
        for part in (players, teams.select(*players.columns))
    ]
    return parts[0].unionByName(parts[1]).select("table_name", "rank", "player", "team", "value")


def leaderboard(long: DataFrame, name: str) -> DataFrame:
    """One table out of the long form, with its own columns."""
    stat = name.removeprefix("top_players_").removeprefix("top_teams_")
    value = F.col("value") if stat == "created_chances" else F.col("value").cast("long")
    who = ["player", "team"] if name.startswith("top_players_") else ["team"]
    return long.filter(F.col("table_name") == name).select("rank", *who, value.alias(stat))


def league_table(matches: DataFrame) -> DataFrame:
    """Standings from finished matches, best first."""
    stats = {
        "goals": ("home_goals", "away_goals"),
        "conceded": ("away_goals", "home_goals"),
        "points": ("home_points", "away_points"),
    }
    finished = matches.filter(
        F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()
    )

    def count(points: int) -> Column:
        return F.count(F.when(F.col("points") == points, 1))

    return (
        team_rows(finished, stats, keep=[])
        .groupBy("team")
        .agg(
            F.count(F.lit(1)).alias("played"),
            count(3).alias("won"),
            count(1).alias("drawn"),
            count(0).alias("lost"),
            F.sum("goals").alias("goals_for"),
            F.sum("conceded").alias("goals_against"),
            F.sum(F.col("goals") - F.col("conceded")).alias("goal_difference"),
            F.sum("points").alias("points"),
        )
        .orderBy(
            F.col("points").desc(), F.col("goal_difference").desc(),
            F.col("goals_for").desc(), F.col("team").asc(),
        )
    )
