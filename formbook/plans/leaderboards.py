"""Refresh of the eleven leaderboard tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from formbook.operators.leaderboard import leaderboard, leaderboard_tables, leaderboards_all
from formbook.sources.tables import read_tables, replace_table


def refresh_leaderboards(stats: DataFrame, root: str | None = None) -> list[str]:
    """Rank all tables in one job, then replace each from that small result."""
    long = replace_table(leaderboards_all(stats), "leaderboards_long", root)
    for name in leaderboard_tables():
        replace_table(leaderboard(long, name), name, root)
    return leaderboard_tables()


def analytics_snapshot(spark: SparkSession, names: list[str], root: str | None = None) -> DataFrame:
    """The saved tables in one long frame; a missing table adds no rows."""
    schemas = {}
    for name in names:
        stat = name.removeprefix("top_players_").removeprefix("top_teams_")
        value = T.DoubleType() if stat == "created_chances" else T.LongType()
        fields = [("rank", T.IntegerType()), ("player", T.StringType()), ("team", T.StringType()), (stat, value)]
        schemas[name] = T.StructType([T.StructField(*f) for f in fields])
    parts = []
    for name, df in read_tables(spark, schemas, root).items():
        stat = schemas[name].names[-1]
        player = F.col("player") if "player" in df.columns else F.lit(None).cast("string")
        parts.append(
            df.select(
                F.lit(name).alias("table_name"), "rank", player.alias("player"), "team",
                F.col(stat).cast("double").alias("value"),
            )
        )
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    return long
