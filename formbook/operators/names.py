"""Display name -> source name lookup."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from formbook.schemas import TEAM_ALIASES


def default_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(TEAM_ALIASES.items()), "display_name string, source_name string"
    )


def map_names(df: DataFrame, aliases: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Left-join the source name of each display-name column.

    ``columns``: display-name column -> new column. Unknown names give null.
    The alias table is small; Spark broadcasts it where its size allows.
    """
    for shown, new in columns.items():
        names = aliases.select(
            F.col("display_name").alias(f"_{shown}"), F.col("source_name").alias(new)
        )
        df = df.join(names, F.col(shown) == F.col(f"_{shown}"), "left").drop(f"_{shown}")
    return df


def map_fixtures(fixtures: DataFrame, aliases: DataFrame) -> DataFrame:
    """Fixtures with ``home_team`` and ``away_team`` in source names."""
    return map_names(fixtures, aliases, {"home_name": "home_team", "away_name": "away_team"})


def unmapped(mapped: DataFrame) -> DataFrame:
    """Fixtures with a name the alias table does not know."""
    return mapped.filter(F.col("home_team").isNull() | F.col("away_team").isNull())
