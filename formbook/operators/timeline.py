"""One match row <-> two team rows."""

from pyspark.sql import Column, DataFrame, Window, functions as F

SIDES = ("home", "away")

# stat -> (home team's value, away team's value), as column names of the match row
TEAM_STATS = {
    "goals": ("home_goals", "away_goals"),
    "goals_conceded": ("away_goals", "home_goals"),
    "xg": ("home_xg", "away_xg"),
    "ppda": ("home_ppda", "away_ppda"),
    "deep_completions": ("home_deep_completions", "away_deep_completions"),
    "points": ("home_points", "away_points"),
}


def team_rows(
    matches: DataFrame,
    stats: dict[str, tuple[str, str]] = TEAM_STATS,
    keep: list[str] | None = None,
    carry: bool = False,
) -> DataFrame:
    """Two rows per match: ``side``, ``team`` and the team's own view of each stat.

    With ``carry`` the home row also holds the whole match row in ``match``,
    so that ``match_rows`` can restore it without a join. One struct column is
    copied faster than its many fields.
    """
    keep = keep if keep is not None else ["match_id", "date"]
    both = F.array(
        *[
            F.struct(
                F.lit(side).alias("side"),
                F.col(f"{side}_team").alias("team"),
                *[F.col(pair[i]).alias(stat) for stat, pair in stats.items()],
            )
            for i, side in enumerate(SIDES)
        ]
    )
    rows = matches.select(*keep, F.struct(*matches.columns).alias("match"), F.explode(both).alias("t"))
    match = F.when(F.col("t.side") == "home", F.col("match")).alias("match")
    return rows.select(*keep, *([match] if carry else []), "t.*")


def match_rows(rows: DataFrame, names: dict[str, tuple[str, str]], part: list[str]) -> DataFrame:
    """Inverse of ``team_rows(carry=True)``.

    ``names`` maps a team-row column to its (home, away) names on the match row.
    A match has exactly two rows, so the window groups are of size two.
    """
    pair = Window.partitionBy(*part, "match_id").orderBy(F.col("side").desc())
    rows = rows.withColumns({f"away_{c}": F.lead(c).over(pair) for c in names})
    values: list[Column] = []
    for column, (home, away) in names.items():
        values += [F.col(column).alias(home), F.col(f"away_{column}").alias(away)]
    return rows.filter(F.col("side") == "home").select("match.*", *values)
