"""Team form at a point in time: latest rows, and strictly before a fixture."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from formbook.functions.columns import flag
from formbook.operators.chunks import ROWS_PER_CHUNK, time_chunks
from formbook.operators.timeline import team_rows
from formbook.operators.trailing import full_sum, history_rows, match_order, part_keys
from formbook.schemas import WINDOW
from formbook.session import staged

TIMELINE = ["match_id", "date", "side", "team", "goals", "goals_conceded", "xg", "ppda", "deep_completions", "points", "old", "known"]
AVERAGED = ["goals", "goals_conceded", "xg", "ppda", "deep_completions"]


def last_rows(matches: DataFrame, side: str | None = None, n: int = WINDOW) -> DataFrame:
    """Newest ``n`` team rows per team: all, or only at home or away.

    ``recency`` counts from the newest row. The limit is applied before the
    shuffle as well, so a team sends ``n`` rows per task, however many it has.
    """
    rows = team_rows(matches)
    if side:
        rows = rows.filter(F.col("side") == side)
    newest = Window.partitionBy("team").orderBy(
        F.col("date").desc_nulls_first(), F.col("match_id").desc()
    )
    rows = rows.filter(F.col("team").isNotNull())
    return rows.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= n)


def team_form_latest(matches: DataFrame) -> DataFrame:
    """Averages (4 places) and points over each team's newest 1 to 5 rows."""
    return (
        last_rows(matches)
        .groupBy("team")
        .agg(
            F.count(F.lit(1)).alias("matches_used"),
            *[F.round(F.avg(s), 4).alias(f"{s}_avg") for s in AVERAGED],
            F.coalesce(F.sum("points"), F.lit(0)).alias("points_sum"),
        )
    )


def venue_form_latest(matches: DataFrame) -> DataFrame:
    """Wins, draws and losses of each team's newest 1 to 5 rows at each venue."""

    def count(points: int) -> Column:
        return F.count(F.when(F.col("points") == points, 1))

    wins, used = count(3), F.greatest(F.count(F.lit(1)), F.lit(1))
    return (
        last_rows(matches, "home")
        .unionByName(last_rows(matches, "away"))
        .groupBy("side", "team")
        .agg(
            F.count(F.lit(1)).alias("matches_used"),
            wins.alias("wins"),
            count(1).alias("draws"),
            count(0).alias("losses"),
            F.round(wins / used, 4).alias("win_rate"),
        )
    )


def form_of_teams(matches: DataFrame) -> DataFrame:
    """One row per team: averages and points of its newest five rows, results of its newest five at each venue.

    The newest five at either venue hold the newest five overall, so one pass ranks both: the first limit works before
    the shuffle, and ten rows a team are left for the second. Null where a team has no row at a venue.
    """
    order = F.col("date").desc_nulls_first(), F.col("match_id").desc()
    rows = team_rows(matches).filter(F.col("team").isNotNull())
    at_venue = F.row_number().over(Window.partitionBy("team", "side").orderBy(*order))
    rows = rows.withColumn("_at_venue", at_venue).filter(F.col("_at_venue") <= WINDOW)
    recent = F.row_number().over(Window.partitionBy("team").orderBy(*order)) <= WINDOW
    rows = rows.withColumn("_recent", recent)

    def overall(stat: str) -> Column:
        return F.when(F.col("_recent"), F.col(stat))

    def venue(side: str) -> list[Column]:
        here = F.col("side") == side
        used = F.count(F.when(here, 1))

        def count(points: int) -> Column:
            return F.count(F.when(here & (F.col("points") == points), 1))

        found = {"wins": count(3), "draws": count(1), "losses": count(0), "win_rate": F.round(count(3) / F.greatest(used, F.lit(1)), 4)}
        return [F.when(used > 0, value).alias(f"{side}_{name}") for name, value in found.items()]

    return rows.groupBy("team").agg(
        *[F.round(F.avg(overall(s)), 4).alias(f"{s}_avg") for s in AVERAGED],
        F.coalesce(F.sum(overall("points")), F.lit(0)).alias("points_sum"),
        *venue("home"),
        *venue("away"),
    )


def _lines(matches: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Matches and fixtures on one team timeline; ``known`` marks the matches.

    Matches older than every fixture matter only as the newest five per team
    and side, and that limit is applied before the shuffle.
    """
    span = fixtures.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last"))).scalar()
    first, last = span["first"], span["last"]
    rows = team_rows(matches.filter(F.col("date") < last))
    newest = Window.partitionBy("team", "side").orderBy(F.col("date").desc(), F.col("match_id").desc())
    old = (
        rows.filter(F.col("date") < first)
        .withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") <= WINDOW)
        .drop("_age")
        .withColumn("old", F.lit(True))
    )
    recent = rows.filter(F.col("date") >= first).withColumn("old", F.lit(False))
    matched = old.unionByName(recent).withColumn("known", F.lit(True))
    places = [F.struct(F.lit(s).alias("side"), F.col(f"{s}_team").alias("team")) for s in ("home", "away")]
    asked = fixtures.select(
        F.col("fixture_id").alias("match_id"), "date", F.explode(F.array(*places)).alias("t")
    ).select("match_id", "date", "t.*", F.lit(False).alias("old"), F.lit(False).alias("known"))
    return matched.unionByName(asked, allowMissingColumns=True)


def form_before(
    matches: DataFrame, fixtures: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Form of both teams from their last five matches strictly before each fixture.

    ``fixtures``: ``fixture_id, date, home_team, away_team`` (source names).
    Returns one row per fixture and side: matches found, averages, points and
    venue results; null unless all five exist with known values. No pair of
    fixture and match is formed: both lie on one timeline, and each fixture
    takes over the newest state before it. A timeline of more than one chunk is written once, when this is called, and all
    later steps read only that: what is old comes as five rows per team and side, so its size follows the fixtures and the matches among them.
    """
    stats = [*AVERAGED, "points"]
    lines = _lines(matches, fixtures).select(*TIMELINE)
    # Rows older than every fixture are few per team; only the others can crowd a task.
    cuts = time_chunks(lines.filter(~F.col("old")), rows_per_chunk, late="known")
    known = F.col("known")
    if cuts:
        by = ["chunk", "team"]
        lines = staged(cuts.assign(lines), "timeline")
        # Overall form needs the history of both sides wherever a team appears.
        sides = F.explode(F.array(F.lit("home"), F.lit("away"))).alias("side")
        starts = lines.select("chunk", "team").distinct().select("chunk", "team", sides)
        history = history_rows(lines.filter(known), ["team", "side"], ["known", *stats], starts)
        lines = lines.repartition(*by).unionByName(history.repartition(*by), allowMissingColumns=True)
    else:
        lines = lines.repartition("team")
    part = part_keys(lines)
    scored, let_in = F.col("goals"), F.col("goals_conceded")
    lines = lines.withColumns({"win": flag(scored > let_in), "draw": flag(scored == let_in)})

    def newest_five(*keys: str):
        """The newest five matches up to and including this one."""
        return Window.partitionBy(*part, *keys, "known").orderBy(*match_order()).rowsBetween(1 - WINDOW, 0)

    def last_state(column: str, *keys: str) -> Column:
        """State after the newest match before this row; at one instant, fixtures come first."""
        sofar = (
            Window.partitionBy(*part, *keys)
            .orderBy(F.col("date").asc_nulls_last(), known.asc(), F.col("match_id"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return F.last(column, ignorenulls=True).over(sofar)

    overall, venue = newest_five("team"), newest_five("team", "side")
    lines = lines.withColumns(
        {
            "found": F.count(F.lit(1)).over(overall),
            **{f"sum_{s}": full_sum(s, overall) for s in stats},
            "found_at_venue": F.count(F.lit(1)).over(venue),
            "wins": full_sum("win", venue),
            "draws": full_sum("draw", venue),
        }
    )
    state = F.struct("found", *[f"sum_{s}" for s in stats])
    at_venue = F.struct("found_at_venue", "wins", "draws")
    lines = lines.select(
        *part, "match_id", "date", "side", "team", "known",
        F.when(known, state).alias("state"), F.when(known, at_venue).alias("at_venue"),
    )
    lines = lines.withColumns(
        {"state": last_state("state", "team"), "at_venue": last_state("at_venue", "team", "side")}
    )
    wins, draws = F.col("at_venue.wins"), F.col("at_venue.draws")
    return lines.filter(~known).select(
        F.col("match_id").alias("fixture_id"), "side", "team", "date",
        F.coalesce("state.found", F.lit(0)).alias("found"),
        F.coalesce("at_venue.found_at_venue", F.lit(0)).alias("found_at_venue"),
        *[(F.col(f"state.sum_{s}") / WINDOW).alias(f"{s}_avg") for s in AVERAGED],
        F.col("state.sum_points").cast("double").alias("points_sum"),
        wins.alias("wins"),
        draws.alias("draws"),
        (WINDOW - wins - draws).alias("losses"),
    )
