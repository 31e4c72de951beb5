"""The five-stage form-feature pipeline.

Stages cascade: each trailing window runs over the matches that survived the
stage before. ``mode="single_pass"`` computes all windows over all matches.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from formbook.functions.columns import flag, require, result_of
from formbook.operators.chunks import ROWS_PER_CHUNK, TimeChunks, time_chunks
from formbook.operators.quality import audit_lines, observed
from formbook.operators.timeline import match_rows, team_rows
from formbook.operators.trailing import full_sum, history_rows, match_order, part_keys
from formbook.schemas import REQUIRED_COLUMNS, WINDOW
from formbook.session import cut


@dataclass(frozen=True)
class Form:
    """A trailing aggregate over team rows."""

    keys: list[str]
    stats: dict[str, tuple[str, str]]
    derive: dict[str, Column]  # window input per output, from the stats
    mean: bool  # mean of the window rather than sum
    names: dict[str, tuple[str, str]]  # output -> (home name, away name)
    needed: list[str] = field(default_factory=list)  # null in any of these drops the match


_AVERAGED = ["goals", "goals_conceded", "xg", "ppda", "deep_completions"]


def rolling_spec() -> Form:
    names = {f"{s}_avg_last5": (f"home_{s}_avg_last5", f"away_{s}_avg_last5") for s in _AVERAGED}
    return Form(
        keys=["team"],
        stats={s: (f"home_{s}", f"away_{s}") for s in _AVERAGED},
        derive={f"{s}_avg_last5": F.col(s) for s in _AVERAGED},
        mean=True,
        names=names,
        needed=[n for pair in names.values() for n in pair],
    )


def points_spec() -> Form:
    names = {"points_last5": ("home_points_last5", "away_points_last5")}
    return Form(
        keys=["team"],
        stats={"points": ("home_points", "away_points")},
        derive={"points_last5": F.col("points")},
        mean=False,
        names=names,
        needed=list(names["points_last5"]),
    )


def venue_spec() -> Form:
    scored, let_in = F.col("scored"), F.col("let_in")
    return Form(
        keys=["side", "team"],
        stats={"scored": ("home_goals", "away_goals"), "let_in": ("away_goals", "home_goals")},
        derive={
            "wins": flag(scored > let_in),
            "draws": flag(scored == let_in),
            "losses": flag(scored < let_in),
        },
        mean=False,
        names={
            n: (f"home_team_home_{n}_last5", f"away_team_away_{n}_last5")
            for n in ("wins", "draws", "losses")
        },
        needed=["home_team_home_wins_last5", "away_team_away_wins_last5"],
    )


def trailing(rows: DataFrame, form: Form, source: DataFrame | None = None) -> DataFrame:
    """Add the outputs of ``form`` to team rows.

    Rows cut into chunks come hashed on the chunk, and ``source`` holds the
    same rows before that shuffle; history is reduced there first. Both parts
    of the union are then hashed alike, so it needs no further shuffle.
    """
    inputs = {f"_{out}": value for out, value in form.derive.items()}
    rows = rows.withColumns(inputs)
    part = part_keys(rows)
    if part:
        past = history_rows(source.withColumns(inputs), form.keys, list(inputs)).repartition("chunk")
        rows = rows.withColumn("is_history", F.lit(False)).unionByName(
            past.withColumn("is_history", F.lit(True)), allowMissingColumns=True
        )
    window = (
        Window.partitionBy(*part, *form.keys).orderBy(*match_order()).rowsBetween(-WINDOW, -1)
    )
    rows = rows.withColumns({out: full_sum(f"_{out}", window) for out in form.derive})
    if form.mean:
        rows = rows.withColumns({out: F.col(out) / WINDOW for out in form.derive})
    if part:
        rows = rows.filter(~F.col("is_history")).drop("is_history")
    return rows.drop(*inputs)


def add_form(matches: DataFrame, *forms: Form) -> DataFrame:
    """Both teams' trailing form on the match row; no row is dropped.

    With a ``chunk`` column, the one shuffle is by chunk: it serves the windows
    of all teams and brings a match's two rows together again.
    """
    part = part_keys(matches)
    stats = {s: pair for form in forms for s, pair in form.stats.items()}

    def split(df: DataFrame) -> DataFrame:
        return team_rows(df, stats, keep=[*part, "match_id", "date"], carry=True)

    rows = split(matches.repartition(*part)) if part else split(matches)
    for form in forms:
        rows = trailing(rows, form, split(matches) if part else None)
    return match_rows(rows, {o: n for form in forms for o, n in form.names.items()}, part)


def basic_features(matches: DataFrame) -> DataFrame:
    """Result label and goals conceded."""
    require(matches, ["match_id", *REQUIRED_COLUMNS], "matches")
    return matches.withColumns(
        {
            "result": result_of(F.col("home_goals"), F.col("away_goals")),
            "home_goals_conceded": F.col("away_goals"),
            "away_goals_conceded": F.col("home_goals"),
        }
    )


def _venue_advantage(df: DataFrame) -> DataFrame:
    home = F.col("home_team_home_wins_last5") / WINDOW
    away = F.col("away_team_away_wins_last5") / WINDOW
    return df.withColumn("home_venue_advantage", home - away)


def difference_features(df: DataFrame) -> DataFrame:
    """Home minus away of each form feature (away minus home for defence)."""
    pairs = {
        "points_diff_last5": ("home_points_last5", "away_points_last5"),
        "goal_diff_avg5": ("home_goals_avg_last5", "away_goals_avg_last5"),
        "xg_diff_avg5": ("home_xg_avg_last5", "away_xg_avg_last5"),
        "x_defense_diff": ("away_goals_conceded_avg_last5", "home_goals_conceded_avg_last5"),
        "ppda_diff_avg5": ("home_ppda_avg_last5", "away_ppda_avg_last5"),
        "deep_comp_diff_avg5": ("home_deep_completions_avg_last5", "away_deep_completions_avg_last5"),
        "venue_wins_diff": ("home_team_home_wins_last5", "away_team_away_wins_last5"),
    }
    df = df.withColumns({name: F.col(a) - F.col(b) for name, (a, b) in pairs.items()})
    return df.withColumn("home_advantage", F.lit(1))


STAGES = {
    "feature_engineering": "no rows dropped",
    "rolling_averages": "a team lacks five earlier matches",
    "points_last5": "a team lacks five earlier surviving matches",
    "venue_form_rolling": "a team lacks five earlier matches at the venue",
    "derived_features": "no rows dropped",
}


def feature_stages(
    matches: DataFrame,
    mode: str = "cascaded",
    rows_per_chunk: int = ROWS_PER_CHUNK,
    chunks: TimeChunks | None = None,
    seen: dict[str, Observation] | None = None,
) -> dict[str, DataFrame]:
    """Match rows after each stage, by stage name; ``seen`` counts the rows of the stages it names as they pass.

    Tables of more than ``rows_per_chunk`` matches are cut into time chunks;
    what a further stage reads is then checkpointed, since it is read twice.
    """
    if mode not in ("cascaded", "single_pass"):
        raise ValueError(f"unknown mode {mode!r}")
    chunks = chunks if chunks is not None else time_chunks(matches, rows_per_chunk)
    forms = {
        "rolling_averages": rolling_spec(),
        "points_last5": points_spec(),
        "venue_form_rolling": venue_spec(),
    }
    last = "venue_form_rolling"
    df = basic_features(matches)
    if chunks:
        df = chunks.assign(df)
    stages = {"feature_engineering": df}
    if mode == "single_pass":
        for group in [[f] for f in forms.values()] if chunks else [list(forms.values())]:
            df = add_form(df, *group)
            df = cut(df) if chunks and group != [forms[last]] else df
    for name, form in forms.items():
        if mode == "cascaded":
            df = add_form(df, form)
        df = df.dropna(subset=form.needed)
        if seen and name in seen:
            df = df.observe(seen[name], F.count(F.lit(1)).alias("rows"))
        if mode == "cascaded" and chunks and name != last:
            df = cut(df)
        stages[name] = df
    df = difference_features(_venue_advantage(df))
    stages["derived_features"] = df
    if chunks:
        stages = {name: stage.drop("chunk") for name, stage in stages.items()}
    return stages


def match_features(matches: DataFrame, mode: str = "cascaded", **options) -> DataFrame:
    """Matches with full form on both sides, plus the 27 model features."""
    return feature_stages(matches, mode, **options)["derived_features"]


def audited_features(
    matches: DataFrame, mode: str = "cascaded", rows_per_chunk: int = ROWS_PER_CHUNK
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The features, and what tells their row audit once an action on them has run.

    Rows are counted while the features are computed, without a scan of their own: each stage is read once, or written
    to a checkpoint where it is counted. A task repeated because its output was lost counts again.
    """
    chunks = time_chunks(matches, rows_per_chunk)
    seen = {name: Observation() for name in ("rolling_averages", "points_last5", "venue_form_rolling")}
    features = feature_stages(matches, mode, chunks=chunks, seen=seen)["derived_features"]

    def audit() -> DataFrame:
        counts = [("", chunks.rows), ("feature_engineering", chunks.rows)]
        counts += [(name, observed(observation)) for name, observation in seen.items()]
        return audit_lines(matches.sparkSession, [*counts, ("derived_features", counts[-1][1])], STAGES)

    return features, audit
