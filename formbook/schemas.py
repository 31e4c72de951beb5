"""Column contracts, feature order, class labels and table schemas."""

from pyspark.sql import types as T

# --- Fixed values: these lists define the data contract and must not change. ---

REQUIRED_COLUMNS = [
    "date",
    "home_team",
    "away_team",
    "home_goals",
    "away_goals",
    "home_xg",
    "away_xg",
    "home_np_xg",
    "away_np_xg",
    "home_ppda",
    "away_ppda",
    "home_deep_completions",
    "away_deep_completions",
    "home_points",
    "away_points",
]

DROPPABLE_COLUMNS = [
    "league_id",
    "season_id",
    "game_id",
    "home_team_id",
    "away_team_id",
    "home_team_code",
    "away_team_code",
    "home_expected_points",
    "away_expected_points",
    "home_np_xg_difference",
    "away_np_xg_difference",
]

FEATURES = [
    "home_goals_avg_last5",
    "away_goals_avg_last5",
    "home_goals_conceded_avg_last5",
    "away_goals_conceded_avg_last5",
    "home_xg_avg_last5",
    "away_xg_avg_last5",
    "home_ppda_avg_last5",
    "away_ppda_avg_last5",
    "home_deep_completions_avg_last5",
    "away_deep_completions_avg_last5",
    "home_points_last5",
    "away_points_last5",
    "home_team_home_wins_last5",
    "home_team_home_draws_last5",
    "home_team_home_losses_last5",
    "away_team_away_wins_last5",
    "away_team_away_draws_last5",
    "away_team_away_losses_last5",
    "points_diff_last5",
    "goal_diff_avg5",
    "xg_diff_avg5",
    "x_defense_diff",
    "ppda_diff_avg5",
    "deep_comp_diff_avg5",
    "venue_wins_diff",
    "home_venue_advantage",
    "home_advantage",
]

RAW_STAT_COLUMNS = [
    "home_goals",
    "away_goals",
    "home_goals_conceded",
    "away_goals_conceded",
    "home_xg",
    "away_xg",
    "home_ppda",
    "away_ppda",
    "home_deep_completions",
    "away_deep_completions",
    "home_points",
    "away_points",
]

# Label index = position in this list (alphabetical order).
CLASSES = ["Draw", "Lose", "Win"]

# Display name -> source name.
TEAM_ALIASES = {
    "AFC Bournemouth": "Bournemouth",
    "Wolverhampton Wanderers": "Wolverhampton Wanderers",
    "Brighton & Hove Albion": "Brighton",
    "Tottenham Hotspur": "Tottenham",
    "Nottingham Forest": "Nottingham Forest",
    "Newcastle United": "Newcastle United",
    "Manchester United": "Manchester United",
    "Manchester City": "Manchester City",
    "West Ham United": "West Ham",
    "Aston Villa": "Aston Villa",
    "Crystal Palace": "Crystal Palace",
    "Leeds United": "Leeds",
    "Ipswich Town": "Ipswich",
    "Leicester City": "Leicester",
    "Sunderland": "Sunderland",
    "Burnley": "Burnley",
    "Brentford": "Brentford",
    "Fulham": "Fulham",
    "Chelsea": "Chelsea",
    "Arsenal": "Arsenal",
    "Liverpool": "Liverpool",
    "Everton": "Everton",
    "Southampton": "Southampton",
    "Sheffield United": "Sheffield United",
    "Luton Town": "Luton",
    "Nott'm Forest": "Nottingham Forest",
    "Wolves": "Wolverhampton Wanderers",
    "Spurs": "Tottenham",
}

PLAYER_STATS = ["goals", "assists", "shots", "key_passes", "yellow_cards", "red_cards"]
TEAM_STATS = ["goals", "shots", "yellow_cards", "red_cards"]

BASE_SEASON = 2023
SEARCH_DRAWS = 50
CV_FOLDS = 5
SEED = 42
TEST_WEEKS = 6
WINDOW = 5

# --- End of fixed values. ---

PLAYER_SCHEMA = T.StructType(
    [T.StructField("player", T.StringType()), T.StructField("team", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in PLAYER_STATS]
    + [T.StructField("xg_chain", T.DoubleType()), T.StructField("xg_buildup", T.DoubleType())]
)

FIXTURE_SCHEMA = T.StructType(
    [
        T.StructField("home_name", T.StringType()),
        T.StructField("away_name", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("match_date", T.StringType()),
        T.StructField("predicted_result", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("prob_draw", T.DoubleType()),
        T.StructField("prob_lose", T.DoubleType()),
        T.StructField("prob_win", T.DoubleType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("metric", T.DoubleType()),
        T.StructField("macro_f1", T.DoubleType()),
        T.StructField("as_of", T.TimestampNTZType()),
        T.StructField("test_from", T.TimestampNTZType()),
        T.StructField("artifact_path", T.StringType()),
    ]
)

VERSION_SCHEMA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("stage", T.StringType()),
        T.StructField("as_of", T.TimestampNTZType()),
    ]
)


class ContractError(ValueError):
    """A frame lacks a column its consumer needs."""
