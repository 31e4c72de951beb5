"""Match rows for tests."""

import datetime as dt

MATCH_SCHEMA = (
    "match_id long, date timestamp_ntz, home_team string, away_team string, home_goals long, away_goals long, "
    "home_xg double, away_xg double, home_np_xg double, away_np_xg double, home_ppda double, away_ppda double, "
    "home_deep_completions long, away_deep_completions long, home_points long, away_points long"
)
START = dt.datetime(2000, 1, 1)


def match(match_id, home, away, home_goals, away_goals, day=None, xg=1.0):
    """A match row; all other statistics equal ``xg``."""
    if home_goals is None or away_goals is None:
        points = (None, None)
    else:
        points = {1: (3, 0), 0: (1, 1), -1: (0, 3)}[(home_goals > away_goals) - (home_goals < away_goals)]
    date = START + dt.timedelta(days=match_id if day is None else day)
    return (match_id, date, home, away, home_goals, away_goals, xg, xg, xg, xg, xg, xg, 1, 1, *points)
