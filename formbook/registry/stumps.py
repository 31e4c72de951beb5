"""Oracle SQL (DuckDB) of the boosted stumps: SAMME with trees of one split on two features of three values.

Rows are counted per (features, class), and the rounds are written out one after the other. Every group of
(trial, fold) is a fit of its own.
"""

from collections.abc import Sequence

from formbook.ml.samme import SammeParams
from formbook.ml.tuning import SearchSpace
from formbook.registry.oracles import BASIC, MATCHES, _on_matches, _r
from formbook.schemas import CLASSES
from formbook.sources.views import GOAL_FEATURES

SPACE = SearchSpace(
    max_depth=(1, 2), min_samples_leaf=(1, 2), min_samples_split=(2, 3), max_features=(None,),
    n_estimators=(1, 6), learning_rate=(0.3, 1.0),
)
TRIALS, FOLDS = 3, 3
DRAWS: list[SammeParams] = SPACE.draw(TRIALS)
ROUNDS = max(p.n_estimators for p in DRAWS)
CUTOFF = "TIMESTAMP '2001-06-20'"  # six weeks before the queries' day


def _values(name: str, columns: str, rows: Sequence[str]) -> str:
    return f"{name} AS (SELECT * FROM (VALUES {', '.join(rows)}) AS v({columns}))"


BASE = [
    MATCHES,
    BASIC,
    """goals AS (
  SELECT match_id, date, least(home_goals, 2) AS x0, least(away_goals, 2) AS x1, date < """
    + CUTOFF
    + """ AS past,
    CASE result WHEN 'Draw' THEN 0 WHEN 'Lose' THEN 1 ELSE 2 END AS y
  FROM basic WHERE home_goals IS NOT NULL)""",
    _values(
        "draws", "trial, rounds, rate",
        [f"({i}, {p.n_estimators}, {p.learning_rate!r}::DOUBLE)" for i, p in enumerate(DRAWS)],
    ),
    _values("splits", "f, t", ["(0, 0.5)", "(0, 1.5)", "(1, 0.5)", "(1, 1.5)"]),
    _values("named", "c, label", [f"({i}, '{c}')" for i, c in enumerate(CLASSES)]),
]


def _below(f: str = "f", t: str = "t") -> str:
    return f"CASE {f} WHEN 0 THEN x0 ELSE x1 END <= {t}"


def _boosted(p: str) -> list[str]:
    """Relations from ``{p}cells`` (trial, fold, rounds, rate, x0, x1, y, n) to ``{p}trees``, one row per tree kept."""
    out = [
        f"""{p}w0 AS (SELECT *, CAST(1 AS DOUBLE) AS w, 1.0 / sum(n) OVER (PARTITION BY trial, fold, y) AS balance
          FROM {p}cells)"""
    ]
    for r in range(ROUNDS):
        out += [
            f"""{p}m{r} AS (SELECT trial, fold, f, t, {_below()} AS low, y, sum(n * w * balance) AS mass
              FROM {p}w{r}, splits GROUP BY ALL)""",
            f"""{p}s{r} AS (SELECT trial, fold, f, t, low, sum(mass) - sum(mass * mass) / sum(mass) AS impurity,
              arg_max(y, mass) AS label FROM {p}m{r} GROUP BY ALL)""",
            f"""{p}c{r} AS (SELECT trial, fold, f, t, sum(impurity) AS impurity, max(label) FILTER (low) AS lo,
              max(label) FILTER (NOT low) AS hi FROM {p}s{r} GROUP BY ALL)""",
            f"""{p}b{r} AS (SELECT * FROM {p}c{r}
              QUALIFY row_number() OVER (PARTITION BY trial, fold ORDER BY impurity, f, t) = 1)""",
            f"""{p}v{r} AS (SELECT w.*, CASE WHEN {_below()} THEN lo ELSE hi END AS vote
              FROM {p}w{r} w JOIN {p}b{r} USING (trial, fold))""",
            f"""{p}e{r} AS (SELECT trial, fold, any_value(rate) AS rate,
              coalesce(sum(n * w) FILTER (vote <> y), 0) / sum(n * w) AS error FROM {p}v{r} GROUP BY ALL)""",
            f"""{p}a{r} AS (SELECT trial, fold, {r} AS round, error, f, t, lo, hi,
              CASE WHEN error > 0 THEN rate * (ln((1 - error) / error) + ln(2)) ELSE 1 END AS alpha
              FROM {p}e{r} JOIN {p}b{r} USING (trial, fold) WHERE error < 2.0 / 3 - 1e-12)""",
            f"""{p}w{r + 1} AS (SELECT trial, fold, rounds, rate, x0, x1, y, n,
              w * CASE WHEN vote <> y THEN exp(alpha) ELSE 1 END AS w, balance
              FROM {p}v{r} JOIN {p}a{r} USING (trial, fold) WHERE rounds > {r + 1} AND error > 0)""",
        ]
    return [*out, f"{p}trees AS ({' UNION ALL '.join(f'SELECT * FROM {p}a{r}' for r in range(ROUNDS))})"]


def _judged(p: str) -> list[str]:
    """Relations from ``{p}asked`` (trial, fold, unseen, x0, x1, y, n) to ``{p}scores``, one row per fit and part."""
    return [
        f"""{p}points AS (SELECT trial, fold, x0, x1, c, label,
            sum(CASE WHEN CASE WHEN {_below()} THEN lo ELSE hi END = c THEN alpha ELSE -alpha / 2 END) / sum(alpha) AS score
          FROM {p}trees, (SELECT a.x0, b.x1 FROM range(3) a(x0), range(3) b(x1)), named GROUP BY ALL)""",
        f"""{p}chosen AS (SELECT trial, fold, x0, x1, arg_max(c, score) AS c, arg_max(label, score) AS predicted,
            max(score) FILTER (c = 0) AS s0, max(score) FILTER (c = 1) AS s1, max(score) FILTER (c = 2) AS s2
          FROM {p}points GROUP BY ALL)""",
        f"""{p}outcomes AS (SELECT trial, fold, unseen, k.c AS class, sum(n) FILTER (y = k.c AND a.c = k.c) AS hits,
            coalesce(sum(n) FILTER (a.c = k.c), 0) AS predicted, coalesce(sum(n) FILTER (y = k.c), 0) AS support
          FROM {p}asked JOIN {p}chosen a USING (trial, fold, x0, x1), named k GROUP BY ALL)""",
        f"""{p}rates AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0.0) AS p, coalesce(hits / nullif(support, 0), 0.0) AS r,
            coalesce(2.0 * hits / nullif(predicted + support, 0), 0.0) AS f1 FROM {p}outcomes)""",
        f"""{p}scores AS (SELECT trial, fold, unseen, sum(hits) / sum(support) AS accuracy,
            sum(p * support) / sum(support) AS precision, sum(r * support) / sum(support) AS recall,
            sum(f1 * support) / sum(support) AS f1_score, avg(f1) FILTER (predicted + support > 0) AS macro_f1
          FROM {p}rates GROUP BY ALL)""",
    ]


SEARCH = [
    *BASE,
    f"""placed AS (SELECT *, row_number() OVER (ORDER BY date, match_id) - 1 AS position, count(*) OVER () AS total,
      count(*) OVER () // {FOLDS + 1} AS size FROM goals WHERE past)""",
    f"""folded AS (SELECT *, CASE WHEN position < total - {FOLDS} * size THEN 0
      ELSE (position - (total - {FOLDS} * size)) // size + 1 END AS block FROM placed)""",
    f"folds AS (SELECT unnest(range(1, {FOLDS + 1})) AS fold)",
    """cv_cells AS (SELECT trial, fold, rounds, rate, x0, x1, y, count(*) AS n
      FROM folded JOIN folds ON block < fold, draws GROUP BY ALL)""",
    *_boosted("cv_"),
    """cv_asked AS (SELECT trial, fold, block = fold AS unseen, x0, x1, y, count(*) AS n
      FROM folded JOIN folds ON block <= fold, draws GROUP BY ALL)""",
    *_judged("cv_"),
    """tried AS (SELECT trial, fold, max(macro_f1) FILTER (NOT unseen) AS train_macro_f1,
      max(macro_f1) FILTER (unseen) AS test_macro_f1, max(accuracy) FILTER (unseen) AS test_accuracy
      FROM draws CROSS JOIN folds LEFT JOIN cv_scores USING (trial, fold) GROUP BY ALL)""",
    """ranked AS (SELECT trial, avg(train_macro_f1) AS train_score, avg(test_macro_f1) AS test_score,
      stddev_pop(test_macro_f1) AS spread, avg(test_accuracy) AS accuracy FROM tried GROUP BY trial)""",
]
FIT = [
    *SEARCH,
    "best AS (SELECT trial FROM ranked ORDER BY test_score DESC, trial LIMIT 1)",
    """fit_cells AS (SELECT trial, 0 AS fold, rounds, rate, x0, x1, y, count(*) AS n
      FROM goals, draws JOIN best USING (trial) WHERE past GROUP BY ALL)""",
    *_boosted("fit_"),
    """fit_asked AS (SELECT trial, 0 AS fold, TRUE AS unseen, x0, x1, y, count(*) AS n
      FROM goals, best WHERE NOT past GROUP BY ALL)""",
    *_judged("fit_"),
]
DRAWN = """CAST(rounds AS INTEGER) AS n_estimators, round(rate, 6) + 0.0 AS learning_rate, CAST(1 AS INTEGER) AS max_depth,
  CAST(1 AS INTEGER) AS min_samples_leaf, CAST(2 AS INTEGER) AS min_samples_split, CAST(NULL AS VARCHAR) AS max_features"""
FEATURE = f"{GOAL_FEATURES}[f + 1]"


def _sql(relations: list[str], body: str) -> str:
    return f"WITH {', '.join(relations)} {body}"


def _share(c: int) -> str:
    return f"exp(s{c} / 2) / (exp(s0 / 2) + exp(s1 / 2) + exp(s2 / 2))"


PARAMS = {
    "model_name": "'match_result'",
    "n_estimators": "CAST(rounds AS VARCHAR)",
    "learning_rate": "CASE trial " + " ".join(f"WHEN {i} THEN '{p.learning_rate!r}'" for i, p in enumerate(DRAWS)) + " END",
    "max_depth": "'1'",
    "min_samples_leaf": "'1'",
    "min_samples_split": "'2'",
    "max_features": "'None'",
    "seed": f"'{DRAWS[0].seed}'",
    "rounds_kept": "CAST((SELECT count(*) FROM fit_trees) AS VARCHAR)",
    "algorithm": "'SAMME'",
    "scoring": "'f1_macro'",
    "label_classes": f"'{','.join(CLASSES)}'",
    "input_features": f"'{','.join(GOAL_FEATURES)}'",
    "n_iter_search": f"'{TRIALS}'",
    "cv_folds": f"'{FOLDS}'",
    "test_size_weeks": "'6'",
    "test_from": "'2001-06-20 00:00:00'",
}

STUMP_ORACLES: dict[str, str] = {
    "stump_rows": _on_matches(
        f"SELECT match_id, date, {CLASSES}[y + 1] AS result, x0::DOUBLE AS home_scored, x1::DOUBLE AS away_scored FROM goals",
        *BASE[1:3],
    ),
    "stump_cv_scores": _sql(
        SEARCH,
        f"""SELECT CAST(trial AS INTEGER) AS trial, CAST(fold AS INTEGER) AS fold, {DRAWN}, {_r('train_macro_f1')},
        {_r('test_macro_f1')}, {_r('test_accuracy')} FROM tried JOIN draws USING (trial)""",
    ),
    "stump_search_trials": _sql(
        SEARCH,
        f"""SELECT CAST(trial AS INTEGER) AS trial, {DRAWN}, {_r('train_score', 'mean_train_score')}, {_r('test_score', 'mean_test_score')},
        {_r('spread', 'std_test_score')}, {_r('accuracy', 'mean_test_accuracy')} FROM ranked JOIN draws USING (trial)""",
    ),
    "stump_rounds": _sql(
        FIT,
        f"""SELECT CAST(round AS INTEGER) AS round, CASE WHEN lo <> hi THEN {FEATURE} END AS feature,
        CASE WHEN lo <> hi THEN t::DOUBLE END AS threshold, {_r('error')}, {_r('alpha')} FROM fit_trees""",
    ),
    "stump_importances": _sql(
        FIT,
        f"""SELECT feature, round(coalesce(sum(alpha) FILTER (lo <> hi AND {FEATURE} = feature), 0) / sum(alpha), 6) + 0.0 AS importance
        FROM fit_trees, (SELECT unnest({GOAL_FEATURES}) AS feature) GROUP BY feature""",
    ),
    "stump_evaluation": _sql(
        FIT, f"SELECT {', '.join(_r(c) for c in ('accuracy', 'precision', 'recall', 'f1_score', 'macro_f1'))} FROM fit_scores"
    ),
    "stump_predictions": _sql(
        FIT,
        f"""SELECT match_id, {CLASSES}[y + 1] AS result, predicted AS predicted_label,
        {', '.join(_r(_share(i), f'prob_{c.lower()}') for i, c in enumerate(CLASSES))}
        FROM goals JOIN fit_chosen USING (x0, x1) WHERE NOT past""",
    ),
    "stump_params": _sql(
        FIT,
        " UNION ALL ".join(f"SELECT '{n}' AS name, {v} AS value FROM draws JOIN best USING (trial)" for n, v in PARAMS.items()),
    ),
}
