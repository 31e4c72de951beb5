"""Match, player and fixture views over the order and event tables.

These give every operator an input of the right shape and of any size.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from formbook.functions.columns import result_of
from formbook.functions.season import season_start
from formbook.operators.fixtures import with_match_key
from formbook.operators.names import map_fixtures
from formbook.schemas import CLASSES, FEATURES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _team(number: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad((number % 20).cast("string"), 2, "0"))


def _nation(number: Column) -> Column:
    return F.concat(F.lit("NATION_"), (number % 25).cast("string"))


def _kickoff() -> Column:
    """Order date plus one millisecond per order key: unique per team."""
    return F.expr("timestampadd(MILLISECOND, o_orderkey, o_orderdate)")


def matches(spark: SparkSession, folder: str) -> DataFrame:
    """One match per order; its line items give the statistics."""
    odd = F.col("l_linenumber") % 2 == 1

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    def total(condition: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0.0))

    def mean(condition: Column, column: str) -> Column:
        return F.coalesce(F.avg(F.when(condition, F.col(column))), F.lit(0.0))

    stats = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            count(F.col("l_returnflag") == "R").alias("home_goals"),
            count(F.col("l_returnflag") == "A").alias("away_goals"),
            total(odd, "l_discount").alias("home_xg"),
            total(~odd, "l_discount").alias("away_xg"),
            total(odd, "l_tax").alias("home_np_xg"),
            total(~odd, "l_tax").alias("away_np_xg"),
            mean(odd, "l_quantity").alias("home_ppda"),
            mean(~odd, "l_quantity").alias("away_ppda"),
            count(odd).alias("home_deep_completions"),
            count(~odd).alias("away_deep_completions"),
        )
    )
    home, away = F.col("home_goals"), F.col("away_goals")

    def points(own: Column, other: Column) -> Column:
        return F.when(own > other, 3).when(own == other, 1).when(own < other, 0).cast("long")

    cust, key = F.col("o_custkey"), F.col("o_orderkey")
    orders = table(spark, folder, "orders")
    return orders.join(stats, key == F.col("l_orderkey"), "left").select(
        key.alias("match_id"),
        _kickoff().alias("date"),
        _team(cust).alias("home_team"),
        _team(cust % 20 + 1 + key % 19).alias("away_team"),
        *[c for c in stats.columns if c != "l_orderkey"],
        points(home, away).alias("home_points"),
        points(away, home).alias("away_points"),
        season_start(F.col("o_orderdate")).alias("season"),
        F.when(home.isNull(), "SCHEDULED").otherwise("FINISHED").alias("status"),
        (key % 38 + 1).cast("int").alias("matchday"),
    )


def player_stats(spark: SparkSession, folder: str) -> DataFrame:
    """One player per event user."""
    kind = F.col("event_type")

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            count(kind == "purchase").alias("goals"),
            count(kind == "signup").alias("assists"),
            count(kind == "click").alias("shots"),
            count(kind == "view").alias("key_passes"),
            count(kind == "error").alias("yellow_cards"),
            count(F.col("value") > 40).alias("red_cards"),
            F.sum(F.when(kind == "click", F.col("value"))).alias("xg_chain"),
            F.sum(F.when(kind == "view", F.col("value"))).alias("xg_buildup"),
        )
        .withColumn("player", F.concat(F.lit("P"), F.col("user_id").cast("string")))
        .withColumn("team", _team(F.col("user_id")))
        .select("player", "team", "goals", "assists", "shots", "key_passes",
                "yellow_cards", "red_cards", "xg_chain", "xg_buildup")
    )


def schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a fixture between two nations."""
    cust, key = F.col("o_custkey"), F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias("fixture_id"),
        _nation(cust).alias("home_name"),
        _nation(cust % 25 + 1 + key % 24).alias("away_name"),
        _kickoff().alias("date"),
    )


def aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Display name -> team for the first twenty nations; the rest stay unmapped."""
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").filter(key < 20).select(
        F.col("n_name").alias("display_name"), _team(key).alias("source_name")
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as labelled predictions, one learner at chance and one better."""
    line = F.col("l_linenumber")

    def label(code: Column) -> Column:
        return F.when(code == "A", "Draw").when(code == "N", "Lose").otherwise("Win")

    code = F.col("l_returnflag")
    guess = F.when(line % 3 == 0, "A").when(line % 3 == 1, "N").otherwise("R")
    return table(spark, folder, "lineitem").select(
        label(code).alias("y_true"),
        label(guess).alias("y_pred"),
        label(F.when(line == 1, "A").otherwise(code)).alias("y_pred_weak"),
        F.col("l_quantity").alias("w"),
    )


def model_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as training runs, priorities as experiments."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("experiment"),
        key.alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING").alias("status"),
        F.col("o_totalprice").alias("metric"),
        F.col("o_orderdate").alias("started"),
        F.when(key % 7 == 0, "Production").when(key % 7 == 1, "Staging").alias("stage"),
        key.alias("version"),
    )


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("published"), "lang", "source", "text"
    )


def scored_fixtures(spark: SparkSession, folder: str) -> DataFrame:
    """Every fixture as a scored game: class probabilities in sixteenths, a status by its teams and key."""
    key = F.col("fixture_id")
    games = map_fixtures(with_match_key(schedule(spark, folder)), aliases(spark, folder))
    draw, lose = key % 7 + 1, F.floor(key / 7) % 7 + 1
    chances = F.array(*[(x / 16).cast("double") for x in (draw, lose, 16 - draw - lose)])
    unmapped = F.col("home_team").isNull() | F.col("away_team").isNull()
    best = F.array_position("probabilities", F.array_max("probabilities"))
    return games.select(
        "*",
        chances.alias("probabilities"),
        F.when(unmapped, "SKIPPED").when(key % 9 == 0, "ERROR").otherwise("OK").alias("status"),
    ).withColumn("predicted_label", F.element_at(F.array(*map(F.lit, CLASSES)), best.cast("int")))


def importances(spark: SparkSession, folder: str) -> DataFrame:
    """A feature's importance is its share of the line items, dealt to the features by key."""
    items = table(spark, folder, "lineitem").groupBy((F.col("l_orderkey") % len(FEATURES)).cast("int").alias("position")).count()
    total = items.agg(F.sum("count")).scalar()
    names = F.array(*map(F.lit, FEATURES))
    return items.select(
        "position", F.get(names, "position").alias("feature"), (F.col("count") / total).alias("importance")
    )


def trial_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as scores of sixty search trials in five folds; trial 7 could not be fitted in one."""
    trial, fold = (F.col("o_custkey") % 60).cast("int"), (F.col("o_orderkey") % 5 + 1).cast("int")
    score = F.avg("o_totalprice") / 1_000_000
    known = F.when((F.col("trial") != 7) | (F.col("fold") != 3), F.col("score"))
    rows = table(spark, folder, "orders").groupBy(trial.alias("trial"), fold.alias("fold")).agg(score.alias("score"))
    return rows.select(
        "trial",
        "fold",
        (100 + F.col("trial")).alias("n_estimators"),
        (F.col("trial") / 128).alias("learning_rate"),
        (2 + F.col("trial") % 8).alias("max_depth"),
        (1 + F.col("trial") % 19).alias("min_samples_leaf"),
        (2 + F.col("trial") % 18).alias("min_samples_split"),
        F.when(F.col("trial") % 2 == 0, "sqrt").alias("max_features"),
        (known + 0.01).alias("train_macro_f1"),
        known.alias("test_macro_f1"),
        (known + F.col("trial") % 3 * 0.03).alias("test_accuracy"),
    )


#: Features of ``goal_rows``, each of three values.
GOAL_FEATURES = ["home_scored", "away_scored"]


def goal_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Played matches with their result and each side's goals, two and more as one.

    Trees of one split on these can be followed by hand, and in SQL.
    """
    played = matches(spark, folder).filter(F.col("home_goals").isNotNull())
    capped = [F.least(f"{side}_goals", F.lit(2)).cast("double").alias(f"{side}_scored") for side in ("home", "away")]
    return played.select("match_id", "date", result_of(F.col("home_goals"), F.col("away_goals")).alias("result"), *capped)
