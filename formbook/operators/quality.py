"""Audits, quality checks and the retrain gate."""

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from formbook.functions.season import ntz
from formbook.schemas import REQUIRED_COLUMNS


AUDIT_SCHEMA = (
    "step int, name string, before long, after long, dropped long, retained_pct double, note string"
)


def audit_lines(spark: SparkSession, counts: list[tuple[str, int]], notes: dict[str, str]) -> DataFrame:
    """Rows before and after each step, with what was dropped and kept overall; ``counts`` begins with the input's."""
    start = counts[0][1]
    lines = [
        (i, name, before, after, before - after, round(100.0 * after / start, 2) if start else None, notes.get(name, ""))
        for i, ((_, before), (name, after)) in enumerate(zip(counts, counts[1:]), 1)
    ]
    return spark.createDataFrame(lines, AUDIT_SCHEMA)


def observed(observation: Observation) -> int:
    """Rows that passed an observed point; none if Spark knew beforehand that there are none."""
    try:
        return observation.get["rows"]
    except Py4JJavaError:
        return 0


def column_contract(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Per contract column: present, type and number of nulls, in one pass."""
    types = dict(df.dtypes)
    nulls = [
        F.count(F.when(F.col(c).isNull(), 1)).alias(c) if c in types else F.lit(None).cast("long").alias(c)
        for c in required
    ]
    line = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in types).alias("present"),
            F.lit(types.get(c)).cast("string").alias("type"),
            F.col(c).alias("nulls"),
        )
        for c in required
    ]
    return df.agg(*nulls).select(F.explode(F.array(*line)).alias("l")).select("l.*")


def quality_report(matches: DataFrame) -> DataFrame:
    """Number of offending rows per check.

    Unknown, negative and NaN values, unplayed matches and self-matches take
    one pass; repeated (date, team) keys take one grouping.
    """
    checks: dict[str, Column] = {}
    kinds = {f.name: f.dataType for f in matches.schema}
    for c in REQUIRED_COLUMNS:
        checks[f"null:{c}"] = F.col(c).isNull()
        if isinstance(kinds[c], T.NumericType):
            checks[f"negative:{c}"] = F.col(c) < 0
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            checks[f"nan:{c}"] = F.isnan(c)
    checks["unplayed"] = F.col("home_goals").isNull() | F.col("away_goals").isNull()
    checks["self_match"] = F.col("home_team") == F.col("away_team")
    names = {f"c{i}": name for i, name in enumerate(checks)}
    counts = matches.agg(
        *[F.count(F.when(checks[name], 1)).alias(c) for c, name in names.items()]
    )
    lines = [F.struct(F.lit(n).alias("check"), F.col(c).alias("bad_rows")) for c, n in names.items()]
    report = counts.select(F.explode(F.array(*lines)).alias("l")).select("l.*")
    sides = ("home", "away")
    repeated = join_key_duplicates(matches).agg(
        *[F.coalesce(F.sum(F.when(F.col("side") == s, F.col("rows"))), F.lit(0)).alias(s) for s in sides]
    )
    lines = [
        F.struct(F.lit(f"duplicate:date,{s}_team").alias("check"), F.col(s).alias("bad_rows")) for s in sides
    ]
    return report.unionByName(repeated.select(F.explode(F.array(*lines)).alias("l")).select("l.*"))


def join_key_duplicates(matches: DataFrame) -> DataFrame:
    """(date, team) keys that occur more than once on a side."""
    keys = F.array(
        *[F.struct(F.lit(s).alias("side"), F.col(f"{s}_team").alias("team")) for s in ("home", "away")]
    )
    return (
        matches.select("date", F.explode(keys).alias("k"))
        .groupBy("date", F.col("k.side").alias("side"), F.col("k.team").alias("team"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def freshness(matches: DataFrame, as_of: dt.datetime, max_age_days: int = 7) -> DataFrame:
    """Age of the newest match and whether it is recent enough."""
    newest = F.max("date")
    age = F.date_diff(ntz(as_of), F.col("newest"))
    return matches.agg(newest.alias("newest")).select(
        "newest", age.alias("age_days"), (age <= max_age_days).alias("fresh")
    )


def retrain_gate(current: DataFrame, previous: DataFrame, minimum: int = 5) -> DataFrame:
    """Number of matches not in the previous snapshot; train from ``minimum`` on."""
    new = current.select("match_id").join(previous.select("match_id"), "match_id", "left_anti")
    return new.agg(F.count(F.lit(1)).alias("new_rows")).withColumn(
        "retrain", F.col("new_rows") >= minimum
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Row count, columns, types and date range."""
    dates = [
        F.date_format(f("date"), "yyyy-MM-dd").alias(n)
        for f, n in ((F.min, "min_date"), (F.max, "max_date"))
        if "date" in df.columns
    ]
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *dates).withColumns(
        {
            "n_columns": F.lit(len(df.columns)),
            "columns": F.lit(",".join(df.columns)),
            "dtypes": F.lit(",".join(t for _, t in df.dtypes)),
        }
    )


def result_distribution(df: DataFrame, label: str = "result") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
