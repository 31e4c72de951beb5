"""Small column expressions shared by the operators."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from formbook.schemas import CLASSES, ContractError


def require(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"{what}: missing columns {missing}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def result_of(home_goals: Column, away_goals: Column) -> Column:
    """Home-side result. Goals that compare to nothing give ``Lose``."""
    return (
        F.when(home_goals > away_goals, "Win")
        .when(home_goals == away_goals, "Draw")
        .otherwise("Lose")
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("long")


def label_index(label: Column) -> Column:
    index = F.when(F.lit(False), F.lit(0.0))
    for i, name in enumerate(CLASSES):
        index = index.when(label == name, F.lit(float(i)))
    return index


def label_name(index: Column) -> Column:
    return F.get(F.array(*map(F.lit, CLASSES)), index.cast("int"))
