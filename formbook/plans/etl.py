"""Extract, prune, check and load all seasons."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from formbook.operators.quality import observed
from formbook.schemas import REQUIRED_COLUMNS
from formbook.sources.seasons import drop_columns, read_seasons_reported
from formbook.sources.tables import replace_table

MATCH_TABLE = "matches"
STATUS = (
    "status string, extracted_records long, transformed_records long, loaded_records long, seasons_read int, "
    "failed_seasons string, files_left_out int"
)


def run_etl(spark: SparkSession, paths: dict[int, str], root: str | None = None) -> DataFrame:
    """Replace the match table from the season files; returns a one-row status.

    The table is partitioned by season, so season reads prune partitions. Extracted rows are counted while they are
    written. Seasons that failed and files that were left out are listed; ``read_seasons_reported`` tells why.
    """
    extracted, problems = read_seasons_reported(spark, paths)
    failed = sorted(season for season, file, _ in problems if file is None)
    left_out = sum(file is not None for _, file, _ in problems)
    read = Observation()
    transformed = drop_columns(extracted.observe(read, F.count(F.lit(1)).alias("rows")))
    table = replace_table(transformed, MATCH_TABLE, root, required=REQUIRED_COLUMNS, partition_by="season")
    loaded = table.count()  # from the footers; ``replace_table`` has held them against the rows sent
    line = ("SUCCESS", observed(read), loaded, loaded, len(paths) - len(failed), ",".join(map(str, failed)), left_out)
    return spark.createDataFrame([line], STATUS)
