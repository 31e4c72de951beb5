"""Reading and replacing tables: Parquet folders, catalog tables, JDBC.

A replaced table is written as a whole to a fresh place, checked there, and only then becomes the one that readers
find: by a pointer in the table's folder, or by a view over a fresh catalog table.
"""

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from formbook.functions.columns import nan_to_null, require
from formbook.operators.quality import observed
from formbook.sources import pointers


class MissingTable(LookupError):
    """The table has not been written yet."""


class IncompleteWrite(RuntimeError):
    """A fresh version does not hold the rows that were written to it; the old one stays."""


def _current(spark: SparkSession, folder: str) -> DataFrame | None:
    """The version that a replaced table's pointer names."""
    found = pointers.newest(spark, f"{folder}/_current")
    if found is None:
        return None
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    return spark.read.schema(schema).parquet(f"{folder}/{found['version']}")


def scan_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """Whole table, NaN read as null. Without ``root``, a catalog table.

    Below ``root`` a table is what ``replace_table`` wrote last, or a plain Parquet folder.
    """
    try:
        if root:
            folder = f"{root}/{name.lower()}"
            df = _current(spark, folder)
            df = spark.read.parquet(folder) if df is None else df
        else:
            df = spark.table(name.lower())
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise
        raise MissingTable(name) from error
    return nan_to_null(df)


def read_tables(
    spark: SparkSession, schemas: dict[str, T.StructType], root: str | None = None
) -> dict[str, DataFrame]:
    """Several tables; one that is missing becomes an empty frame of its schema."""
    found = {}
    for name, schema in schemas.items():
        try:
            found[name] = scan_table(spark, name, root)
        except MissingTable:
            found[name] = spark.createDataFrame([], schema)
    return found


def replace_table(
    df: DataFrame,
    name: str,
    root: str | None = None,
    required: list[str] | None = None,
    partition_by: str | None = None,
    keep: int | None = None,
) -> DataFrame:
    """Check the column contract, replace the whole table, and read it back.

    A write that fails, or whose rows do not all arrive, leaves the old table. ``df`` may read the table it replaces,
    and frames planned before go on reading the version they know: versions are deleted only with ``keep``, all but
    the newest so many. A partitioned table is rebalanced on its partition column first, which keeps files few and
    splits a partition value that holds most of the rows.
    """
    spark, name = df.sparkSession, name.lower()
    require(df, required or [], name)
    written = Observation()
    if partition_by:
        df = df.hint("rebalance", partition_by)
    # Counted in the tasks that write, which count once however often a task before them is repeated.
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if root:
        _replace_folder(spark, f"{root}/{name}", df.schema, writer, written, keep)
    else:
        _replace_view(spark, name, writer, written, keep)
    return scan_table(spark, name, root)


def _check(found: DataFrame, written: Observation, name: str) -> None:
    """Rows are counted from the footers of the files."""
    rows, expected = found.count(), observed(written)
    if rows != expected:
        raise IncompleteWrite(f"{name}: {rows} rows of {expected}")


def _replace_folder(spark: SparkSession, folder: str, schema: T.StructType, writer, written: Observation, keep: int | None) -> None:
    version = f"_versions/{uuid.uuid4().hex}"
    writer.save(f"{folder}/{version}")
    _check(spark.read.schema(schema).parquet(f"{folder}/{version}"), written, folder)
    pointers.claim(spark, f"{folder}/_current", {"version": version, "schema": schema.json()})
    if keep:
        for number in pointers.numbers(spark, f"{folder}/_current")[:-keep]:
            marker = f"{folder}/_current/{number:012d}"
            if old := pointers.read_marker(spark, marker):
                pointers.delete_folder(spark, f"{folder}/{old['version']}")
            pointers.delete_folder(spark, marker)


def _replace_view(spark: SparkSession, name: str, writer, written: Observation, keep: int | None) -> None:
    # Numbered after those there are; two writers of one number collide in the catalog, and one fails.
    versions = sorted(t.name for t in spark.catalog.listTables(pattern=f"{name}__v*") if not t.isTemporary)
    number = int(versions[-1].rsplit("__v", 1)[1]) + 1 if versions else 1
    fresh = f"{name}__v{number:06d}"
    writer.saveAsTable(fresh)
    _check(spark.table(fresh), written, name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v000000")  # a plain table becomes the oldest version
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fresh}")
    for old in [*versions, fresh][:-keep] if keep else ():
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Database table, read in parallel by ranges of ``column``."""
    df = spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties,
    )
    return nan_to_null(df)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Replace a database table, keeping its definition and grants."""
    df.write.option("truncate", True).jdbc(url, table.lower(), mode="overwrite", properties=properties)


def records_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON object; dates as text, nulls kept."""
    days = {
        f.name: F.date_format(f.name, "yyyy-MM-dd")
        for f in df.schema
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    }
    record = F.struct(*df.columns)
    return df.withColumns(days).select(F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))
