"""Session helpers: the shared folder, and lineage cuts in it."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="formbook-"))
        folder = _own_folder[0]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/formbook/{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read from there, so that later uses do not compute it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
