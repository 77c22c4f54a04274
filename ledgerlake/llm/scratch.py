"""Cutting a plan: write a DataFrame to the shared folder and read it back.

Every multi-pass operator of this subpackage cuts its lineage through a Parquet table below
``spark.checkpoint.dir``, the folder that driver and executors share. A task that is lost later
rereads that table; nothing depends on blocks that only one executor holds.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


#: Rows that one task may well write when a bound on all rows is known.
ROWS_A_FILE = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset (tests, one machine) a folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own()


@lru_cache(1)
def _own() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-shared-")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written once as Parquet and read back: later plans start from the stored rows.

    rows: how many it has at most, where that is known; few rows then go to few files instead of one per partition.
    """
    return stored(df, name, rows)[0]


def stored(df: DataFrame, name: str, rows: int | None = None) -> tuple[DataFrame, str]:
    """cut(), and the path of its table: for steps that remove() it once a later step is stored."""
    path = new_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(1 + rows // ROWS_A_FILE)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that is no longer needed, through Hadoop's file system API."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def tasks_for(spark: SparkSession, least: int = 1) -> int:
    """Partitions to deal rows out to by a key: the session's shuffle width."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores in front until no column of df has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
