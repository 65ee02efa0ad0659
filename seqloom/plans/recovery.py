"""Lineage cuts that survive the loss of an executor.

Everything that is written here goes to the folder named by ``spark.checkpoint.dir``,
which all executors share.  A private folder is set only where the setting is missing
(single-machine sessions and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="seqloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/seqloom/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from a reliable checkpoint (for narrow tables)."""
    shared_dir(df.sparkSession)
    if not df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def table(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Compute ``df`` once into a compressed Parquet table in the shared folder."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
