"""Cutting long plans through tables in shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``: shared storage, so tables outlive lost executors.

    Where none is named, a folder in the session's warehouse is used, which a cluster shares, too.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named is None:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    return named.rstrip("/")


def new_folder(spark: SparkSession, kind: str = "stage") -> str:
    """A path of its own below the checkpoint folder; ``clear_stages`` removes what was written there."""
    path = f"{checkpoint_folder(spark)}/tallyscope-{kind}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table below the checkpoint folder and continue from there.

    Every later use reads the table instead of computing it again. Being parquet, it keeps column pruning, filter
    pushdown and sizes, by which Spark chooses between broadcast and shuffled joins.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stages(spark: SparkSession) -> int:
    """Delete every table and folder this process made through this module; call it when all results are consumed."""
    made, _MADE[:] = list(_MADE), []
    jvm = spark.sparkContext._jvm
    for path in made:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return len(made)
