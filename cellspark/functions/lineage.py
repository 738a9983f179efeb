"""Materialising tables that several later steps start from.

Both functions write to a folder that the driver and all executors share, so what they write outlives
executors: the one named by ``spark.checkpoint.dir``, else ``_checkpoints`` in the session's warehouse.
They behave alike on every master. Stored tables lie below ``tables-<application id>``, which can be
removed once the application has ended; checkpoints go by ``spark.cleaner.referenceTracking.cleanCheckpoints``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables; read from the session, set only where it is unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or own)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint a step-sized table. It keeps its partitioning, and the plans that follow stay short."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def table_path(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def store(df: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """Write a table as Parquet: computed once, compressed, and later steps read only the columns they use.

    ``folders`` are columns by whose values it is written in folders; a filter on them reads only those.
    """
    path = table_path(df.sparkSession, "table")
    df.write.partitionBy(*(folders or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
