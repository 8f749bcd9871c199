"""What several operators write to the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where the session names none, a temporary one is set if the master is local; on a cluster that folder would not be
    shared, and it is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp("-checkpoints")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it from there: lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As `cut_lineage`, by a Parquet table in the shared folder. Loops need it: a checkpointed frame keeps the size that
    the optimizer guessed for its plan, and the guess for a join is a product, so that it grows without bound by rounds."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str, each_core: int = 4) -> DataFrame:
    """Rows dealt out by a key into a stated number of parts, so many for each core, where little data makes much work: a
    shuffle's parts are put together by size, and a small file is one part."""
    return df.repartition(each_core * df.sparkSession.sparkContext.defaultParallelism, key)
