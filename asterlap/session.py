"""Where a session may keep intermediate tables."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    A throw-away folder is made only for a local master whose session names none; a cluster without the
    setting is an error, because a folder on one machine would be lost with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="asterlap-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and stored in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
