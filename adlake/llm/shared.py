"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Rows that go to a Python worker at once: of ordinary texts, a few megabytes.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Bound what a worker holds of its input and output; a smaller setting of the session's own stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, as in tests, a session of one machine gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        set_before = spark.sparkContext.getCheckpointDir()
        if set_before:
            return set_before
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: whoever reads it later needs none of the executors that made it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers that may be sent to every executor.
FEW_ROWS = 500_000


def if_few(rows: DataFrame) -> DataFrame:
    """Slim rows, to be broadcast if there are at most ``FEW_ROWS``; else Spark chooses the join."""
    return F.broadcast(rows) if rows.limit(FEW_ROWS + 1).count() <= FEW_ROWS else rows
