"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_SHARED_DIR_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "casemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "64m")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else one inside the warehouse."""
    configured = spark.conf.get(_SHARED_DIR_CONF, None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages").rstrip("/")


class Stage:
    """Tables written between waves of a non-repeatable step.

    A written table survives the loss of any executor, is read back with its own
    column pruning, and keeps a model from being called twice for the same row.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.root = f"{shared_dir(spark)}/casemill-{uuid.uuid4().hex}"
        self._count = 0

    def write(self, df: DataFrame) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:04d}"
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete this stage's own tables once the final outputs are written."""
        path = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_old_stages(spark: SparkSession, hours: float) -> int:
    """Delete stage folders in the shared folder that were last written more than ``hours`` ago; returns how many.

    Queries return tables that are read later, so they cannot delete what they have written themselves.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest, dropped = (time.time() - hours * 3600) * 1000, 0
    folders = system.listStatusIterator(path) if system.exists(path) else None
    while folders is not None and folders.hasNext():
        folder = folders.next()
        if folder.isDirectory() and folder.getPath().getName().startswith("casemill-") and folder.getModificationTime() < oldest:
            dropped += system.delete(folder.getPath(), True)
    return dropped
