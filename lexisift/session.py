"""Session settings, shared storage and input spreading."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "lexisift", master: str | None = None,
                  shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution; everything else is left to the cluster."""
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is used only where the setting is absent in a local run, as in
    tests; on a cluster a local folder would not be shared, so the setting is required.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lexisift-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


class Workspace:
    """Owns the folders that are made while it is open, and deletes them when it closes.

    ``with Workspace(spark): ...`` around a job that collects or writes its result leaves
    nothing behind in the shared folder. Until it closes the folders stay, so lost tasks
    can be run again from them. Frames that read them are not usable afterwards. An
    inner workspace owns what is made inside it; other threads use the same ones.
    """

    _open: list[Workspace] = []
    _lock = threading.Lock()

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def __enter__(self) -> Workspace:
        with self._lock:
            self._open.append(self)
        return self

    def __exit__(self, *error) -> None:
        with self._lock:
            self._open.remove(self)
        for folder in self.folders:
            store, path = located(folder)
            if store.get_file_info(path).type != fs.FileType.NotFound:
                store.delete_dir(path)

    @classmethod
    def note(cls, folder: str) -> None:
        with cls._lock:
            if cls._open:
                cls._open[-1].folders.append(folder)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a URI (local, HDFS, S3, GCS, Azure) and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri).replace("s3a://", "s3://", 1))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder; every call gives another one."""
    folder = f"{shared_root(spark)}/lexisift/{purpose}-{uuid.uuid4().hex}"
    Workspace.note(folder)
    return folder


def durable(df: DataFrame, purpose: str = "table", rebalance: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors.

    ``rebalance`` evens out the files by size first. One shuffle more, worth it for a
    table that iterative fitting scans again and again.
    """
    path = shared_folder(df.sparkSession, purpose)
    (df.hint("rebalance") if rebalance else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, tasks_per_core: int = 2) -> DataFrame:
    """Spread rows over the cores when the scan itself cannot keep them busy.

    A scan with at least ``tasks_per_core`` splits per core passes through without a
    shuffle. Below that, a file counts as one unit of work, since a small file is a
    single row group however many splits are planned over it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = tasks_per_core * cores
    splits = df.rdd.getNumPartitions()
    if splits >= wanted or min(splits, len(df.inputFiles()) or splits) >= cores:
        return df
    return df.repartition(wanted)
