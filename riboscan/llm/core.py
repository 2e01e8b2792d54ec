"""Shared pieces: the shared folder that cuts lineage, and small helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Where the setting is absent, a local session gets a temporary folder of
    its own; a cluster session is refused, since its executors wouldn't share
    such a folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="riboscan-shared-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return "file://" + _OWN[app]


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Rows that go to a Python worker at once, where the session has no setting of its own; texts make rows large.
BATCH_ROWS, _BATCH = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> bool:
    """Sets the bound, unless the session has one; says whether it did.

    For applications: a plan reads the setting when it runs, so one that is
    returned to be run later needs it to stay.
    """
    if _BATCH in spark.conf.getAll:
        return False
    spark.conf.set(_BATCH, str(BATCH_ROWS))
    return True


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The bound for what runs inside; the session's settings are as before afterwards."""
    ours = bound_batches(spark)
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(_BATCH)


class Workspace:
    """Tables written in the shared folder; they outlive a lost executor.

    ``keep`` writes a DataFrame as Parquet and returns the written table, so
    later plans start from the files and not from the lineage. ``drop``
    deletes tables that no later plan reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/riboscan-{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        with small_batches(self.spark):
            df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
