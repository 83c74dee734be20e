"""Tables written to the cluster's shared folder.

Small results that several later steps read, such as trained models, are
written once and read back. That cuts the lineage, survives the loss of
executors, and gives the planner a true size to plan with.
"""
from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from gridlore.sources.files import write_parquet

_SETTING = "spark.checkpoint.dir"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _shared_dir(spark: SparkSession) -> str:
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridlore-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


_written: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{_shared_dir(spark)}/gridlore/{name}-{uuid.uuid4().hex}"
    for paths in _written[-1:]:
        paths.append(path)
    return path


@contextmanager
def written_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was written to the shared folder inside it.

    Results that read those tables must have been used or written elsewhere by
    then. Without it, written tables stay.
    """
    _written.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _written.pop():
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    return write_parquet(df, scratch_path(df.sparkSession, name))


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The written result of ``make``, without the tables that were written for it."""
    path = scratch_path(spark, name)
    with written_tables(spark):
        return write_parquet(make(), path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """What is written inside it gives Python workers at most ``rows`` rows at a time.

    Rows that hold a text's words or shingles are large: with Spark's 10,000 a batch
    may be a task's whole input, which the executor and the worker then both hold.
    """
    before = spark.conf.get(_BATCH)
    # 0 or less means that there is no bound.
    spark.conf.set(_BATCH, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Use all cores for an input that is read in fewer pieces than there are.

    Work on text is heavy for its size, so a few pieces are worth a shuffle. An
    input that splits into more is left as it is, however few its files are. Of a
    table as it is read, only the plan is asked; an input with shuffles of its
    own is computed up to the last of them to know its pieces.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *key)


def ship_library(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library, wherever they run; once a session.

    Spark itself hands the file out to the executors.
    """
    context = spark.sparkContext
    if not any(path.endswith("/gridlore.zip") for path in context.listFiles):
        package = Path(__file__).resolve().parent.parent
        path = f"{tempfile.mkdtemp(prefix='gridlore-')}/gridlore.zip"
        with zipfile.ZipFile(path, "w") as library:
            for file in sorted(package.rglob("*.py")):
                library.write(file, file.relative_to(package.parent))
        context.addPyFile(path)
    return spark
