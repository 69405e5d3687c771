"""Intermediate tables in the cluster's shared checkpoint folder."""

import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only in local mode without a setting."""
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="vidguard-")
    spark.conf.set(CHECKPOINT_DIR, path)
    return path


def written(df: DataFrame) -> DataFrame:
    """Write once as Parquet and read back: later uses scan columns instead of redoing the plan."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if _open:
        _open[-1][path] = df.sparkSession
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[id(table)] = path
    weakref.finalize(table, _paths.pop, id(table), None)
    return table


_open: list[dict[str, SparkSession]] = []
_paths: dict[int, str] = {}


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables written inside the block at its end, but for those given to the function.

    ``with scratch() as keep: ... keep(written(df))``. What the block returns may read only kept tables;
    a kept table counts as written in the block around this one, if there is any.
    """
    made: dict[str, SparkSession] = {}
    kept: dict[str, SparkSession] = {}

    def keep(table: DataFrame) -> DataFrame:
        path = _paths[id(table)]
        kept[path] = table.sparkSession
        return table

    _open.append(made)
    try:
        yield keep
    finally:
        _open.pop()
        if _open:
            _open[-1].update(kept)
        for path, spark in made.items():
            if path not in kept:
                _delete(spark, path)


def forget(table: DataFrame) -> None:
    """Delete a table that ``written`` made, once nothing reads it any more."""
    spark = table.sparkSession
    root = checkpoint_dir(spark)
    for file in table.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("table-") and root.rstrip("/").split(":")[-1] in file:
            _delete(spark, folder.toString())


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    For sessions started without ``--py-files``: workers need it for the encoder and the matcher,
    wherever the driver was started.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='vidguard-')}/{package.name}", "zip",
            root_dir=package.parent, base_dir=package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
