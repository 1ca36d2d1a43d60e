"""Session settings and intermediate tables of the text operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import claimwright
from claimwright.session import configure

# A batch sent to a Python worker closes at this many bytes, whatever the row sizes.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that every text operator relies on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Every step ends in a stored table, so no later one reads the shuffle files of an earlier.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    shared_folder(spark)
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, for the code that runs there."""
    context = spark.sparkContext
    if getattr(context, "_claimwright_shipped", False):
        return
    top = Path(claimwright.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="claimwright-code-")) / "claimwright.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for path in sorted(top.rglob("*.py")):
            packed.write(path, path.relative_to(top.parent).as_posix())
    context.addPyFile(str(archive))
    context._claimwright_shipped = True


def give_back_memory() -> None:
    """Return what earlier tasks of this worker process freed to the system.

    Python workers are used again, and else keep the most that any task of theirs held.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session that leaves the
    setting out gets a temporary one.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="claimwright-shared-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def written(df: DataFrame, name: str, *replaced: DataFrame) -> DataFrame:
    """``df`` computed once and kept as a Parquet table in the shared folder.

    Cuts the lineage: later reads do not depend on any executor. Once it is stored, the
    stored tables ``replaced``, which nothing reads any more, are deleted. The others stay
    until ``discard``, ``remove_written`` or until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _written_paths(spark)[path] = stored
    discard(*replaced)
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned; other tables are left alone."""
    for table in tables:
        paths = _written_paths(table.sparkSession)
        for path in [path for path, stored in paths.items() if stored is table]:
            _delete(table.sparkSession, path)
            del paths[path]


def remove_written(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session, once their results are stored."""
    paths = _written_paths(spark)
    for path in paths:
        _delete(spark, path)
    paths.clear()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _written_paths(spark: SparkSession) -> dict[str, DataFrame]:
    context = spark.sparkContext
    if not hasattr(context, "_claimwright_written"):
        context._claimwright_written = {}
    return context._claimwright_written
