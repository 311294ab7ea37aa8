"""Session helpers: builder for local use and tables written to shared storage."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_dirs: list[str] = []
_written: list[str] = []


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "cliploom") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CLIPLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``; a temporary one of our own if unset and local."""
    path = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    if not _own_dirs:
        _own_dirs.append(tempfile.mkdtemp(prefix="cliploom-"))
        atexit.register(shutil.rmtree, _own_dirs[0], ignore_errors=True)
    return _own_dirs[0]


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and return a reader of it.

    Unlike a local checkpoint the files outlive executors, so later stages may be retried anywhere. The job runs now: an
    operator that calls this does part of its work while its DataFrame is being built.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cliploom/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what :func:`write_table` wrote inside; DataFrames made before keep their tables."""
    before = len(_written)
    try:
        yield
    finally:
        release(spark, before)


def release(spark: SparkSession, keep: int = 0) -> int:
    """Delete the tables that :func:`write_table` wrote in this process, but for the first ``keep``, once results that read
    them are stored. DataFrames that still need theirs are protected by :func:`scratch`."""
    conf, n = spark._jsc.hadoopConfiguration(), 0
    while len(_written) > keep:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(path: str):
    """(file system, path within it) of a local path or a URI, for small files and checks outside of Spark."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def is_folder(path: str) -> bool:
    """Whether there is a folder at a local path or URI."""
    from pyarrow import fs

    system, at = file_system(path)
    return system.get_file_info(at).type == fs.FileType.Directory
