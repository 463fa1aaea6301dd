"""Tables written to the shared folder, to cut lineage and to survive lost executors."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_folders: list[str] = []
#: Spark's switch that removes a job's shuffle files when it ends, not when the driver happens to collect its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Only a local session without that setting gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: a cluster needs a shared folder")
    made = tempfile.mkdtemp(prefix="corpusloom-")
    _folders.append(made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


@contextlib.contextmanager
def _cleaned(spark: SparkSession):
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    The result has no lineage to the input, so lost executors cost no recomputation, and it can be
    read several times.  ``tidy`` removes it once no result reads it, else it goes when the process ends.
    The job's shuffle files are removed with its end.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusloom-{name}-{uuid.uuid4().hex}"
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    _folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str = "t") -> tuple[DataFrame, int]:
    """``materialize`` and the number of rows written, counted in the same job."""
    seen = Observation()
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return written, int(seen.get["n"])


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work that is heavy a row.

    Only a scan with fewer splits than cores (a small table in one file) is shuffled; a large table has more splits and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString() or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def remember(path: str) -> None:
    """Have ``path`` removed with the tables."""
    _folders.append(path)


def discard(path: str) -> None:
    """Remove a table that nothing reads any more before its query returns."""
    _delete(path)
    if path in _folders:
        _folders.remove(path)


def write_parts(df: DataFrame, by: str, name: str) -> str:
    """Write ``df`` to the shared folder, a folder for every value of ``by``, for tasks that read parts by ``read_part``; the path."""
    path = f"{shared_dir(df.sparkSession)}/corpusloom-{name}-{uuid.uuid4().hex}"
    _folders.append(path)
    with _cleaned(df.sparkSession):
        df.write.partitionBy(by).option("compression", "zstd").parquet(path)
    return path


def read_part(path: str, by: str, value: object, columns: list[str]):
    """The Arrow table of one part, read by the task that calls this; null if there is none."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path if ":" in path else "file://" + path)
    inner = f"{inner}/{by}={value}"
    if system.get_file_info(inner).type == fs.FileType.NotFound:
        return None
    return ds.dataset(inner, filesystem=system, format="parquet", exclude_invalid_files=True).to_table(columns=columns)


def tidy(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Remove the tables that ``query`` wrote and its result does not read, as soon as it returns.

    Those that the result reads stay until the process ends, since plans that callers derive from it may read them at any time.
    """

    @functools.wraps(query)
    def run(*args, **kwargs) -> DataFrame:
        before = len(_folders)
        out = query(*args, **kwargs)
        made = _folders[before:]
        if made:
            read = out.inputFiles()
            free = [p for p in made if not any(f"/{_leaf(p)}/" in f for f in read)]
            for p in free:
                _delete(p)
            _folders[before:] = [p for p in made if p not in free]
        return out

    return run


def _leaf(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _delete(path: str) -> None:
    """Through the file system that the path names while there is a session, else (at the end) only on this machine."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            return
        except Exception:  # noqa: BLE001 - the session may be going down; what is left is removed below if it is local
            pass
    if path.startswith("file:"):
        path = path[5:].replace("///", "/", 1)
    if "://" not in path:
        shutil.rmtree(path, ignore_errors=True)


@atexit.register
def _remove() -> None:
    for p in _folders:
        _delete(p)
    _folders.clear()
