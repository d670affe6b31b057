"""Cut a plan by a table that every executor can read again.

The folder is the session's ``spark.checkpoint.dir``; executors can be lost and
the cut still holds, which a local checkpoint would not give. Where that setting
is unset, a session in one process (tests, notebooks) uses a folder of this machine;
on a cluster a missing setting is an error.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for cuts: the cluster's, or in one process a local one where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = getattr(shared_folder, "own", None)
        if folder is None:
            folder = shared_folder.own = "file://" + tempfile.mkdtemp(prefix="tallyweave-")
    return folder.rstrip("/")


def mark() -> int:
    """The number of tables written so far, for ``since`` of :func:`cut`."""
    return len(_written)


def cut(df: DataFrame, name: str = "cut", partition_by: list[str] | None = None, since: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return a scan of it.

    With ``since``, a :func:`mark`, the tables written after that mark are removed once this one stands: nothing else may read them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyweave/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if since is not None:
        drop_cuts(since)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(since: int = 0) -> None:
    """Remove all tables written by :func:`cut` in this process, after a :func:`mark` where one is given."""
    while len(_written) > since:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone already
            pass


atexit.register(drop_cuts)
