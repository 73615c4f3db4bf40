"""Cutting lineage so that the loss of an executor loses no work twice, and where tables are kept.

Tables that are read more than once are written to the folder that
``spark.checkpoint.dir`` names, which all executors share.  Only a local session
that names none has a folder of its own process instead; a cluster without the
setting is an error.  What was written is deleted when the driver's JVM ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local: list[str] = []
_kept: dict[tuple, str] = {}
_schemas: dict[str, StructType] = {}


def hadoop_path(spark: SparkSession, where: str):
    """(file system, path) of Hadoop."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def shared_dir(spark: SparkSession) -> str:
    """The URI of the folder all executors share."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        at, path = hadoop_path(spark, where.rstrip("/"))
        uri = at.makeQualified(path).toString()
        return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        path = tempfile.mkdtemp(prefix="corelode-")
        atexit.register(shutil.rmtree, path, True)
        _local.append("file://" + path)
    return _local[0]


def fresh(spark: SparkSession, tag: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def forget_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a path when the driver's JVM ends."""
    at, p = hadoop_path(spark, path)
    at.deleteOnExit(p)


def store(df: DataFrame, tag: str, *by: str) -> str:
    """The path of ``df`` as Parquet in the shared folder, partitioned by the columns ``by``."""
    path = fresh(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path, partitionBy=list(by) or None)
    forget_at_exit(df.sparkSession, path)
    return path


def written(df: DataFrame, tag: str, *by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later plans start at the files."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, tag, *by))


def kept(spark: SparkSession, sources: list[str], tag: str, build: Callable[[], DataFrame], *by: str) -> DataFrame:
    """What ``build`` makes of the files ``sources``, written once for the application and read after that.

    Changed files (by length or time) make a new table.
    """
    stamps = []
    for s in sources:
        at, path = hadoop_path(spark, s)
        status = at.getFileStatus(path)
        stamps.append((s, status.getLen(), status.getModificationTime()))

    def make() -> str:
        df = build()
        path = store(df, tag, *by)
        _schemas[path] = df.schema
        return path

    where = made_once(spark, (tag, *stamps), make)
    return spark.read.schema(_schemas[where]).parquet(where)


def made_once(spark: SparkSession, key: tuple, make: Callable[[], str]) -> str:
    """The path that ``make`` wrote for a key in this application; made again if it is gone."""
    key = (spark.sparkContext.applicationId, *key)
    if key in _kept:
        at, path = hadoop_path(spark, _kept[key])
        if at.exists(path):
            return _kept[key]
    _kept[key] = make()
    return _kept[key]


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def local(spark: SparkSession, rows: list[tuple], **kinds: pa.DataType) -> DataFrame:
    """A small table whose size the planner knows, so that joins with it need no shuffle."""
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds.values())]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=list(kinds)))
