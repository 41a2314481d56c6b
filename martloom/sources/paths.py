"""Paths on whatever file system Spark is configured for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching the pattern; works for object stores as well as local files."""
    fs, hadoop_path = _hadoop(spark, pattern)
    found = fs.globStatus(hadoop_path)
    return [] if found is None else [s.getPath().toString() for s in found]


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a folder's files."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """path and stamp of the files matching the pattern, and of those in folders matching it.

    The stamp (path, time and length) differs once a file was replaced. Spark lists many folders in
    parallel and reads no content; hidden files and those of no bytes are left out. Nothing matching
    gives no rows.
    """
    if not glob(spark, pattern):
        return spark.createDataFrame([], "path string, stamp string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    stamp = F.concat_ws(
        " ", "path", F.unix_millis("modificationTime").cast("string"), F.col("length").cast("string")
    )
    return files.select("path", stamp.alias("stamp"))


def data_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the inventory."""
    return sorted(r["path"] for r in inventory(spark, pattern).select("path").collect())


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="martloom-")
        base = _local_folders[app]
    return join(base, "martloom", uuid.uuid4().hex)
