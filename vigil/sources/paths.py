"""Small files and folders of a shared store, through Spark's own Hadoop file systems (driver side)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none when there is no such folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written in one call (a new name: it is not replaced)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")


def require_shared(spark: SparkSession, path: str, what: str) -> str:
    """A bare path is every machine's own disk: off local mode it must name its file system."""
    if not is_local(spark) and ":/" not in path:
        raise ValueError(f"{what}: {path!r} has no file system scheme; on a cluster name a shared folder")
    return path
