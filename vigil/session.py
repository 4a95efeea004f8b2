"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "vigil") -> SparkSession:
    """Session with the settings every job in this package assumes.

    UTC session time (epoch arithmetic on timestamps), AQE on (runtime
    broadcast conversion, partition coalescing, skew-join splitting), UI off.
    Sizes (shuffle partitions, driver memory) are left to ``spark-submit`` and the
    cluster's defaults unless given here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # a daemon checkpoints every run: drop checkpoint files once nothing references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if "VIGIL_DRIVER_MEMORY" in os.environ:
        builder = builder.config("spark.driver.memory", os.environ["VIGIL_DRIVER_MEMORY"])
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/DBFS) folder and is
    used as is; without it a cluster job fails here. Only a local session (tests) gets
    a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="vigil-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver imported it from."""
    import io
    import zipfile

    sc = spark.sparkContext
    here = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_vigil_shipped", False) or os.path.dirname(here) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for folder, _, files in os.walk(here):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    path = os.path.join(tempfile.mkdtemp(prefix="vigil-pkg-"), "vigil_package.zip")
    with open(path, "wb") as f:
        f.write(body.getvalue())
    sc.addPyFile(path)      # Spark serves it to every executor
    sc._vigil_shipped = True


def no_rows(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """An empty table that the optimizer knows to be empty: joins and unions with it fall out of the plan."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).filter(F.lit(False))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it the shuffle files of a query go when the query ends, not when the driver's heap is collected."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
