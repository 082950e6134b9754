"""Session helpers.

``local_session`` is for tests and the bench only; cluster jobs receive the
session they run in.  ``shared_dir`` returns the cluster's reliable shared
folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pulsekit") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's
    ``spark.checkpoint.dir``, also registered for ``checkpoint()``.

    On a cluster it must be set.  A ``local[...]`` master, where the driver is
    the only process, may do without: its folder is then a temporary one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="pulsekit-ckpt-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    return folder.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(shared_dir(spark), *parts)


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, once per application:
    their import path is not the driver's."""
    context = spark.sparkContext
    if getattr(context, "_pulsekit_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="pulsekit-"), "pulsekit-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._pulsekit_shipped = True
