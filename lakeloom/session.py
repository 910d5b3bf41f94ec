"""Session settings that the operators assume."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword settings win over them."""
    b = SparkSession.builder.appName("lakeloom").config(map={**SETTINGS, **settings})
    return (b.master(master) if master else b).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where none is set, a local master gets a new temporary folder; a cluster
    raises, as its executors could not see one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that the driver and executors of {master} share")
        found = tempfile.mkdtemp(prefix="spark-lakeloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_swept: set[str] = set()


def work_dir(spark: SparkSession) -> str:
    """This application's folder for intermediate tables; its end deletes them."""
    path = f"{shared_dir(spark)}/lakeloom/{spark.sparkContext.applicationId}"
    if path not in _swept:
        fs, folder = _files(spark, path)
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _swept.add(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of any file system that Spark reads."""
    fs, folder = _files(spark, path)
    fs.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _files(spark, path)
    return fs.exists(folder)


def _files(spark: SparkSession, path: str) -> tuple:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(sc._jsc.hadoopConfiguration()), folder


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the session's Python workers import this package, once per application.

    A cluster that has it installed needs no such call.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).parent
        name = Path(tempfile.mkdtemp(prefix="spark-lakeloom-")) / "lakeloom.zip"
        with zipfile.ZipFile(name, "w") as z:
            for f in root.rglob("*.py"):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(name))  # Spark serves it to the executors
        _shipped.add(app)
