"""Session settings and the folder shared by driver and executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "riskmart", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators are designed for.

    Adaptive execution joins small sides by broadcast on their measured size, splits skewed
    join partitions and merges small shuffle partitions, so no fixed partition count is set.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Run-time settings for wide projections.

    The JVM never compiles a method above 8000 bytes. A whole stage whose generated method is larger would be
    interpreted for every row, so such stages are generated operator by operator, in methods small enough.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Before Python code runs in tasks: send this package to the executors, once per application, unless they find it by themselves."""
    package = Path(__file__).resolve().parent
    context, name = spark.sparkContext, f"{package.name}.zip"
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(package.parent) in places or any(Path(f).name == name for f in context.listFiles):
        return
    # the code itself, not data; the context hands it on from the driver
    path = os.path.join(tempfile.mkdtemp(), name)
    with zipfile.ZipFile(path, "w") as packed:
        for source in package.rglob("*.py"):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
    return folder


def with_shared_folder(spark: SparkSession) -> SparkSession:
    """For local sessions that name no shared folder (tests, benchmarks): a temporary one, removed with the JVM."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskmart-"))
    return spark


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one run; it is deleted when the application ends."""
    path = os.path.join(shared_folder(spark), f"riskmart-{name}-{uuid.uuid4().hex}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def shuffle_width(spark: SparkSession) -> int:
    """Parallelism that hot keys and ordered runs are spread over."""
    return max(8, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4096))
