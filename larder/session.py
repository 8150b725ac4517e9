"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "larder", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", os.environ.get("LARDER_SHUFFLE_PARTITIONS", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent *and* the
    master is local, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="larder-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is ever overwritten or deleted."""
    return f"{shared_dir(spark)}/larder/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session."""
    import shutil
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_larder_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="larder-package-")  # driver side only: Spark serves the file to executors
    archive = shutil.make_archive(f"{folder}/larder", "zip", root.parent, root.name)
    context.addPyFile(archive)
    context._larder_shipped = True
