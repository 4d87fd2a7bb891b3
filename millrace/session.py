"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", app: str = "millrace") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name that every executor can reach.

    It lies under ``spark.checkpoint.dir``. A local folder is made only where that is unset and the
    session runs in one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/millrace-{purpose}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """A database in the shared folder, one per application."""
    name = "millrace_" + re.sub(r"[^a-z0-9]", "_", spark.sparkContext.applicationId.lower())
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{shared_dir(spark, 'db')}'")
    return name


def scratch_table(spark: SparkSession, stem: str) -> str:
    """A table name of the scratch database that is not yet in use."""
    return f"{scratch_database(spark)}.{stem}_{uuid.uuid4().hex[:12]}"
