"""Where intermediate and target tables may be written."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

from tidemark.functions.text import quoted, sql_string


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's checkpoint folder.

    Only a single-machine session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def new_database(spark: SparkSession, prefix: str = "tidemark") -> str:
    """Create an empty database in the shared folder and return its name."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {quoted(name)} LOCATION {sql_string(shared_folder(spark) + '/' + name)}")
    return name


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once; they may start in any folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.join("tidemark", os.path.relpath(file, package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
