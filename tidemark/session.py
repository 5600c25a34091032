"""Session settings the operators rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def make_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with UTC timestamps and adaptive execution on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Observation times are UTC instants, so casts must not apply a local offset."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside; what they were comes back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session that was built elsewhere fit for this package; repeated calls do nothing more."""
    ship_package(spark)
    return use_utc(spark)


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers, which do not share the driver's import path."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):
        target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark")
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
    context._tidemark_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    Without one, a session whose master is ``local`` or ``local[...]`` gets a temporary folder, as its only
    executor is the driver. On any other master intermediate tables would be scattered over machines: an error.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder once and go on from the written table."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
