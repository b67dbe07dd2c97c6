"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidewatch.sources.files import delete, qualified

#: UTC day and hour buckets, and run-time re-planning. Sizes (memory, executors, shuffle partitions) stay with the caller.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "tidewatch", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` takes dotted keys through ``**{...}``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin an existing session to UTC, which all time buckets assume."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_SETTING = threading.Lock()


@contextmanager
def with_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the calls inside only, of one thread at a time."""
    with _SETTING:
        before = spark.conf.get(key, None)
        spark.conf.set(key, value)
        try:
            yield
        finally:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name, with scheme and authority, under the cluster's shared ``spark.checkpoint.dir``.

    Tasks that open files themselves so reach the file system that Spark's own readers and writers take it for.

    Where that setting is absent, a single-machine session (master ``local``) gets a temporary folder; on a cluster, whose
    executors would each write to their own disk, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{qualified(spark, base).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_shared_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by :func:`shared_folder` once nothing reads it any more."""
    delete(spark, folder)
