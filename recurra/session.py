"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Everything that compares calendar days relies on one time zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A write that parts rows in two (records and bad lines, valid and held ones) need not sort them first.
    # Spark begins to sort once that many writers are open, so two sides need one more.
    "spark.sql.maxConcurrentOutputFileWriters": "3",
}
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _MADE = threading.Lock(), []
# Can only be set when the session starts. Call-site capture costs several driver round trips
# per column expression.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "recurra", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this library's settings; ``extra`` takes further Spark settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the results depend on in a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What queries started within have shuffled goes as each of them ends.

    Otherwise it stays until the driver collects garbage, which it may not do before the disks are full.
    """
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path below the cluster's shared checkpoint folder.

    The folder named in ``spark.checkpoint.dir`` is visible to every executor. Only in local
    mode may it be unset; a temporary one is then made, once per session. ``drop_scratch`` deletes
    what this session has made.
    """
    with _LOCK:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = tempfile.mkdtemp(prefix="recurra-")
            spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders of this session; nothing that still reads them may be used."""
    conf, paths = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    while _MADE:
        path = paths(_MADE.pop())
        path.getFileSystem(conf).delete(path, True)
