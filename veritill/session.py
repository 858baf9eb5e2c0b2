"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

HUGE_METHODS = "spark.sql.codegen.hugeMethodLimit"
#: Spark's own value of it: the largest method the virtual machine loads
SPARK_LIMIT = 65535
#: Whether Spark deletes the files of a shuffle with the execution that wrote them
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Settings the operators rely on; cluster sizing stays with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot leaves methods above this size uncompiled; Spark then splits the work instead
    HUGE_METHODS: "8000",
}


def build_session(app: str = "veritill", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compile_small(spark: SparkSession) -> None:
    """Split generated code that HotSpot would only interpret, in a session made elsewhere; its own limit stays.

    Cleaning and joins in one generated method take several times as long when the method is beyond HotSpot's size.
    """
    if int(spark.conf.get(HUGE_METHODS)) == SPARK_LIMIT:
        spark.conf.set(HUGE_METHODS, SETTINGS[HUGE_METHODS])


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of every step go when the step has ended.

    Otherwise they lie on the executors' disks until the driver happens to collect its garbage, and those of all
    steps add up.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_dir`` named, once no step reads it any more."""
    root = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/veritill/"
    if not path.startswith(root) or not path[len(root):] or "/" in path[len(root):]:
        raise ValueError(f"{path} is no scratch folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder below ``spark.checkpoint.dir``.

    Intermediate tables have to outlive the executor that wrote them, so on a cluster the
    folder must be the shared one named by the session; only a local session may fall back to
    a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="veritill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/veritill/{label}-{uuid.uuid4().hex}"
