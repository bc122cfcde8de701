"""Session settings and the shared work folder.

``configure`` only sets SQL options that are safe to change at runtime, so it
can be applied to a session a cluster hands us without clobbering its sizing.
``build_local`` is for tests and the bench.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job in this package relies on.
RUNTIME_SETTINGS = {
    # Timestamps in the data carry no zone; pin the session to UTC so that
    # date derivation and oracle comparison do not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Replace only the partitions a write produces (day replays).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_local(cores: int | str = "*", shuffle_partitions: int = 8,
                app: str = "stratum", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Lets the Python workers import this package. On a cluster it is put, as a zip, into the shared folder and added to
    the session, once per application; workers on the driver's machine find it by its own folder."""
    from stratum.plans import storage

    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    known = context.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    if not context.master.startswith("local"):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, root))
        target = f"{scratch_dir(spark, 'package')}.zip"
        storage.create_bytes(spark, target, held.getvalue())
        context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it, to shared storage; without it this
    raises. Only on ``local[...]`` masters, as in tests, one is created. A
    checkpoint folder that the session already has is left alone.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: str = "4m") -> Iterator[None]:
    """Inside, an action hands rows to Python in batches of at most about ``most`` bytes (or one row). A batch of 10,000
    whole texts, held by the JVM, as Arrow and as Python strings by every task, is a good part of an executor."""
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, most)
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def sized_partitions(df: DataFrame, rows_per_task: int = 2_000_000) -> int:
    """Partitions for an exchange with an explicit count: the session's, or more
    if the counted rows need more. (Such a count is not resized by AQE.)"""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // rows_per_task))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/stratum-work/{label}-{uuid.uuid4().hex[:12]}"
