"""Session construction and cluster-facing settings.

Everything here is configuration a Spark user would set: AQE for runtime
re-planning (partition coalescing, skew-join splitting, broadcast
conversion from *measured* sizes), UTC session time so ``timestamp_ntz``
arithmetic is wall-clock exact, and a checkpoint directory taken from the
cluster when it names one.
"""

from __future__ import annotations

import math
import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "marketlake", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the provided session and call
    :func:`configure` instead."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MARKETLAKE_DRIVER_MEMORY", "16g")
    # local sessions only: keep catalog files out of the working directory
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="marketlake-warehouse-")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library relies on to an existing session."""
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.session.timeZone"):
        spark.conf.set(k, DEFAULT_CONF[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory; only when none is set
    (local tests) create a private scratch one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    sc.setCheckpointDir(path)
    return path


_LOCK, _HELD = threading.Lock(), {}


@contextmanager
def held_settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session's settings ``conf`` hold for the jobs inside; its own are back when the last of
    the threads that hold the same ones is done."""
    key = (id(spark), tuple(conf.items()))
    with _LOCK:
        if key not in _HELD:
            _HELD[key] = [0, {k: spark.conf.get(k, None) for k in conf}]
            for k, v in conf.items():
                spark.conf.set(k, v)
        _HELD[key][0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _HELD[key][0] -= 1
            if not _HELD[key][0]:
                for k, v in _HELD.pop(key)[1].items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Input bytes (compressed, on storage) per shuffle partition when sizing from the
# input. Shuffles carry less than the input (column pruning, filters, map-side
# partial aggregation), and AQE coalesces small partitions toward
# spark.sql.adaptive.advisoryPartitionSizeInBytes at runtime, so this is an upper
# bound on the starting partition size, not the size tasks end up with.
INPUT_BYTES_PER_SHUFFLE_PARTITION = 1 << 30


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes under the given files or folders, from file-system metadata (one
    recursive summary per path; no data is read). 0 when the session has no JVM
    gateway to ask (sizing is then left to the session's own settings)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except AttributeError:
        return 0
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, total_bytes: int,
                            per_partition: int = INPUT_BYTES_PER_SHUFFLE_PARTITION) -> int:
    """Raise ``spark.sql.shuffle.partitions`` so that no shuffle starts with more
    than about ``per_partition`` input bytes per partition; a larger setting is
    kept (never lowered). Returns the setting in effect."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = math.ceil(total_bytes / per_partition)
    if want > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(want))
    return max(want, current)
