"""Helpers shared by the corpus operators: staged tables, Arrow batches, byte hashing."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word contracts: \x20 and \x09-\x0D (what bytes.split() cuts at).
SPACE_CLASS = r"\x20\x09-\x0D"

_LOCAL_STAGE: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a ``local[...]`` session may go without (tests); then a private folder is used, since
    driver and executors are one process. Any other master without the setting is an error,
    because executors would write to disks nobody else can read.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL_STAGE.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="llm-stage-"))


#: Settings for jobs over tables whose rows take megabytes: a task reads and passes on few at a time.
LARGE_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "4"}


def staged(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, so a
    lost executor costs the running stage only, and later readers prune columns. With ``large_rows``
    a row group is measured after every row; else only after the first hundred."""
    path = f"{stage_root(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    options = {"parquet.block.size": str((8 if large_rows else 32) << 20)}  # a writing task holds a row group
    if large_rows:
        options |= {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, keep: str | None = None) -> DataFrame:
    """``mapInArrow`` of a function from batch to batch (or None for nothing); a task gives the
    memory it freed back when it ends, and all caches but ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch)
            if out is not None and out.num_rows:
                yield out
        tidy(keep)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


_CACHES: dict[str, dict] = {}


def cache(name: str) -> dict:
    """A dictionary that a Python worker keeps between the tasks of one operator, until another's tidies."""
    return _CACHES.setdefault(name, {})


def tidy(keep: str | None = None) -> None:
    """Empty all caches but ``keep`` and give freed memory back to the system: Python workers live
    on, and the next stage needs it."""
    for name, kept in _CACHES.items():
        if name != keep:
            kept.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def crc_mod(column: str, by: int) -> F.Column:
    """crc32(id as text) mod ``by``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))


# ---- byte hashing (numpy, whole texts) -------------------------------------------------

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: One random 64-bit value per byte, from a fixed seed.
BYTE_VALUE = np.random.default_rng(20240501).integers(1, 2**63 - 1, 256, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hash(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every window of ``length`` values, built by doubling:
    the hash of 2n values is that of the first n times a power, plus that of the next n."""
    n = len(values)
    if n < length:
        return np.empty(0, np.uint64)
    out, have, block, size, left = None, 0, values.astype(np.uint64), 1, length
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                if out is None:
                    out, have = block, size
                else:
                    keep = n - have - size + 1
                    out = out[:keep] * np.uint64(pow(int(_MULTIPLIER), size, 1 << 64)) + block[have:have + keep]
                    have += size
            left >>= 1
            if left:
                keep = n - 2 * size + 1
                block = block[:keep] * np.uint64(pow(int(_MULTIPLIER), size, 1 << 64)) + block[size:size + keep]
                size *= 2
        return mix(out)


def window_min(values: np.ndarray, length: int) -> np.ndarray:
    """Minimum of every window of ``length`` values, by doubling."""
    n, block, size = len(values), values, 1
    while size * 2 <= length:
        block = np.minimum(block[:len(block) - size], block[size:])
        size *= 2
    keep = n - length + 1
    return block[:keep] if size == length else np.minimum(block[:keep], block[length - size:length - size + keep])
