"""Helpers that several corpus operators use."""

import contextlib
import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows go to the shared folder of spark.checkpoint.dir, which outlives executors.

    With spark.cleaner.referenceTracking.cleanCheckpoints Spark removes them once nothing refers to them.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The session's folder, as it is set; only on a local master without one (tests) a temporary one is made."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quern-"))
    return sc._jsc.sc().getCheckpointDir().get()


_kept: dict = {}


def kept(key, make):
    """What make gives, kept by the Python worker until another key is asked for: one operator's tables at a time."""
    if key not in _kept:
        if _kept:
            _kept.clear()
            gc.unfreeze()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # where the C library has no such function
                ctypes.CDLL(None).malloc_trim(0)
        _kept[key] = make()
    return _kept[key]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def write_stage(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table of its own in the shared folder, read again."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
