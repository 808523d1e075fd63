"""Helpers that several operators share: cut points, scratch folders, word splitting, hashing."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = 1000  # rows per Arrow batch: whole texts make 10,000-row batches tens of MB each

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Unset, a temporary folder is set in local mode only; elsewhere it is an error, since a folder of
    one machine is not seen by the others.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lapline-checkpoint-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/lapline-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_dealt(df: DataFrame) -> DataFrame:
    """As :func:`cut` for a frame dealt by key (``repartition(n, key)``), which stays dealt: a later grouping by the key
    moves only the other side.  Spark keeps the partitioning of a checkpoint whose plan is not adaptive."""
    spark, key = df.sparkSession, "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return cut(df.select("*"))
    finally:
        spark.conf.set(key, before)


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lower the Arrow batch size of the session to ``rows``; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wrapping arithmetic on uint64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return the memory that this worker has freed to the machine: Arrow's pool and the allocator keep it otherwise, and an idle
    worker of one stage counts beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; bytes.split() cuts at exactly these six characters."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def native_words(text):
    """Column: the words ``[^\\x20\\x09-\\x0D]+`` of a text; null text: no words."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(flat, " "), "")


def local_temp(prefix: str) -> str:
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TMPDIR"))
