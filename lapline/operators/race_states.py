"""Q06-Q10 kept up to date: partial states of the races, one set per batch, merged when they are read.

A state holds for one Link what the per-race questions need and what adds up over batches: the number of swimmers, the
number and the hundredths of the timed ones, and the best time.  A batch writes its states to its own folder
``batches/batch_id=<n>``, so a batch that runs again replaces itself.  ``merge`` folds all batches up to a number into
one folder ``merged/upto=<n>``; a batch that comes again after that is counted there already and is passed over.  A folder
counts once its write has committed, so a failed write or merge leaves the answers as they were.

New rows are aggregated before their shuffle and the older ones are never read again: an answer reads one state a race
from the merged folder and from each batch since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline import schema as S
from lapline.functions.times import centis, half_up_mean
from lapline.sources.tables import path_exists

STATES = T.StructType([
    T.StructField("Link", T.StringType()),
    T.StructField("swimmers", T.LongType()),
    T.StructField("timed", T.LongType()),
    T.StructField("total_cs", T.LongType()),
    T.StructField("fastest_time", T.DoubleType()),
])


def states_of(rows: DataFrame) -> DataFrame:
    """States of typed rows (``Link``, ``final_time`` in seconds); a null Link is a race, null times count as swimmers."""
    time = F.col("final_time")
    return rows.groupBy("Link").agg(
        F.count(F.lit(1)).alias("swimmers"), F.count(time).alias("timed"),
        F.coalesce(F.sum(centis(time)), F.lit(0)).cast("bigint").alias("total_cs"), F.min(time).alias("fastest_time"))


def combine(states: DataFrame) -> DataFrame:
    """One state a race from any number of them."""
    return states.groupBy("Link").agg(
        F.sum("swimmers").alias("swimmers"), F.sum("timed").alias("timed"),
        F.sum("total_cs").alias("total_cs"), F.min("fastest_time").alias("fastest_time"))


def _committed(spark: SparkSession, folder: str, key: str) -> list[int]:
    """Numbers n, ascending, of the folders ``<key>=<n>`` whose write has committed."""
    if not path_exists(spark, folder):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{key}=") and path_exists(spark, f"{folder}/{n}/_SUCCESS"))


def _parts(spark: SparkSession, store: str, upto: int | None = None) -> tuple[int | None, list[str]]:
    """Number of the newest merge and the folders that hold every row once, up to batch ``upto`` (None: all)."""
    store = store.rstrip("/")
    merges = [n for n in _committed(spark, f"{store}/merged", "upto") if upto is None or n <= upto]
    last = merges[-1] if merges else None
    batches = [n for n in _committed(spark, f"{store}/batches", "batch_id")
               if (last is None or n > last) and (upto is None or n <= upto)]
    return last, ([f"{store}/merged/upto={last}"] if merges else []) + [f"{store}/batches/batch_id={n}" for n in batches]


def add_batch(spark: SparkSession, rows: DataFrame, store: str, batch_id: int) -> bool:
    """Store the states of one batch of typed rows; False when a merge holds the batch already (nothing is written)."""
    last, _ = _parts(spark, store)
    if last is not None and batch_id <= last:
        return False
    states_of(rows).write.mode("overwrite").parquet(f"{store.rstrip('/')}/batches/batch_id={batch_id}")
    return True


def merge(spark: SparkSession, store: str, upto: int) -> None:
    """Fold the batches up to ``upto`` into one state a race.  All of them must be there: later ones of these numbers
    are passed over.  The older folders stay until the caller removes them, for readers that still use them."""
    last, folders = _parts(spark, store, upto)
    if folders and last != upto:
        combine(spark.read.schema(STATES).parquet(*folders)).write.mode("overwrite").parquet(
            f"{store.rstrip('/')}/merged/upto={upto}")


def current(spark: SparkSession, store: str) -> DataFrame:
    """One state a race over everything stored; no row where nothing is."""
    _, folders = _parts(spark, store)
    return combine(spark.read.schema(STATES).parquet(*folders)) if folders else S.empty(spark, STATES)


def swimmers_per_race(states: DataFrame, n: int | None = None) -> DataFrame:
    """Q06/Q08 from states."""
    out = states.select("Link", F.col("swimmers").alias("swimmer_count")).orderBy(
        F.col("swimmer_count").desc(), F.col("Link").asc_nulls_first())
    return out.limit(n) if n else out


def fastest_per_race(states: DataFrame, n: int | None = None) -> DataFrame:
    """Q07/Q09 from states."""
    out = states.filter(F.col("timed") > 0).select("Link", "fastest_time").orderBy(
        F.col("fastest_time").asc(), F.col("Link").asc_nulls_first())
    return out.limit(n) if n else out


def avg_final_per_race(states: DataFrame) -> DataFrame:
    """Q10 from states."""
    return (states.filter(F.col("timed") > 0)
            .select("Link", half_up_mean(F.col("total_cs"), F.col("timed"), 2).alias("avg_final_time"))
            .orderBy(F.col("avg_final_time").asc(), F.col("Link").asc_nulls_first()))
