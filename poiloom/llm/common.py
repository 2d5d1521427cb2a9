"""What the operators share: tables in the shared folder, ranks within groups, word splitting."""

from __future__ import annotations

import atexit
import pickle
import shutil
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word, wherever an operator counts or compares words.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows per row of a Python worker's input batch; texts may be long.
ARROW_ROWS = 512
ARROW_BYTES = "16m"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A driver-made lookup of at most so many bytes (pickled) is broadcast, a larger one is joined by shuffle.
BROADCAST_BYTES = 16 << 20
#: A stored table of at most so many bytes (compressed) is broadcast whole by spread_join().
SIDE_BYTES = 4 << 20
#: A key with more than 1 / HOT of all rows is joined by broadcast: there are at most HOT of them.
HOT = 20_000
#: Paths of the tables that this process wrote, oldest first: see drop_tables().
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="poiloom-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    _written.append(f"{shared_dir(spark)}/poiloom/{what}-{uuid.uuid4().hex}")
    return _written[-1]


def table_mark() -> int:
    """Where the tables that are written from now on begin, for drop_tables()."""
    return len(_written)


def drop_tables(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> None:
    """Deletes the tables written since a mark, but for those in keep: to be called when what reads them is itself written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = [p for p in _written[since:] if p not in keep]
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    _written[since:] = [p for p in _written[since:] if p in keep]


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again: later plans start there, whatever executors are lost."""
    spark = df.sparkSession
    path = new_path(spark, what)
    # its shuffles are of no use once the table is there
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Arrow batch holds, by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def process_cache(name: str, make: Callable[[], object]) -> object:
    """One object per worker process: functions are sent by value, so module globals would be new in each task."""
    home = sys.modules.setdefault("_poiloom_process_cache", types.ModuleType("_poiloom_process_cache"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def lookup(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """rows as a frame, marked for broadcast only if they are small in bytes."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(pickle.dumps(rows)) <= BROADCAST_BYTES else df


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: str, total: int) -> DataFrame:
    """left with right's columns by keys (nulls are equal), unmatched rows with nulls; no task gets all rows of a hot key.

    right: a stored table, one row for each key, with how many rows of left have it (column
    rows, left out of the result). If its files are small, it is broadcast and left stays where
    it is. Else keys of more than total / HOT rows, at most HOT of them, are broadcast, and the
    other keys are joined by shuffle.
    """
    limit = max(total // HOT, 1)
    names = {k: f"_key_{k}" for k in keys}
    small = right.withColumnsRenamed(names)
    extra = [c for c in right.columns if c not in (*keys, rows)]
    size = int(str(right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    def on(a: DataFrame, b: DataFrame) -> Column:
        found = F.lit(True)
        for k, own in names.items():
            found = found & a[k].eqNullSafe(b[own])
        return found

    if size <= SIDE_BYTES:
        return left.join(F.broadcast(small.drop(rows)), on(left, small), "left").select(*left.columns, *extra)
    hot = small.where(F.col(rows) > limit).drop(rows).withColumnsRenamed({c: f"_hot_{c}" for c in extra}).withColumn("_hot", F.lit(True))
    marked = left.join(F.broadcast(hot), on(left, hot), "left").drop(*names.values())
    cold = small.where(F.col(rows) <= limit).drop(rows).withColumnsRenamed({c: f"_cold_{c}" for c in extra})
    # rows of hot keys look for a key that isn't there, each for one of many
    salt = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)) + 1).otherwise(F.lit(0))
    marked, cold = marked.withColumn("_salt", salt), cold.withColumn("_no_salt", F.lit(0).cast("long"))
    found = marked.join(cold, on(marked, cold) & (F.col("_salt") == F.col("_no_salt")), "left")
    return found.select(*left.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in extra])


def ranked(df: DataFrame, group: str, order: Sequence[str], what: str) -> DataFrame:
    """df with group_rank: from 0 within each value of group (null is a value), by order, ascending.

    A group may hold any share of the rows. The rows are dealt out by range of (group, order)
    and sorted there; of each pair of partition and group only the count is looked at again:
    a row's rank is its place in its partition plus what stands before it. No group has more
    counts than there are partitions. Ties get ranks in any order. The sorted rows are stored,
    so the second look sees the same places.
    """
    spark = df.sparkSession
    keys = [F.col(group), *map(F.col, order)]
    spread = df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    at = F.col("_at")
    kept = stored(spread.withColumn("_at", F.monotonically_increasing_id()), what)
    kept = kept.withColumn("_part", F.shiftright(at, 33)).withColumn("_place", at.bitwiseAND(F.lit((1 << 33) - 1)))
    counts = kept.groupBy(F.col("_part").alias("p"), F.col(group).alias("g")).agg(F.min("_place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    shift = stored(counts.select("p", "g", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")), f"{what}-shifts")
    joined = kept.join(shift, (F.col("_part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")), "left")
    return joined.withColumn("group_rank", F.col("_place") + F.col("shift")).drop("_at", "_part", "_place", "p", "g", "shift")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def own_names(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; a missing one is an error that says so."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df.select(*names)

