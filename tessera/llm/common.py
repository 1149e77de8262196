"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send a module's functions to Python workers by value, so that executors need not have the package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a data folder, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the session names none, a local session (as in tests) sets a temporary folder
    once; on a cluster that would not be shared, so there it is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-checkpoint-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


class Scratch:
    """Intermediate tables in the shared folder; they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        path, files = self._path(self.root)
        files.deleteOnExit(path)  # results are read lazily, so what is left goes with the application

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write a table and read it back."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._tessera_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        path, files = self._path(df._tessera_path)
        files.delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


RANGES = 4096


def hashed_key(*columns: Column | str) -> Column:
    """A hash of 63 bits, never negative."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def cut_below(df: DataFrame, key: Column, most: int, top: int = 1 << 63) -> int | None:
    """The greatest cut such that at most ``most`` rows have a key below it; None where all rows fit.

    Keys are integers in [0, top). Each round counts the rows of ``RANGES`` equal ranges exactly
    and goes on inside the one in which the cut falls; rows of equal keys are never parted.
    """
    keys = df.select(key.alias("k"))
    low, high, left = 0, top, most
    while high - low > 1:
        step = -(-(high - low) // RANGES)
        inside = keys.filter((F.col("k") >= low) & (F.col("k") <= high - 1))
        counted = inside.groupBy(F.expr(f"(k - {low}L) div {step}L").alias("r")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counted):
            if r["n"] > left:
                break
            left -= r["n"]
        else:
            return None
        low, high = low + r["r"] * step, min(high, low + (r["r"] + 1) * step)
        if r["n"] <= RANGES:  # few enough to look at
            rest = sorted(x["k"] for x in keys.filter((F.col("k") >= low) & (F.col("k") <= high - 1)).collect())
            return rest[left]
    return low
