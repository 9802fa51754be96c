"""Shared folders, stored tables, size-checked broadcasts and gapless prefix sums."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A table of at most this many rows (bounded row width) may be broadcast.
MAX_BROADCAST_ROWS = 100_000

#: Steps of known, few rows run in as many tasks as these need: one for TASK_ROWS, FEW_TASKS at least.
TASK_ROWS = 20_000
FEW_TASKS = 8

#: With this, Spark drops a query's shuffle files when the query ends, not when the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed (local runs)."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder below the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return (base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_llm").rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files behind; the session's own setting comes back after."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage is cut, lost executors lose nothing."""
    path = work_path(spark, name)
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder and the path within it: a mounted folder, hdfs, s3 or gs."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    store, path = file_system(uri)
    store.create_dir(path, recursive=True)


def write_file(uri: str, parts: Sequence[bytes]) -> None:
    store, path = file_system(uri)
    with store.open_output_stream(path, compression=None) as out:
        for part in parts:
            out.write(part)


def open_file(uri: str):
    store, path = file_system(uri)
    return store.open_input_file(path)


def fitted(df: DataFrame, rows: int, a_task: int = TASK_ROWS) -> DataFrame:
    """df, which has about so many rows after a shuffle, in no more tasks than these need; without another shuffle."""
    return df.coalesce(max(FEW_TASKS, -(-rows // a_task)))


def is_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint only after its rows were counted; else a plain shuffled join follows."""
    return F.broadcast(df) if is_small(df, limit) else df


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Null-safe equality of the columns, for joins."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def running_total(
    df: DataFrame,
    amount: str,
    keys: Sequence[str],
    block: str,
    order: Sequence[Column],
    name: str,
) -> DataFrame:
    """Adds `name`: the sum of `amount` over all rows of the same keys that come before the row.

    Rows come in the order of `block` (an integer that splits a key's rows into even parts) and,
    within a block, of `order`. No task holds more than a block of a key: block sums are added up
    first (one row per key and block), then each block runs on from its offset.
    """
    sums = df.groupBy(*keys, block).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(block).alias("_block"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
    )
    joined = F.col(block) == F.col("_block")
    for i, k in enumerate(keys):
        joined = joined & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = df.withColumn("_upto", F.sum(amount).over(inside))
    return (
        summed.join(offsets, joined)
        .withColumn(name, (F.col("_offset") + F.col("_upto") - F.col(amount)).cast("long"))
        .drop("_upto", "_offset", "_block", *[f"_k{i}" for i in range(len(keys))])
    )
