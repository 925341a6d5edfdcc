"""Helpers shared by the operators: staging in the shared folder, document hashes, row ids, memory of Python workers."""
from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.sources.tables import scratch_dir


def stage(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written as Parquet to the cluster's shared folder and read back.

    Cuts the lineage: an executor lost later costs a reread of files, not a recomputation.
    """
    path, schema = scratch_dir(df.sparkSession, purpose), df.schema
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def first_n_rank(df: DataFrame, order: Sequence[Column], rank: str, purpose: str) -> DataFrame:
    """``df`` staged in a global order with its dense position (0, 1, ...) as column ``rank``.

    The sort is a range shuffle; only one count per partition meets in one task.
    """
    ordered = df.orderBy(*order).select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
    placed = stage(ordered, purpose)
    part, at = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(
        "part",
        (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    return (
        placed.withColumn("part", part).join(before, "part")
        .select("row.*", (F.col("before") + at).alias(rank))
    )


_held: dict[Hashable, object] = {}


def give_back() -> None:
    """Return freed memory to the system; Spark's workers go on to other stages beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def only_model(key: Hashable, build: Callable[[], object]) -> object:
    """The model named ``key``, kept by this process between tasks; that of another operator is given back."""
    if key not in _held:
        _held.clear()
        gc.collect()
        give_back()
        _held[key] = build()
    return _held[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
