"""Parquet tables: reads, full refresh, partition-wise upsert, audits, snapshots.

A table is a folder of versions. A write puts its partitions whole into a new folder and then commits by
one small file in ``_commits``, which names the folder of every partition and appears by a rename. A reader takes
the newest commit, so it sees a table before or after a write, never between, and changes nothing. What a writer
left without a commit is never read. One writer at a time owns a table: a second one that commits the same
number fails. ``vacuum`` removes folders that the newest commits do not name.
"""
from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.schemas import conform
from barloom.sources.upsert import merge_upsert

PART = "event_part"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    A session in one process (``local[n]``, as in tests) that names no such folder gets a
    temporary one; on a cluster that is an error, as executors would write to their own disks.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="barloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """Rows written once to the shared scratch folder, for work that reads them several times."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "stored")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    return jpath(path).getFileSystem(spark._jsc.hadoopConfiguration()), jpath


@dataclass(frozen=True)
class Commit:
    """State of a table: its number, the folder of each partition, and the last batch applied per stream."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def _commit_numbers(spark: SparkSession, path: str) -> list[int]:
    fs, jpath = _fs(spark, path)
    folder = jpath(f"{path}/_commits")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))


def last_commit(spark: SparkSession, path: str, number: int | None = None) -> Commit:
    numbers = _commit_numbers(spark, path)
    if not numbers:
        return Commit()
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath(f"{path}/_commits/{number or numbers[-1]}.json"))
    try:
        return Commit(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, state: Commit) -> None:
    fs, jpath = _fs(spark, path)
    final = jpath(f"{path}/_commits/{state.number}.json")
    temporary = jpath(f"{path}/_commits/_{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, False)
    out.write(bytearray(json.dumps(asdict(state)), "utf-8"))
    out.close()
    if fs.exists(final) or not fs.rename(temporary, final):
        fs.delete(temporary, False)
        raise OSError(f"another writer has committed version {state.number} of {path}")


def _write_version(spark: SparkSession, path: str, rows: DataFrame) -> dict[str, str]:
    """Write laid-out rows into a new folder; the partitions it holds."""
    version = f"v-{uuid.uuid4().hex}"
    rows.write.partitionBy(PART).parquet(f"{path}/{version}")
    fs, jpath = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(jpath(f"{path}/{version}"))]
    return {n.removeprefix(f"{PART}="): version for n in names if n.startswith(f"{PART}=")}


def _read_parts(spark: SparkSession, path: str, parts: dict[str, str], schema: T.StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{v}/{PART}={p}" for p, v in sorted(parts.items())])


def vacuum(spark: SparkSession, root: str, name: str, keep: int = 10) -> int:
    """Remove version folders that none of the ``keep`` newest commits names; how many went."""
    path = f"{root}/{name}"
    numbers = _commit_numbers(spark, path)[-keep:]
    named = {v for n in numbers for v in last_commit(spark, path, n).parts.values()}
    fs, jpath = _fs(spark, path)
    gone = 0
    for status in fs.listStatus(jpath(path)) if numbers else []:
        if status.getPath().getName().startswith("v-") and status.getPath().getName() not in named:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone


def partition_of(schema: T.StructType) -> Column:
    """Write partition of a row: the day of its time, or the month of its date."""
    key = next(f for f in schema.fields if f.name in ("event_time", "event_date", "published_at"))
    return F.date_format(F.col(key.name), "yyyy-MM" if isinstance(key.dataType, T.DateType) else "yyyy-MM-dd")


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType, since: str | None = None) -> DataFrame:
    """A stored table, columns per contract; ``since`` (yyyy-MM[-dd]) prunes partitions."""
    path = f"{root}/{name}"
    parts = last_commit(spark, path).parts
    return conform(_read_parts(spark, path, {p: v for p, v in parts.items() if since is None or p >= since}, schema), schema)


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str,
    num_partitions: int, **options: str,
) -> DataFrame:
    """Parallel database read, split on ``partition_column``; credentials come in ``options``."""
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=num_partitions, properties=options,
    )


def _laid_out(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Contract columns plus the partition column; rebalanced so hot days split into several files."""
    return conform(df, schema).withColumn(PART, partition_of(schema)).hint("rebalance", PART)


def refresh_table(df: DataFrame, root: str, name: str, schema: T.StructType) -> int:
    """Replace the table by ``df``; returns the row count, read from the file footers."""
    spark, path = df.sparkSession, f"{root}/{name}"
    before = last_commit(spark, path)
    parts = _write_version(spark, path, _laid_out(df, schema))
    _commit(spark, path, Commit(before.number + 1, parts, before.batches))
    return _read_parts(spark, path, parts, schema).count()


def upsert_table(
    updates: DataFrame,
    root: str,
    name: str,
    schema: T.StructType,
    keys: Sequence[str],
    update_cols: Sequence[str],
    sequence: str | Sequence[str],
    touch: str | None = None,
    now: Column | None = None,
    batch: tuple[str, int] | None = None,
) -> None:
    """Upsert into a stored table, reading and rewriting only the partitions that the updates touch.

    ``batch`` (stream, number) makes a replay harmless: a batch that the table has already taken is passed over.
    The names of the touched partitions (days) pass the driver, as those of all partitions do in a commit.
    """
    spark, path = updates.sparkSession, f"{root}/{name}"
    before = last_commit(spark, path)
    if batch is not None and before.batches.get(batch[0], -1) >= batch[1]:
        return
    touched = {r[0] for r in updates.select(partition_of(schema)).distinct().collect()}
    target = conform(_read_parts(spark, path, {p: v for p, v in before.parts.items() if p in touched}, schema), schema)
    merged = merge_upsert(target, updates, keys, update_cols, sequence, touch, now)
    parts = _write_version(spark, path, _laid_out(merged, schema))
    batches = before.batches if batch is None else {**before.batches, batch[0]: batch[1]}
    _commit(spark, path, Commit(before.number + 1, {**before.parts, **parts}, batches))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)


def snapshot_facts(df: DataFrame, ts: str = "event_time", label: str = "target_direction") -> DataFrame:
    """One row: rows, date range and class balance of a training table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("first_time"),
        F.max(ts).alias("last_time"),
        F.count_if(F.col(label) == 1).alias("n_up"),
        F.count_if(F.col(label) == 0).alias("n_not_up"),
    ).withColumn("up_share", F.round(F.try_divide(F.col("n_up"), F.col("rows")), 4))


def export_snapshot(df: DataFrame, root: str, day: str) -> str:
    """Dated Parquet copy of a training table with a JSON sidecar of its facts."""
    path = f"{root}/snapshots/intraday_{day}"
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    frozen = df.sparkSession.read.parquet(f"{path}.parquet")
    snapshot_facts(frozen).write.mode("overwrite").json(f"{path}.json")
    return path
