"""Cosine top-k of a stored vector table against a set of query vectors."""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.series import attach

# Rows of the store and of the query set that meet in one task, and queries multiplied at once inside it.
STORE_BLOCK = 32_768
QUERY_BLOCK = 8_192
QUERIES_AT_ONCE = 256


def mean_vectors(df: DataFrame, by: str, vector: str) -> DataFrame:
    """Component-wise mean vector per group."""
    parts = df.select(by, F.posexplode(vector).alias("i", "x")).groupBy(by, "i").agg(
        F.avg(F.col("x").cast("double")).alias("m")
    )
    return parts.groupBy(by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias(vector)
    )


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return _unit(np.stack(vectors.to_numpy()).astype(float))


def _best(unit: np.ndarray, ids, stored: np.ndarray, keys, k: int, names: tuple[str, str]) -> pd.DataFrame:
    """The ``k`` rows of a block most similar to each query of a block."""
    parts = []
    for start in range(0, len(ids), QUERIES_AT_ONCE):
        # products of differently shaped blocks differ in the last bits; equal vectors must tie in all of them
        sims = np.round(unit[start:start + QUERIES_AT_ONCE] @ stored.T, 12)
        if sims.shape[1] > k:
            edge = np.partition(sims, -k, axis=1)[:, -k][:, None]
        else:
            edge = np.full((len(sims), 1), -np.inf)
        q, col = np.nonzero(sims >= edge)
        found = pd.DataFrame({"q": q + start, names[1]: keys[col], "similarity": sims[q, col]})
        found = found.sort_values(["q", "similarity", names[1]], ascending=[True, False, True]).groupby("q").head(k)
        found[names[0]] = ids[found["q"].to_numpy()]
        parts.append(found[[*names, "similarity"]])
    return pd.concat(parts)


def _meet(store: DataFrame, asked: DataFrame, keys: list[str], k: int, vec_id: str, vector: str, query_id: str) -> DataFrame:
    """Rows of both sides that agree in ``keys`` meet in one task; the best ``k`` per query over all of them, ranked."""
    def block(held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if held.empty or wanted.empty:
            return pd.DataFrame({query_id: wanted[query_id].head(0), vec_id: held[vec_id].head(0), "similarity": pd.Series(dtype=float)})
        return _best(
            _matrix(wanted["_asked"]), wanted[query_id].to_numpy(), _matrix(held[vector]), held[vec_id].to_numpy(), k, (query_id, vec_id)
        )

    kinds = {query_id: dict(asked.dtypes)[query_id], vec_id: dict(store.dtypes)[vec_id], "similarity": "double"}
    found = store.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        block, ", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))
    w = Window.partitionBy(query_id).orderBy(F.col("similarity").desc(), vec_id)
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _spread(df: DataFrame, own: str, by: str, other: str, own_blocks, other_blocks) -> DataFrame:
    """Deal rows to blocks by the hash of ``by`` and repeat them for each block of the other side."""
    every = F.explode(F.sequence(F.lit(0), F.greatest(other_blocks, F.lit(1)) - 1))
    return df.withColumn(own, F.pmod(F.xxhash64(by), F.greatest(own_blocks, F.lit(1))).cast("int")).withColumn(other, every)


def _queries(queries: DataFrame, query_id: str, vector: str) -> DataFrame:
    return queries.where(F.col(vector).isNotNull()).select(query_id, F.col(vector).alias("_asked"))


def vector_topk(
    store: DataFrame,
    queries: DataFrame,
    k: int,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    store_block: int = STORE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` stored vectors most similar to each query, ranked; ties go to the smaller id.

    Both sides are dealt in blocks, every pair of blocks meets in one task and passes on ``k`` rows per query. The driver
    sees two counts. Rows without a vector are left out; no queries give no rows.
    """
    held, asked = store.where(F.col(vector).isNotNull()).select(vec_id, vector), _queries(queries, query_id, vector)
    of_store = F.lit(-(-store.count() // store_block))
    of_queries = F.lit(-(-queries.count() // query_block))
    return _meet(
        _spread(held, "_s", vec_id, "_q", of_store, of_queries), _spread(asked, "_q", query_id, "_s", of_queries, of_store),
        ["_q", "_s"], k, vec_id, vector, query_id,
    )


# --- index ------------------------------------------------------------------

# Rows the centres are fitted on, and how many of them stand for one centre at least.
SAMPLE_ROWS = 16_384
ROWS_PER_CENTRE = 8
CALIBRATION_QUERIES = 256


@dataclass(frozen=True)
class VectorIndex:
    """Inverted lists: every row of a store in the list of its nearest centre, and how many lists a search reads."""

    lists: DataFrame  # vec_id, vector, list
    centres: np.ndarray
    probes: int
    vec_id: str
    vector: str


def _centres(unit: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Directions that stand for groups of directions (spherical k-means from evenly spread rows)."""
    centres = unit[np.linspace(0, len(unit) - 1, count).astype(int)]
    for _ in range(rounds):
        near = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        moved = _unit(sums)
        centres = np.where(np.linalg.norm(moved, axis=1, keepdims=True) > 0, moved, centres)
    return centres


def _probes(unit: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Lists to read until, on the sample itself, ``recall`` of the ``k`` nearest other rows lie in them."""
    asked = unit[:CALIBRATION_QUERIES]
    sims = asked @ unit.T
    sims[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    nearest = np.argsort(-sims, axis=1)[:, :min(k, len(unit) - 1)]
    lists = np.argmax(unit @ centres.T, axis=1)
    rank = np.empty((len(asked), len(centres)), int)
    np.put_along_axis(rank, np.argsort(-(asked @ centres.T), axis=1), np.arange(len(centres))[None, :], axis=1)
    needed = np.sort(np.take_along_axis(rank, lists[nearest], axis=1).ravel())
    return int(needed[math.ceil(recall * len(needed)) - 1]) + 1 if len(needed) else 1


def build_index(
    store: DataFrame, path: str, k: int = 10, recall: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, lists: int | None = None,
) -> VectorIndex:
    """An index of every row of ``store``, written to ``path``.

    Centres are fitted on at most ``sample_rows`` rows, those of the least id hashes, which the driver holds. Their number is the square root of
    the store's rows, bounded by the sample. The number of lists a search reads is measured on the same sample for ``k`` and
    ``recall``; in the whole store neighbours are closer than in a sample of it.
    """
    spark, held = store.sparkSession, store.where(F.col(vector).isNotNull()).select(vec_id, vector)
    total = held.count()
    sample = held.orderBy(F.xxhash64(vec_id), vec_id).limit(sample_rows).toPandas()
    if sample.empty:
        centres, probes = np.zeros((0, 0)), 1
    else:
        unit = _matrix(sample[vector])
        count = lists or max(1, min(math.isqrt(total), len(unit) // ROWS_PER_CENTRE))
        centres = _centres(unit, count)
        probes = _probes(unit, centres, k, recall)

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not pdf.empty:
                yield pdf.assign(list=np.argmax(_matrix(pdf[vector]) @ centres.T, axis=1).astype("int32"))

    schema = T.StructType([*held.schema.fields, T.StructField("list", T.IntegerType())])
    held.mapInPandas(assigned, schema).write.mode("overwrite").parquet(path)
    return VectorIndex(spark.read.schema(schema).parquet(path), centres, probes, vec_id, vector)


def search_index(
    index: VectorIndex, queries: DataFrame, k: int, query_id: str = "query_id", probes: int | None = None,
    store_block: int = STORE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` most similar rows per query among the lists nearest to it, by exact similarity, ranked as :func:`vector_topk` does.

    A list with many rows or many queries is dealt in blocks like a store of its own.
    """
    asked, centres, probes = _queries(queries, query_id, index.vector), index.centres, probes or index.probes

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not pdf.empty and len(centres):
                lists = np.argsort(-(_matrix(pdf["_asked"]) @ centres.T), axis=1, kind="stable")[:, :probes]
                rows = np.repeat(np.arange(len(pdf)), lists.shape[1])
                yield pdf.iloc[rows].assign(list=lists.ravel().astype("int32"))

    probed = asked.mapInPandas(near, T.StructType([*asked.schema.fields, T.StructField("list", T.IntegerType())]))

    def blocks(df: DataFrame, rows: int, name: str) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))

    shape = blocks(index.lists, store_block, "_of_store").join(blocks(probed, query_block, "_of_queries"), "list")
    shape = F.broadcast(shape)  # one row per centre at most
    held = _spread(index.lists.join(shape, "list"), "_s", index.vec_id, "_q", F.col("_of_store"), F.col("_of_queries"))
    wanted = _spread(probed.join(shape, "list"), "_q", query_id, "_s", F.col("_of_queries"), F.col("_of_store"))
    drop = ("_of_store", "_of_queries")
    return _meet(held.drop(*drop), wanted.drop(*drop), ["list", "_q", "_s"], k, index.vec_id, index.vector, query_id)


def recall_of(found: DataFrame, exact: DataFrame, query_id: str = "query_id", vec_id: str = "vec_id") -> DataFrame:
    """Per query: rows of the exact answer and how many of them were found."""
    hits = found.select(query_id, vec_id, F.lit(1).alias("_hit"))
    return exact.join(hits, [query_id, vec_id], "left").groupBy(query_id).agg(
        F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("hits"))


@F.pandas_udf(T.DoubleType())
def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """Row-wise cosine similarity of two vector columns."""
    if a.empty:
        return pd.Series([], dtype=float)
    x, y = (_unit(np.stack(v.to_numpy()).astype(float)) for v in (a, b))
    return pd.Series(np.einsum("ij,ij->i", x, y))


def retrieve_context(
    articles: DataFrame,
    embeddings: DataFrame,
    questions: DataFrame,
    k: int = 5,
    lookback: str = "INTERVAL 7 DAYS",
    floor: float = 0.2,
) -> DataFrame:
    """Top-k recent articles per question (symbol, as_of, embedding); weak retrieval is flagged.

    Recent means published before ``as_of`` and within the lookback.  Articles get their vectors
    first; questions then meet the articles of their own symbol where these lie, spread over parts of the
    symbol, and of each part only k rows per question are shuffled.
    """
    asked = questions.select("symbol", "as_of", F.col("embedding").alias("_asked"))
    held = articles.select("symbol", F.col("doc_id").alias("vec_id"), "url", "published_at").join(
        embeddings.select("vec_id", "embedding"), "vec_id"
    )
    recent = attach(held, asked, "symbol", "vec_id").where(
        (F.col("published_at") < F.col("as_of")) & (F.col("published_at") >= F.col("as_of") - F.expr(lookback))
    )
    scored = recent.withColumn("similarity", cosine("embedding", "_asked"))
    w = Window.partitionBy("symbol", "as_of").orderBy(F.col("similarity").desc(), "vec_id")
    top = scored.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    return top.select(
        "symbol", "place", "vec_id", "url", "published_at", "similarity", (F.col("similarity") < floor).alias("weak")
    )
