"""Exact top-k by inner product: columnar branch and bound.

Vectors are turned into integers and laid out vertically, in blocks of candidates with one row
per dimension. For each query the inner products grow dimension block by dimension block; before
each further block, the largest product that the remaining dimensions could still add (the
product of both remaining norms) is compared with the query's k-th best score so far, and only
the candidates that could reach it are kept, compacted.

Candidate blocks are sorted by norm, the largest first. Queries go round in chunks of bounded
size, which every task holds: the first blocks give each query of the chunk a floor, its k-th
best score there, and the other blocks are searched from that floor on. A block whose largest
norm can't reach a query's floor is skipped for it. Candidates are dealt to tasks once for each
chunk and never copied for each block of queries; a task returns at most k rows per query.

Defined cases: vectors that are null, of another length than most, or hold a null or non-finite
component take no part. Equal scores go to the smaller id. Rows that repeat an id are separate
candidates, but none of them is a candidate of that id's query; a repeated query counts once, with
its smallest vector. With fewer than k candidates all are returned; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.spread import running_totals
from tallybook.session import materialize, scratch_path

SCALE = 64
#: Vectors in a block, queries in a block, bytes of queries in a chunk, and blocks that give floors.
BLOCK = 4096
QUERY_BLOCK = 1024
CHUNK_BYTES = 4 << 20
FIRST_BLOCKS = 4
#: Dimensions added between two comparisons.
STEP = 16
#: Up to this component, sums of products are exact in double precision.
EXACT = 1 << 20


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def to_integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def _small(values: np.ndarray) -> bytes:
    """Components in as few bytes as hold all of them; the first byte says how many."""
    for width in (1, 2, 4):
        if not values.size or (values.min() >= -(1 << 8 * width - 1) and values.max() < 1 << 8 * width - 1):
            return bytes([width]) + values.astype(f"<i{width}").tobytes()
    return b"\10" + values.astype("<i8").tobytes()


def _tall(ids: bytes, columns: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and components with one row per dimension."""
    own = np.frombuffer(ids, "<i8")
    return own, np.frombuffer(columns, f"<i{columns[0]}", offset=1).reshape(-1, len(own))


def search_block(query_ids, queries, ids, columns, k: int, best: dict[int, tuple[np.ndarray, np.ndarray]], floors: np.ndarray | None = None) -> None:
    """Improve `best` (query number to scores and ids) with a block of candidates.

    `queries` has one row per query, `columns` one row per dimension. Candidates below a query's
    entry in `floors` are left out.
    """
    dims = columns.shape[0]
    kind = np.float64 if max(np.abs(columns).max(initial=0), np.abs(queries).max(initial=0)) < EXACT else np.int64
    columns, queries = columns.astype(kind), queries.astype(kind)
    cuts = list(range(0, dims, STEP)) + [dims]
    # Norms of what is left from each cut on, of candidates and of queries.
    left = [np.sqrt((columns[c:].astype(np.float64) ** 2).sum(axis=0)) for c in cuts]
    own_left = [np.sqrt((queries[:, c:].astype(np.float64) ** 2).sum(axis=1)) for c in cuts]
    longest = left[0].max(initial=0.0)
    for number, query in enumerate(queries):
        scores, found = best.get(number, (np.zeros(0, kind), np.zeros(0, np.int64)))
        floor = scores.min() if len(scores) >= k else -np.inf
        if floors is not None:
            floor = max(floor, floors[number])
        # Rounded up here and below, so that a candidate that could tie is kept.
        if own_left[0][number] * longest * (1 + 1e-9) + 1e-3 < floor:
            continue
        alive = None
        sums = np.zeros(columns.shape[1], kind)
        for at, (begin, end) in enumerate(zip(cuts, cuts[1:])):
            part = columns[begin:end] if alive is None else columns[begin:end, alive]
            sums = sums + query[begin:end] @ part
            if floor == -np.inf or end == dims:
                continue
            rest = left[at + 1] if alive is None else left[at + 1][alive]
            bound = sums + own_left[at + 1][number] * rest * (1 + 1e-9) + 1e-3
            keep = np.flatnonzero(bound >= floor)
            if len(keep) < len(sums) // 2:
                alive = keep if alive is None else alive[keep]
                sums = sums[keep]
                if not len(keep):
                    break
        own = ids if alive is None else ids[alive]
        fit = (own != query_ids[number]) & (sums >= floor)
        scores, found = np.concatenate([scores, sums[fit]]), np.concatenate([found, own[fit]])
        if len(scores) > k:
            limit = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = scores >= limit
            scores, found = scores[near], found[near]
            order = np.lexsort((found, -scores))[:k]
            scores, found = scores[order], found[order]
        best[number] = (scores, found)


_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _searcher(k: int, shared):
    """Search blocks of candidates for a chunk of queries: (ids, rows, floors) for each of its blocks."""

    def search(batches):
        chunk = shared.value
        best: list[dict[int, tuple[np.ndarray, np.ndarray]]] = [{} for _ in chunk]
        for batch in batches:
            for row in batch.to_pylist():
                ids, columns = _tall(row["ids"], row["columns"])
                for (query_ids, queries, floors), own in zip(chunk, best):
                    search_block(query_ids, queries, ids, columns, k, own, floors)
        for (query_ids, _, _), own in zip(chunk, best):
            some = [(number, *pair) for number, pair in own.items() if len(pair[0])]
            if some:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids[[n for n, _, _ in some]], [len(x) for _, x, _ in some])),
                        pa.array(np.concatenate([f for _, _, f in some])),
                        pa.array(np.concatenate([x for _, x, _ in some]).astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return search


def _blocks(rows: DataFrame, size: int, order: list[Column], label: str) -> DataFrame:
    """Blocks of `size` vectors in this order, numbered from 0."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = running_totals(rows, [], order, F.lit(1), partitions)
    placed = placed.withColumn("block", F.floor(F.col("before") / size).cast("bigint"))

    def together(key, group):
        tall = np.ascontiguousarray(np.array(group["ints"].tolist(), dtype=np.int64).T)
        return pd.DataFrame({"block": [key[0]], "ids": [group["vec_id"].to_numpy("<i8").tobytes()], "columns": [_small(tall)]})

    return materialize(
        placed.select("block", "vec_id", "ints").groupBy("block").applyInPandas(together, "block bigint, ids binary, columns binary"), label
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of highest integer inner product per query.

    `is_query` is a condition on vec_id. Every usable row is a candidate of all queries but its own.
    """
    spark = vectors.sparkSession
    usable_rows = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector_column}`").alias("v")).where(
        usable(F.col("v")) & F.col("vec_id").isNotNull()
    )
    rows = usable_rows.select("vec_id", to_integers(F.col("v")).alias("ints"))
    norm = F.aggregate("ints", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = materialize(rows.withColumn("norm", norm), "vectors")
    # The number of dimensions that most vectors have; the rest can't be compared.
    common = rows.groupBy(F.size("ints").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("ints") == (common["d"] if common else 0))
    candidates = _blocks(rows, BLOCK, [F.desc("norm"), F.col("vec_id"), F.xxhash64("ints")], "candidates")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    queries = _blocks(asked, QUERY_BLOCK, [F.col("vec_id")], "queries")
    sizes = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("columns")).alias("largest")).first()
    n_blocks = candidates.count()
    per_chunk = max(1, CHUNK_BYTES // max(1, sizes.largest or 1))
    partitions = max(1, min(n_blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks // 16)))
    first, others = F.col("block") < FIRST_BLOCKS, F.col("block") >= FIRST_BLOCKS
    path = scratch_path(spark, "found")
    for begin in range(0, sizes.n, per_chunk):
        # At most CHUNK_BYTES, or one block, whatever the number of queries.
        held = queries.where(F.col("block").between(begin, begin + per_chunk - 1)).orderBy("block").collect()
        chunk = [(ids, np.ascontiguousarray(tall.T)) for ids, tall in (_tall(r.ids, r.columns) for r in held)]
        shared = spark.sparkContext.broadcast([(ids, tall, None) for ids, tall in chunk])
        blocks = candidates.where(first).repartition(FIRST_BLOCKS, "block")
        near = materialize(_ranked(blocks.mapInArrow(_searcher(k, shared), _FOUND), k), "first-found")
        # One floor for each query of the chunk that has k candidates by now.
        floor_of = {r.query_id: r.score for r in near.where(F.col("rank") == k).select("query_id", "score").collect()}
        floors = [np.array([floor_of.get(i, -np.inf) for i in ids.tolist()], dtype=np.float64) for ids, _ in chunk]
        shared = spark.sparkContext.broadcast([(ids, tall, floor) for (ids, tall), floor in zip(chunk, floors)])
        far = candidates.where(others).repartition(partitions, "block").mapInArrow(_searcher(k, shared), _FOUND)
        _ranked(near.drop("rank").unionByName(far), k).write.mode("append").parquet(path)
    found = spark.read.schema(f"{_FOUND}, rank int").parquet(path) if sizes.n else spark.createDataFrame([], f"{_FOUND}, rank int")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
