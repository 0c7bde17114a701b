"""Exact top-k inner products with a pivot-distance index.

Vectors x get one more component, sqrt(M - |x|^2) with M the largest squared length, so that all have the same length;
then |q - x|^2 = |q|^2 + M - 2 q.x for a query q with a zero there, and the largest inner products are the nearest
points. Each vector is keyed by its nearest pivot and the distance to it; sorted by that key, blocks of vectors
are annuli around pivots. A first round opens the annuli next to each query; its k-th score gives a radius r, and by
the triangle inequality no block outside [d(q, p) - r, d(q, p) + r] around any pivot p can hold a better one. A second
round opens the rest. Blocks stay where they are; a query travels to the blocks that it opens, and leaves with k scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyloom.llm import arrays
from surveyloom.llm.chunks import partitions, rows_of, written
from surveyloom.session import ship_package

PIVOTS = 64
FIT_ROWS = 4096  # the bounded sample that pivots are chosen from
BLOCK = 512
FIRST_BLOCKS = 2
SLACK = 1e-6  # of a distance, for rounding


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id and `v`, floor(scale * x) of each component as little-endian 64-bit integers.

    Rows with a null id, a null vector, or a null or non-finite component drop. Shorter vectors are padded with zeros.
    Rows that repeat a vec_id count once, with the smallest vector.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & sound)
    width = rows.agg(F.max(F.size("e"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            sizes = np.diff(lists.offsets.to_numpy())
            out = np.zeros((len(sizes), width), "<i8")
            out[np.arange(width) < sizes[:, None]] = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([x.tobytes() for x in out], pa.binary())], ["vec_id", "v"])

    return rows.mapInArrow(arrays.released(pack), "vec_id long, v binary").groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i8").reshape(len(blobs), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point while every partial sum is below 2 ** 53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _lifted(x: np.ndarray, most: int) -> np.ndarray:
    """Vectors with the component that gives all the same length."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def fit_pivots(sample: np.ndarray, most: int, n: int = PIVOTS, rounds: int = 5) -> np.ndarray:
    """Centres of a few rounds of k-means over the sample, begun at evenly spaced rows."""
    points = _lifted(sample, most)
    centres = points[np.linspace(0, len(points) - 1, min(n, len(points))).astype(int)]
    for _ in range(rounds):
        nearest = _distances(points, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def distinct(vectors: DataFrame, most_ids: int) -> DataFrame:
    """Each distinct vector with its smallest ids, folded in every batch before the shuffle.

    A vector that many rows share costs one row a batch; ids beyond `most_ids` can't be among a query's results.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[bytes, list[int]] = {}
            for vector, id_ in sorted(zip(batch.column("v").to_pylist(), batch.column("vec_id").to_pylist())):
                ids = best.setdefault(vector, [])
                if len(ids) < most_ids:
                    ids.append(id_)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.binary()), pa.array(list(best.values()), pa.list_(pa.int64()))], ["v", "ids"]
            )

    folded = vectors.mapInArrow(arrays.released(fold), "v binary, ids array<long>")
    return folded.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, most_ids).alias("ids"))


BLOCKS = "block long, pivot int, low double, high double, vectors binary, ids binary"


def build_index(rows: DataFrame, pivots: np.ndarray, most: int, most_ids: int) -> DataFrame:
    """Blocks of vectors around one pivot each, by distance, as a written table."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = _distances(_lifted(_matrix(batch.column("v").to_pylist()), most), pivots)
            nearest = away.argmin(axis=1)
            columns = [pa.array(nearest, pa.int32()), pa.array(away[np.arange(len(nearest)), nearest]), batch.column("v"), batch.column("ids")]
            yield pa.RecordBatch.from_arrays(columns, ["pivot", "away", "v", "ids"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, []

        def row():
            ids = np.full((len(held), most_ids), -1, "<i8")
            known = np.zeros((len(held), most_ids), bool)
            for i, x in enumerate(held):
                ids[i, : len(x["ids"])], known[i, : len(x["ids"])] = x["ids"], True
            values = [
                TaskContext.get().partitionId() * (1 << 32) + number,
                held[0]["pivot"],
                held[0]["away"],
                held[-1]["away"],
                b"".join(x["v"] for x in held),
                known.tobytes() + ids.tobytes(),
            ]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["block", "pivot", "low", "high", "vectors", "ids"])

        for x in rows_of(batches):
            if held and (len(held) == BLOCK or held[0]["pivot"] != x["pivot"]):
                yield row()
                number, held = number + 1, []
            held.append(x)
        if held:
            yield row()

    keyed = rows.mapInArrow(arrays.released(key), "pivot int, away double, v binary, ids array<long>")
    ranged = keyed.repartitionByRange(partitions(rows.sparkSession), "pivot", "away").sortWithinPartitions("pivot", "away")
    return written(ranged.mapInArrow(arrays.released(block), BLOCKS), "blocks")


def _search(blocks: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """The k best of each visited block, for each visit (block, query_id, q): query_id, vec_id, score.

    Blocks and visits meet sorted by block, the block first, so a task holds one block and some queries at a time.
    """
    left = blocks.select("block", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("query_id"), "vectors", "ids")
    right = visits.select("block", F.lit(1).alias("kind"), "query_id", F.col("q").alias("vectors"), F.lit(None).cast("binary").alias("ids"))
    dealt = left.unionByName(right).repartition(partitions(blocks.sparkSession), "block").sortWithinPartitions("block", "kind")
    most_ids = k + 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = ids = known = None
        waiting: list[tuple[int, bytes]] = []

        def best():
            scores = _products(_matrix([q for _, q in waiting]), vectors)
            out = [[], [], []]
            for (query, _), row in zip(waiting, scores):
                if len(row) > most_ids:  # one more than k, as the query's own vector may be there alone
                    floor = np.partition(row, len(row) - most_ids)[len(row) - most_ids]
                    take = np.flatnonzero(row >= floor)
                else:
                    take = np.arange(len(row))
                there = known[take] & (ids[take] != query)
                found, points = ids[take][there], np.broadcast_to(row[take][:, None], there.shape)[there]
                top = np.lexsort((found, -points))[:k]
                out[0] += [query] * len(top)
                out[1] += found[top].tolist()
                out[2] += points[top].tolist()
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["query_id", "vec_id", "score"])

        for x in rows_of(batches):
            if x["kind"] == 0 or len(waiting) == 256:
                if waiting:
                    yield best()
            if x["kind"] == 0:
                blob = x["ids"]
                n = len(blob) // (9 * most_ids)
                known = np.frombuffer(blob[: n * most_ids], bool).reshape(n, most_ids)
                ids = np.frombuffer(blob[n * most_ids :], "<i8").reshape(n, most_ids)
                vectors = np.frombuffer(x["vectors"], "<i8").reshape(n, -1)
            else:
                waiting.append((x["query_id"], x["vectors"]))
        if waiting:
            yield best()

    return dealt.mapInArrow(arrays.released(search), "query_id long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """The k largest inner products of each query with all other vectors: query_id, rank (from 1), vec_id, score.

    Takes vec_id and embedding; `is_query` is a condition on vec_id. Ties go to the smaller vec_id; a query with fewer
    candidates returns all. For nulls, repeated ids and lengths see `quantised`. Exact while inner products fit 64 bits;
    distances, which only steer, are floating point with some slack. No rows give no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = written(quantised(vectors, scale), "vectors")

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column("v").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([int((m * m).sum(axis=1).max(initial=0))], pa.int64())], ["square"])

    most = rows.mapInArrow(arrays.released(squares), "square long").agg(F.max("square")).first()[0] or 0
    unique = written(distinct(rows, k + 1), "distinct")
    sample = [bytes(r["v"]) for r in unique.select("v").orderBy(F.xxhash64("v"), "v").limit(FIT_ROWS).collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = fit_pivots(_matrix(sample), most)
    blocks = build_index(unique, pivots, most, k + 1)
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    places = blocks.select("block", "pivot", "low", "high")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distances of each query to all pivots, and its squared length."""
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("q").to_pylist()).astype(np.float64)
            away = _distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1), pivots)
            columns = [batch.column("query_id"), batch.column("q"), pa.array((q * q).sum(axis=1)), pa.array(list(away), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "q", "square", "away"])

    seen = written(queries.mapInArrow(arrays.released(reach), "query_id long, q binary, square double, away array<double>"), "queries")
    near = seen.select("query_id", "q", F.array_min("away").alias("d"), (F.array_position("away", F.array_min("away")) - 1).cast("int").alias("pivot"))
    gap = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))
    order = W.partitionBy("query_id").orderBy(gap, "block")
    first = near.join(places, "pivot").withColumn("n", F.row_number().over(order)).where(F.col("n") <= FIRST_BLOCKS)
    floors = _top(_search(blocks, first, k), k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("found"))
    radius = F.when(F.col("found") == k, F.sqrt(F.greatest(F.col("square") + F.lit(float(most)) - 2 * F.col("floor"), F.lit(0.0))))
    bound = seen.join(floors, "query_id", "left").withColumn("r", F.coalesce(radius, F.lit(float("inf"))))
    bound = bound.withColumn("r", F.col("r") * (1 + SLACK) + F.lit(SLACK * (1 + float(most) ** 0.5)))
    rings = bound.select("query_id", "q", "r", F.posexplode("away").alias("pivot", "d"))
    hit = (F.col("high") >= F.col("d") - F.col("r")) & (F.col("low") <= F.col("d") + F.col("r"))
    visits = rings.join(places, "pivot").where(hit).select("block", "query_id", "q")
    return _top(_search(blocks, visits, k), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
