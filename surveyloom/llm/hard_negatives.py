"""Hard negatives by threshold joins over an inverted index, after L2AP.

Rows lie in segments. For a threshold t on the product with a query of length 1, a segment's index holds, dimension by
dimension, only those rows whose remaining components, from that dimension on, have a norm of t or more: what is left out of a row has
a shorter norm than t and can't reach it alone. A search adds up partial scores dimension by dimension and drops pairs whose partial
score plus the product of both remaining norms stays below the query's threshold; what the index left out is added to the survivors.

Thresholds start high and are lowered, for the queries whose windows aren't full yet, down to the smallest score that may
count. The first join fills each anchor's positives, the second the window of negatives below each positive.
Queries travel in blocks to tasks that hold a bounded number of rows and leave with k scores each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyloom.llm import arrays
from surveyloom.llm.chunks import partitions, rows_of, written
from surveyloom.session import ship_package

SEGMENT_BYTES = 2 << 20  # of components as 64-bit integers
TASK_BYTES = 32 << 20  # of segments that a task holds while queries pass
QUERIES = 256  # of a block
GROUP = 8  # dimensions added up between two prunings
DENSE = 0.25  # a block is searched pair by pair once fewer pairs than this are left
SLACK = 1e-9  # of a bound, for rounding
STEPS = (0.8, 0.55, 0.4, 0.3, 0.2, 0.1, 0.0)  # falling thresholds, of query's length times the rows' mean length
FIRST_WINDOW = 0.3  # how much of a window the first threshold leaves open

ROWS = "vec_id long, label long, v binary, square double"
SEGMENTS = "segment long, vectors binary, labels binary, ids binary"
ASKED = "unit long, q binary, label long, low long, high long, level int"


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, label, `v`, floor(scale * x) of each component as little-endian 64-bit integers, and `square`, its squared length.

    Rows with a null id, label or vector, or a null or non-finite component, drop. Shorter vectors are padded with zeros. Rows that
    repeat a vec_id count once, with the smallest label, then vector.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & sound)
    width = rows.agg(F.max(F.size("e"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            sizes = np.diff(lists.offsets.to_numpy())
            out = np.zeros((len(sizes), width), "<i8")
            out[np.arange(width) < sizes[:, None]] = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            square = (out.astype(np.float64) ** 2).sum(axis=1)
            columns = [batch.column("vec_id"), batch.column("label"), pa.array([x.tobytes() for x in out], pa.binary()), pa.array(square)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "square"])

    packed = rows.mapInArrow(arrays.released(pack), ROWS)
    one = packed.groupBy("vec_id").agg(F.min(F.struct("label", "v", "square")).alias("_one"))
    return one.select("vec_id", "_one.label", "_one.v", "_one.square")


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i8").reshape(len(blobs), -1)


def _energy(rows: DataFrame) -> np.ndarray:
    """The sum of squares of each dimension over all rows: one row a task, folded by dimension."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                total = total + (_matrix(batch.column("v").to_pylist()).astype(np.float64) ** 2).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(np.size(total)) if np.ndim(total) else [], pa.int32()), pa.array(total if np.ndim(total) else [], pa.float64())], ["dim", "square"])

    found = rows.select("v").mapInArrow(arrays.released(sums), "dim int, square double").groupBy("dim").agg(F.sum("square").alias("square"))
    return np.array([r["square"] for r in found.orderBy("dim").collect()])


def segments(rows: DataFrame, most_ids: int) -> DataFrame:
    """Distinct vectors of one label with their smallest ids, packed; dealt out evenly, whatever their labels.

    A vector that many rows share costs one row a batch; ids beyond `most_ids` can't be among a query's results.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple[bytes, int], list[int]] = {}
            for vector, label, id_ in sorted(zip(*[batch.column(c).to_pylist() for c in ("v", "label", "vec_id")])):
                ids = best.setdefault((vector, label), [])
                if len(ids) < most_ids:
                    ids.append(id_)
            columns = [pa.array([v for v, _ in best], pa.binary()), pa.array([x for _, x in best], pa.int64()), pa.array(list(best.values()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["v", "label", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, []

        def row():
            ids = np.full((len(held), most_ids), -1, "<i8")
            for i, x in enumerate(held):
                ids[i, : len(x["ids"])] = x["ids"]
            known = np.array([len(x["ids"]) for x in held], "<i8")
            values = [
                TaskContext.get().partitionId() * (1 << 32) + number,
                b"".join(x["v"] for x in held),
                np.array([x["label"] for x in held], "<i8").tobytes(),
                known.tobytes() + ids.tobytes(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["segment", "vectors", "labels", "ids"])

        for x in rows_of(batches):
            if held and len(held) * max(8, len(x["v"])) >= SEGMENT_BYTES:
                yield row()
                number, held = number + 1, []
            held.append(x)
        if held:
            yield row()

    folded = rows.select("v", "label", "vec_id").mapInArrow(arrays.released(fold), "v binary, label long, ids array<long>")
    unique = folded.groupBy("v", "label").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, most_ids).alias("ids"))
    return written(unique.mapInArrow(arrays.released(pack), SEGMENTS), "segments")


class Segment:
    """Vectors with their dimensions in the index's order, and the norms of what remains from each dimension on."""

    def __init__(self, row: dict, order: np.ndarray, most_ids: int):
        self.labels = np.frombuffer(row["labels"], "<i8")
        n = len(self.labels)
        known = np.frombuffer(row["ids"][: 8 * n], "<i8")
        self.known = np.arange(most_ids) < known[:, None]
        self.ids = np.frombuffer(row["ids"][8 * n :], "<i8").reshape(n, most_ids)
        self.x = _ordered(np.frombuffer(row["vectors"], "<i8").reshape(n, -1), order)
        self.rest = _rest(self.x)
        self.indexes: dict[float, tuple] = {}

    def index(self, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows by how many dimensions are indexed at the threshold, the most first; these numbers; and for each group of
        dimensions how many rows have postings there."""
        if t not in self.indexes:
            held = (self.rest[:, :-1] >= t * (1 - SLACK)).sum(axis=1)  # the rest only falls
            rows = np.argsort(-held, kind="stable")
            held = held[rows]
            starts = np.arange(0, self.x.shape[1], GROUP)
            self.indexes = {t: (rows, held, np.searchsorted(-held, -starts, "left"))}
        return self.indexes[t]


def _ordered(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Vectors by dimension order: in floating point while all products are exact there, else as integers."""
    x = np.ascontiguousarray(x[:, order])
    most = int(np.abs(x).max(initial=0))
    return x.astype(np.float64) if most * most * max(1, x.shape[1]) < 1 << 53 else x


def _rest(x: np.ndarray) -> np.ndarray:
    """The norm of each row's components from each dimension on (one more column, of zeros)."""
    out = np.zeros((x.shape[0], x.shape[1] + 1))
    squares = x.astype(np.float64) ** 2
    out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return out


def _like(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in floating point if both are and their products stay exact, else as integers."""
    if a.dtype == b.dtype == np.float64:
        if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 1 << 53:
            return a, b
    return a.astype(np.int64), b.astype(np.int64)


def pairs_above(segment: Segment, q: np.ndarray, rest: np.ndarray, low: np.ndarray, allowed: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, rows and scores of the allowed pairs with a score of `low` (of each query) or more.

    `t` is at most low divided by the query's length, for each of them.
    """
    rows, held, reach = segment.index(t)
    width = segment.x.shape[1]
    x, q = _like(segment.x, q)
    floor = low[:, None] - SLACK * np.abs(low[:, None]) - 1e-6
    partial = np.zeros((len(q), int(reach[0]) if width else len(rows)), x.dtype)
    done, left = 0, None
    for g in range(len(reach)):  # dense: all queries against the rows that have postings in the group
        a, b, n = g * GROUP, min(width, (g + 1) * GROUP), int(reach[g])
        if not n:
            break
        values = x[rows[:n], a:b]
        if held[n - 1] < b:  # of the last rows, the later dimensions of the group are left out of the index
            values = np.where(np.arange(a, b) < held[:n, None], values, 0)
        partial[:, :n] += q[:, a:b] @ values.T
        done = b
        ends = np.minimum(held[: partial.shape[1]], done)
        bound = partial + rest[np.arange(len(q))[:, None], ends] * segment.rest[rows[: partial.shape[1]], ends]
        alive = (bound >= floor) & allowed[:, rows[: partial.shape[1]]]
        if alive.sum() <= DENSE * alive.size:
            break
    if not width:  # all scores are 0
        alive = (partial >= floor) & allowed
    if not partial.size:
        none = np.empty(0, np.int64)
        return none, none, none
    own, place = np.nonzero(alive)
    score, at = partial[own, place], np.minimum(held[place], done)
    row = rows[place]
    for a in range(0, width, GROUP):  # pair by pair: the rest of the index, then what it left out
        b = min(width, a + GROUP)
        if b <= done and not (at < b).any():
            continue
        todo = np.flatnonzero(at < b)
        values = x[row[todo], a:b]
        fresh = np.arange(a, b) >= at[todo, None]
        score[todo] += (np.where(fresh, values, 0) * q[own[todo], a:b]).sum(axis=1).astype(score.dtype)
        at[todo] = b
        keep = score + rest[own, b] * segment.rest[row, b] >= floor[own, 0]
        own, row, score, at = own[keep], row[keep], score[keep], at[keep]
    fits = score >= low[own]
    return own[fits], row[fits], score[fits].astype(np.int64)


def _best(at: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of each query with its k largest scores, all that tie with the last included."""
    order = np.lexsort((-score, at))
    at, row, score = at[order], row[order], score[order]
    first = np.searchsorted(at, at)
    rank = np.arange(len(at)) - first
    last = np.minimum(first + k - 1, len(at) - 1)
    keep = (rank < k) | (at[last] == at) & (score == score[last])
    return at[keep], row[keep], score[keep]


def threshold_join(index: DataFrame, asked: DataFrame, order: np.ndarray, levels: list[float], k: int, most_ids: int, tasks: int, same: bool) -> DataFrame:
    """For each unit (see `ASKED`) its k best rows of the same or of other labels with low <= score <= high: unit, vec_id, score, rank.

    A unit's own row may be among them. `level` is a place in `levels`, falling thresholds for a query of length 1. Each
    task holds some segments, `tasks` in all, and sees every block of units, level by level.
    """
    spark = index.sparkSession

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of units of one level, from rows sorted by it."""
        held = []

        def rows():
            columns = [b"".join(x["q"] for x in held), np.array([[x["unit"], x["label"], x["low"], x["high"]] for x in held], "<i8").tobytes()]
            out = pa.RecordBatch.from_arrays([pa.array([held[0]["level"]], pa.int32()), *[pa.array([c], pa.binary()) for c in columns]], ["level", "qs", "about"])
            held.clear()
            return out

        for x in rows_of(batches):
            if held and (len(held) == QUERIES or held[0]["level"] != x["level"]):
                yield rows()
            held.append(x)
        if held:
            yield rows()

    blocks = asked.repartitionByRange(partitions(spark), "level", "unit").sortWithinPartitions("level", "unit").mapInArrow(arrays.released(block), "level int, qs binary, about binary")
    blocks = written(blocks, "asked")
    travels = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), F.lit(1).alias("kind"), "level", F.col("qs").alias("a"), F.col("about").alias("b"), F.lit(None).cast("binary").alias("c"))
    held = index.select(F.pmod(F.xxhash64("segment"), F.lit(tasks)).cast("int").alias("task"), F.lit(0).alias("kind"), F.lit(-1).alias("level"), F.col("vectors").alias("a"), F.col("labels").alias("b"), F.col("ids").alias("c"))
    dealt = held.unionByName(travels).repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "kind", "level")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own = None, []
        for x in rows_of(batches):
            if x["task"] != task:
                task, own = x["task"], []
            if x["kind"] == 0:
                own.append(Segment({"vectors": x["a"], "labels": x["b"], "ids": x["c"]}, order, most_ids))
                continue
            unit, label, low, high = np.frombuffer(x["b"], "<i8").reshape(-1, 4).T
            q = _ordered(np.frombuffer(x["a"], "<i8").reshape(len(unit), -1), order)
            rest = _rest(q)
            floors = low.astype(np.float64)
            best = [np.empty(0, np.int64)] * 3
            for segment in own:
                allowed = (label[:, None] == segment.labels) == same
                at, row, score = pairs_above(segment, q, rest, floors, allowed, levels[x["level"]])
                fits = score <= high[at]
                at, row, score = _best(at[fits], row[fits], score[fits], k)
                there = segment.known[row]
                ids, many = segment.ids[row][there], there.sum(axis=1)
                best = [np.concatenate(y) for y in zip(best, (np.repeat(at, many), ids, np.repeat(score, many)))]
                ranked = np.lexsort((best[1], -best[2], best[0]))
                best = [y[ranked] for y in best]
                rank = np.arange(len(ranked)) - np.searchsorted(best[0], best[0])
                kth = rank == k - 1  # a task's k-th best raises the unit's threshold
                floors[best[0][kth]] = np.maximum(floors[best[0][kth]], best[2][kth])
                best = [y[rank < k] for y in best]
            if len(best[0]):
                yield pa.RecordBatch.from_arrays([pa.array(unit[best[0]]), pa.array(best[1]), pa.array(best[2])], ["unit", "vec_id", "score"])

    found = dealt.mapInArrow(arrays.released(search), "unit long, vec_id long, score long")
    ranked = W.partitionBy("unit").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _level(levels: list[float]) -> Column:
    """The first level that is at most low divided by the query's length; low is 0 at least."""
    ratio = F.when(F.col("square") > 0, F.col("low") / F.sqrt("square")).otherwise(F.lit(0.0))
    return F.coalesce(*[F.when(ratio >= F.lit(t), F.lit(i)) for i, t in enumerate(levels)], F.lit(len(levels) - 1)).cast("int")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, scale: float = 256.0, steps: tuple[float, ...] = STEPS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Takes vec_id, embedding and label; `is_anchor` is a condition on vec_id and label. An anchor's positives are the `positives` other rows
    of its label with the largest inner products, ties to the smaller vec_id. To each come the first `negatives` rows of other labels
    whose product is between `percent` per cent of the positive's and the positive's own. A positive with a product below 0 has
    none, as no score lies between. Fewer rows give fewer results, no rows none. Exact while products fit 64 bits; norms,
    which only prune, are floating point with some slack. For nulls, repeated ids and lengths see `quantised`.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = written(quantised(vectors, scale), "vectors")
    many, mean = rows.agg(F.count("*"), F.avg(F.sqrt("square"))).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not many:
        return spark.createDataFrame([], schema)
    energy = _energy(rows)
    order = np.argsort(-energy, kind="stable")
    tasks = max(partitions(spark), -(-many * 8 * max(1, len(order)) // TASK_BYTES))
    levels = [s * mean for s in steps if s > 0] + [0.0]
    most_ids = max(positives + 1, negatives)
    index = segments(rows, most_ids)
    anchors = rows.where(is_anchor).select(F.col("vec_id").alias("unit"), "label", F.col("v").alias("q"), "square")

    def joined(asked: DataFrame, k: int, same: bool) -> DataFrame:
        asked = asked.withColumn("level", _level(levels)).select(*[x.split()[0] for x in ASKED.split(", ")])
        return threshold_join(index, asked, order, levels, k, most_ids, tasks, same)

    found, pending = [], written(anchors, "anchors")
    for number, t in enumerate(levels):
        low = F.ceil(F.lit(t) * F.sqrt("square")).cast("long")
        asked = pending.withColumn("low", low).withColumn("high", F.lit(np.iinfo(np.int64).max))
        best = written(joined(asked, positives + 1, True).where("vec_id <> unit").withColumn("_n", F.row_number().over(W.partitionBy("unit").orderBy("rank"))).where(F.col("_n") <= positives), "positives")
        last = number == len(levels) - 1
        full = best.groupBy("unit").count().where(F.lit(last) | (F.col("count") == positives)).select("unit")
        found.append(best.join(full, "unit", "left_semi"))
        if last:
            break
        pending = written(pending.join(full, "unit", "left_anti"), "pending")
        if pending.isEmpty():
            break
    pairs = reduce(DataFrame.unionByName, found).select(F.col("unit").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = written(pairs.where("positive_score >= 0"), "pairs")

    # one window for each anchor and score, numbered; its negatives are those of all positives with that score
    windows = pairs.select("anchor_id", F.col("positive_score").alias("high")).distinct()
    windows = windows.join(anchors.withColumnRenamed("unit", "anchor_id"), "anchor_id")
    bottom = F.expr(f"CAST((high div 100) * {percent} + (((high % 100) * {percent} + 99) div 100) AS long)")
    windows = written(windows.withColumn("unit", F.monotonically_increasing_id()).withColumn("bottom", bottom), "windows")
    filled, pending = [], windows
    for part in (FIRST_WINDOW, 1.0):
        low = F.greatest(F.col("bottom"), F.ceil(F.col("high") - (F.col("high") - F.col("bottom")) * part).cast("long")) if part < 1 else F.col("bottom")
        best = written(joined(pending.withColumn("low", low), negatives, False), "negatives")
        full = best.groupBy("unit").count().where(F.lit(part == 1.0) | (F.col("count") == negatives)).select("unit")
        filled.append(best.join(full, "unit", "left_semi"))
        if part < 1:
            pending = written(pending.join(full, "unit", "left_anti"), "open")
            if pending.isEmpty():
                break
    best = reduce(DataFrame.unionByName, filled).join(windows.select("unit", "anchor_id", F.col("high").alias("positive_score")), "unit")
    out = pairs.join(best.drop("unit"), ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
