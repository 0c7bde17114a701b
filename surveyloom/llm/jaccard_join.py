"""Exact Jaccard join of documents on word n-grams, with a token-group matrix.

1. A document's set is its distinct word n-grams, as 64-bit hashes. Equal sets are one class, its representative the
   smallest doc_id.
2. How many classes hold each n-gram is counted over all documents. One that a single class holds is in no
   intersection, so a class of n with fewer than threshold * n shared ones has no partner and drops out.
3. Similar classes are partitioned into groups: rounds of leaders in min-hash buckets, on the first pass inside each task.
   A member is linked to its leader or to a member before it, so a cluster is connected already and only links between
   clusters are still searched.
4. The classes are partitioned into blocks of similar ones, by another min-hash. The token-group matrix has a row for each block and
   token among its members' rarest, those that may be the first common token of partners, with the sizes of the
   members and of the partners that it may have. Blocks that share such a token of different clusters meet. A class whose
   overlap with the other block's union is below threshold * n has no partner there; for the others the block is opened
   and all overlaps are counted at once, as a product of 0/1 matrices.
5. Clusters with a link between them are merged by connected components.
"""

from __future__ import annotations

import itertools
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm import arrays, chunks
from surveyloom.llm.arrays import U64
from surveyloom.llm.chunks import Asked, answer, exchange, partitions, rows_of, written
from surveyloom.llm.components import components

WIDTH = 5
PERCENT = 75
ROUNDS = 3
LEADERS = 32  # of a bucket, and as many of its last classes, that a class is compared with; others are met in the matrix
BLOCK = 256
CHUNK_BYTES = 4 << 20  # a task holds some 40 bytes for each byte of a chunk
BLOCK_BYTES = 4 << 20


def _sets(chunk: chunks.Chunk, width: int) -> list[np.ndarray]:
    starts, stops, bounds = arrays.word_spans(chunk.text, chunk.offsets)
    return arrays.shingles(arrays.word_hashes(chunk.text, starts, stops, lower=True), bounds, width)


def _batch(schema: str, *columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.strip().split() for x in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


SETS = "chunk_id long, ids binary, sizes binary, digests binary"
CLASSES = "chunk_id long, ids binary, sizes binary, reps binary, alone binary"
ROWS = "rep long, n int, tokens binary"
LED = "rep long, n int, tokens binary, parent long"
BLOCKS = "block long, shape binary, tokens binary, rare binary"
MATRIX = "token long, block long, low long, high long, least long, reach long"


def _class_tables(table: DataFrame, width: int) -> DataFrame:
    """For each chunk its documents' set sizes and representatives, and which documents stand for their class."""

    def sets(batches: Iterator[pa.RecordBatch]):
        for row in rows_of(batches):
            found = _sets(chunks.chunk_of(row), width)
            sizes = np.array([len(x) for x in found], U64)
            digests = np.array([(arrays.mix(x).sum(), arrays.mix(x ^ U64(0xD1)).sum()) for x in found], U64).reshape(-1, 2)
            yield _batch(SETS, [row["chunk_id"]], [row["ids"]], [arrays.pack(sizes)], [digests.tobytes()])

    def known(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = arrays.unpack_ascending(row["ids"])
        use = np.flatnonzero((arrays.unpack(row["sizes"]) > 0) & (ids != arrays.signed_to_unsigned(np.array([chunks.NO_ID]))[0]))
        return ids, use, np.frombuffer(row["digests"], U64).reshape(-1, 2)[use]

    def ask(row) -> Asked:
        ids, use, digests = known(row)
        first, _ = chunks.first_of(digests)
        return Asked(digests[first, 0], ids[use][first], digests[first, 1])

    def settle(batches: Iterator[pa.RecordBatch]):
        for row in rows_of(batches):
            ids, use, digests = known(row)
            first, group = chunks.first_of(digests)
            reps = ids.copy()
            reps[use] = answer(row["replies"], "value")[group]
            stands = np.zeros(len(ids), bool)
            stands[use[first]] = reps[use[first]] == ids[use[first]]
            yield _batch(CLASSES, [row["chunk_id"]], [row["ids"]], [row["sizes"]], [arrays.pack(reps)], [stands.tobytes()])

    rows = written(table.mapInArrow(arrays.released(sets), SETS), "sets")
    replies = exchange(rows, ask, 64, "min", "value")
    return written(rows.join(replies, "chunk_id", "left").mapInArrow(arrays.released(settle), CLASSES), "classes")


def _linkable(table: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Classes that may have a partner: rep, n (set size) and tokens, the shared n-grams, the rarest first."""
    base = table.join(classes.select("chunk_id", "alone"), "chunk_id")
    bits = chunks.name_bits(table.agg(F.sum("n_bytes")).first()[0] or 1)

    def own(row) -> tuple[chunks.Chunk, np.ndarray, list[np.ndarray]]:
        chunk = chunks.chunk_of(row)
        use = np.flatnonzero(np.frombuffer(row["alone"], bool))
        found = _sets(chunk, width)
        return chunk, use, [found[i] for i in use]

    def names(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        docs = np.repeat(np.arange(len(found)), [len(x) for x in found])
        return chunks.counted(np.concatenate(found) if found else np.empty(0, U64), docs, bits)

    def ask(row) -> Asked:
        return Asked(*names(own(row)[2]))

    def pick(batches: Iterator[pa.RecordBatch]):
        for row in rows_of(batches):
            chunk, use, found = own(row)
            cut, _ = names(found)
            held = answer(row["replies"], "count")
            cut, held = cut[held >= 2], held[held >= 2]
            flat = np.concatenate(found) if found else np.empty(0, U64)
            sizes = np.array([len(x) for x in found], np.int64)
            at = np.flatnonzero(chunks.members(flat, cut, bits))  # the shared n-grams
            ends = np.searchsorted(at, np.cumsum(sizes))
            out = [], [], []
            for i in np.flatnonzero(100 * np.diff(ends, prepend=0) >= percent * sizes).tolist():
                grams = flat[at[ends[i - 1] if i else 0 : ends[i]]]
                order = np.argsort(held[np.searchsorted(cut, grams >> U64(64 - bits))], kind="stable")  # then by hash, as `grams` ascend
                for column, value in zip(out, (int(chunk.ids[use[i]]), int(sizes[i]), grams[order].tobytes())):
                    column.append(value)
            yield _batch(ROWS, *out)

    replies = exchange(base, ask, bits, "sum", "count")
    return written(base.join(replies, "chunk_id", "left").mapInArrow(arrays.released(pick), ROWS), "linkable")


def _similar(common: int, n: int, m: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two ascending arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _lead(rows: DataFrame, seed: int, percent: int, shuffle: bool) -> DataFrame:
    """Each class with its parent: the leader of a similar class in its min-hash bucket, or itself.

    A task keeps some leaders and the last classes of each bucket; with `shuffle` a bucket's classes meet in one task, sorted.
    """

    def key(tokens: np.ndarray) -> int:
        return int(arrays.mix(tokens ^ U64(seed * 0x9E37 + 1)).min() >> U64(1)) if len(tokens) else 0

    def keyed(batches):
        for batch in batches:
            tokens = batch.column("tokens").to_pylist()
            keys = pa.array([key(np.frombuffer(x, U64)) for x in tokens], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "bucket"])

    def lead(batches):
        leaders: dict[int, tuple[list, deque]] = {}
        held = 0
        for batch in batches:
            out = [], [], [], []
            for row in batch.to_pylist():
                grams = np.sort(np.frombuffer(row["tokens"], U64))
                if row["bucket"] not in leaders and (shuffle or held > 64 << 20):
                    leaders, held = {}, 0  # another bucket has begun, or enough is held
                first, last = leaders.setdefault(row["bucket"], ([], deque(maxlen=LEADERS)))
                parent = row["rep"]
                for leader, n, other in itertools.chain(first, reversed(last)):
                    low, high = sorted((n, row["n"]))
                    if 100 * low >= percent * high and _similar(_common(grams, other), n, row["n"], percent):
                        parent = leader
                        break
                known = first if parent == row["rep"] and len(first) < LEADERS else last
                known.append((parent, row["n"], grams))
                held += grams.nbytes
                for column, value in zip(out, (row["rep"], row["n"], row["tokens"] if parent == row["rep"] else None, parent)):
                    column.append(value)
            yield _batch(LED, *out)

    found = rows.select("rep", "n", "tokens").mapInArrow(arrays.released(keyed), f"{ROWS}, bucket long")
    if shuffle:
        found = found.repartition(partitions(rows.sparkSession), "bucket").sortWithinPartitions("bucket", "rep")
    return written(found.mapInArrow(arrays.released(lead), LED), "led")


def _groups(rows: DataFrame, percent: int) -> DataFrame:
    """rep and cluster, by rounds of leaders; each round only sees the leaders of the last."""
    left, out = rows, None
    for seed in range(ROUNDS):
        led = _lead(left, seed, percent, shuffle=seed > 0)
        step = led.select(F.col("rep").alias("cluster"), F.col("parent"))
        if out is None:
            out = step.select(F.col("cluster").alias("rep"), F.col("parent").alias("cluster"))
        else:
            out = out.join(step, "cluster").select("rep", F.col("parent").alias("cluster"))
        left = led.where(F.col("rep") == F.col("parent"))
    return written(out.distinct(), "groups")


def _reach(n: int, shared: int, percent: int) -> np.ndarray:
    """For the place of each rarest token, the largest partner whose first common token may stand there.

    Partners of n and s tokens share at least percent / (100 + percent) * (n + s). If the first of them has place i
    among a set's shared tokens, it shares shared - i at most. The places after which no size is left are left out.
    """
    most = np.minimum((shared - np.arange(shared)) * (100 + percent) // percent - n, 100 * n // percent)
    return most[: int((100 * most >= percent * n).sum())]


def _blocks(grouped: DataFrame, percent: int) -> DataFrame:
    """Blocks of similar classes, those of one min-hash: their shape (cluster, n, shared tokens) and sets, and the rows of
    the matrix: rare tokens of the union with the clusters, sizes and reach of the members that have them."""

    def keyed(batches):
        for batch in batches:
            sets = [np.frombuffer(x, U64) for x in batch.column("tokens").to_pylist()]
            keys = [int(arrays.mix(x ^ U64(0xB10C)).min() >> U64(1)) if len(x) else 0 for x in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "bucket"])

    def block(batches):
        held, size, number = [], 0, 0

        def row():
            sets = [np.frombuffer(x["tokens"], U64) for x in held]
            shape = np.array([(x["cluster"], x["n"], len(s)) for x, s in zip(held, sets)], np.int64)
            reach = [_reach(x["n"], len(s), percent) for x, s in zip(held, sets)]
            tokens = np.concatenate([s[: len(r)] for s, r in zip(sets, reach)])
            order = np.argsort(tokens, kind="stable")
            first = np.flatnonzero(np.diff(tokens[order], prepend=~tokens[order[:1]]) != 0)
            cluster, n = (np.repeat(shape[:, k], [len(r) for r in reach])[order] for k in (0, 1))
            folds = ((np.minimum, cluster), (np.maximum, cluster), (np.minimum, n), (np.maximum, np.concatenate(reach)[order]))
            rare = np.stack([tokens[order][first].view(np.int64), *(f.reduceat(x, first) for f, x in folds)], axis=1)
            name = TaskContext.get().partitionId() * (1 << 32) + number
            return _batch(BLOCKS, [name], [shape.tobytes()], [b"".join(x["tokens"] for x in held)], [rare.astype(np.int64).tobytes()])

        for x in rows_of(batches):
            if held and (len(held) == BLOCK or size > BLOCK_BYTES or held[0]["bucket"] != x["bucket"]):
                yield row()
                held, size, number = [], 0, number + 1
            held.append(x)
            size += len(x["tokens"])
        if held:
            yield row()

    keys = grouped.select("rep", "n", "tokens", "cluster").mapInArrow(arrays.released(keyed), f"{ROWS}, cluster long, bucket long")
    ranged = keys.repartitionByRange(partitions(grouped.sparkSession), "bucket", "cluster", "rep").sortWithinPartitions("bucket", "cluster", "rep")
    return written(ranged.mapInArrow(arrays.released(block), BLOCKS), "blocks")


def _matrix(blocks: DataFrame) -> DataFrame:
    """Pairs of blocks (a, b), a <= b, that share a rare token of members of different groups and fitting sizes."""

    def rows(batches):
        for x in rows_of(batches):
            rare = np.frombuffer(x["rare"], np.int64).reshape(-1, 5).T
            yield _batch(MATRIX, rare[0], np.full(rare.shape[1], x["block"]), *rare[1:])

    matrix = written(blocks.select("block", "rare").mapInArrow(arrays.released(rows), MATRIX), "matrix")
    several = matrix.groupBy("token").agg(F.min("low").alias("lowest"), F.max("high").alias("highest")).where("lowest < highest")
    asked = written(matrix.join(several.select("token"), "token"), "asked")
    a, b = asked.alias("a"), asked.alias("b")
    apart = "a.block <= b.block AND (a.low < b.high OR b.low < a.high) AND a.least <= b.reach AND b.least <= a.reach"
    return written(a.join(b, "token").where(apart).select(F.col("a.block").alias("a"), F.col("b.block").alias("b")).distinct(), "pairs")


def _overlaps(a: np.ndarray, a_of: np.ndarray, b: np.ndarray, b_of: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """The sizes of all intersections between sets of two blocks, by products of their 0/1 matrices over common tokens."""
    common = np.intersect1d(a, b)
    out = np.zeros(shape, np.float32)
    if not len(common):
        return out

    def places(tokens, owner):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        has = common[at] == tokens
        return at[has], owner[has]

    at_a, own_a = places(a, a_of)
    at_b, own_b = places(b, b_of)
    step = 2048
    for low in range(0, len(common), step):
        sides = []
        for at, own, n in ((at_a, own_a, shape[0]), (at_b, own_b, shape[1])):
            here = (at >= low) & (at < low + step)
            side = np.zeros((n, step), np.float32)
            side[own[here], at[here] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _opened(blocks: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Links between groups (a, b). The blocks of a pair meet sorted, the one that is asked first."""
    sets = blocks.select("block", "shape", "tokens")
    asking = pairs.join(sets, pairs["a"] == sets["block"]).select(F.col("b").alias("block"), F.lit(1).alias("kind"), "shape", "tokens")
    asked = sets.join(pairs.select(F.col("b").alias("block")).distinct(), "block").select("block", F.lit(0).alias("kind"), "shape", "tokens")
    dealt = asked.unionByName(asking).repartition(partitions(blocks.sparkSession), "block").sortWithinPartitions("block", "kind")

    def read(x):
        shape = np.frombuffer(x["shape"], np.int64).reshape(-1, 3)
        return shape, np.frombuffer(x["tokens"], U64), np.repeat(np.arange(len(shape)), shape[:, 2])

    def search(batches):
        shape = tokens = owner = union = None
        for x in rows_of(batches):
            if x["kind"] == 0:
                shape, tokens, owner = read(x)
                union = np.unique(tokens)
                continue
            own, grams, of = read(x)
            at = np.minimum(np.searchsorted(union, grams), len(union) - 1)
            bound = np.bincount(of, union[at] == grams, minlength=len(own))
            use = np.flatnonzero(100 * bound >= percent * own[:, 1])  # no member shares enough with the others
            if not len(use):
                continue
            place = np.full(len(own), -1)
            place[use] = np.arange(len(use))
            some = place[of] >= 0
            common = _overlaps(grams[some], place[of[some]], tokens, owner, (len(use), len(shape))).astype(np.int64)
            linked = 100 * common >= percent * (own[use, 1][:, None] + shape[:, 1] - common)
            linked &= own[use, 0][:, None] != shape[:, 0]
            left, right = np.nonzero(linked)
            found = np.unique(np.stack([own[use, 0][left], shape[right, 0]], axis=1), axis=0)
            yield _batch("a long, b long", found[:, 0], found[:, 1])

    return dealt.mapInArrow(arrays.released(search), "a long, b long").distinct()


def jaccard_join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles (set size) and component_id, the smallest doc_id reachable by links.

    Takes doc_id and text. Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z in lower case; a document of fewer words than
    `width` has its whole sequence as the only n-gram. Two documents link if their sets share at least
    `percent` per cent of their union. A document without words, or with a null text, has n_shingles 0 and links with
    nothing; a row without a doc_id links with nothing and has no component. Rows that repeat a doc_id each get a row. No rows
    give no rows.
    """
    table = chunks.store(docs, CHUNK_BYTES)
    classes = _class_tables(table, width)
    rows = _linkable(table, classes, width, percent)
    groups = _groups(rows, percent)
    grouped = written(rows.join(groups, "rep"), "grouped")
    blocks = _blocks(grouped, percent)
    links = components(_opened(blocks, _matrix(blocks), percent))
    rooted = groups.join(links, groups["cluster"] == links["node"], "left").select("rep", F.coalesce("root", "cluster").alias("root"))
    rooted = written(rooted, "rooted")
    least = written(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
    labels = written(rooted.join(least, "root").groupBy("rep").agg(F.min("component_id").alias("component_id")), "labels")

    def members(batches):
        for x in rows_of(batches):
            ids, reps = (arrays.unsigned_to_signed(y) for y in (arrays.unpack_ascending(x["ids"]), arrays.unpack(x["reps"])))
            yield _batch("doc_id long, n_shingles long, rep long", ids, arrays.unpack(x["sizes"]).astype(np.int64), reps)

    out = written(classes.select("ids", "sizes", "reps").mapInArrow(arrays.released(members), "doc_id long, n_shingles long, rep long"), "members")
    out = out.join(labels, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    missing = F.lit(chunks.NO_ID)
    return out.select(
        F.when(F.col("doc_id") != missing, F.col("doc_id")).alias("doc_id"), "n_shingles", F.when(F.col("doc_id") != missing, F.col("component_id")).alias("component_id")
    )
