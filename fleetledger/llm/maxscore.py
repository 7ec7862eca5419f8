"""Exact top-k by inner product with MaxScore over shards of integer vectors.

Vectors are packed into shards whose postings are kept by component. For each query a
component's bound is its largest contribution in the shard. In order of bounds, the
components whose bounds together stay below the query's k-th best score so far are
non-essential: the essential postings are traversed first, a vector goes on only while its
partial score and the bounds that are left reach the k-th best, and the others are
probed for what is still competitive. Scores are integers, and exact: shards add in single or double
precision only where every sum stays within its whole numbers, in Python integers beyond.

Blocks of queries and shards are dealt to cells, a few of each: a cell holds some blocks and some shards, gets
each once, and the k-th best scores carry over from shard to shard in it. What cells find is merged per query.

Defined cases: a row whose id or vector is null, or that holds a null or non-finite
component, takes no part; a shorter vector counts as filled up with zeros; a vector
without components scores 0. Rows that share the query's id are no candidates; other
repeated rows are candidates each, and a repeated query row is a query each. Scores beyond
64 bits are cut to the largest or least long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .frames import bounded_batches

TOP = 20
SCALE = 64
# Rows in a block of vectors or of queries, and bytes at most (a wider vector stands alone).
SHARD = 8_192
QUERIES = 512
BLOCK_BYTES = 32 << 20
# Shards and blocks of queries that meet in a cell at most, and cells for each core that Spark has.
SHARDS_TOGETHER = 4
BLOCKS_TOGETHER = 16
CELLS_PER_CORE = 2
MOST_PARTITIONS = 50_000
SEEDS = 64
PROBED = 8

_SCHEMA = "block long, n int, width int, ids binary, parts binary, beyond binary"


def _pack(vectors: DataFrame, most: int) -> DataFrame:
    """(id, vector) rows as blocks of at most ``most``: ids, and components one after the other.

    A scaled component that no double holds is infinite there; ``beyond`` has (component, row, value before scaling) of each.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def block(rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            width = max(len(v) for _, v in rows)
            table = np.zeros((width, len(rows)))
            for k, (_, v) in enumerate(rows):
                table[:len(v), k] = v
            with np.errstate(over="ignore"):
                scaled = np.floor(SCALE * table)
            at = np.argwhere(np.isinf(scaled))
            beyond = np.concatenate([at, table[at[:, 0], at[:, 1], None].view(np.int64)], axis=1) if len(at) else np.empty((0, 3), np.int64)
            ids = np.array([i for i, _ in rows], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([len(rows)], pa.int32()), pa.array([width], pa.int32()),
                 *[pa.array([x.tobytes()], pa.binary()) for x in (ids, scaled, beyond.astype(np.int64))]], names=_NAMES)

        rows: list[tuple[int, np.ndarray]] = []
        widest = 0
        for batch in batches:
            flat = batch.column(1)
            values = flat.flatten().to_numpy(zero_copy_only=False).astype(float)
            ends = np.cumsum(flat.value_lengths().to_numpy(zero_copy_only=False))
            for i, a, b in zip(batch.column(0).to_pylist(), np.concatenate([[0], ends[:-1]]).tolist() if len(ends) else [], ends.tolist()):
                if rows and (len(rows) == most or 8 * max(widest, b - a) * (len(rows) + 1) > BLOCK_BYTES):
                    yield block(rows)
                    rows, widest, made = [], 0, made + 1
                rows.append((i, values[a:b]))
                widest = max(widest, b - a)
        if rows:
            yield block(rows)

    bounded_batches(vectors.sparkSession)
    return vectors.mapInArrow(task, _SCHEMA)


_NAMES = ["block", "n", "width", "ids", "parts", "beyond"]


def _whole(values: np.ndarray, beyond: dict[int, int]) -> list[int]:
    """A vector's scaled components as integers; ``beyond`` has those that are infinite."""
    return [beyond[k] if k in beyond else int(x) for k, x in enumerate(values)]


def _beyond(data: bytes) -> dict[int, dict[int, int]]:
    """By row, the scaled components that no double holds."""
    found: dict[int, dict[int, int]] = {}
    listed = np.frombuffer(data, np.int64).reshape(-1, 3)
    for (component, row, _), value in zip(listed.tolist(), listed[:, 2].copy().view(float).tolist()):
        found.setdefault(row, {})[component] = SCALE * int(value)  # so large a double is a whole number
    return found


class Shard:
    """Postings by component, and their largest and least values."""

    def __init__(self, n: int, width: int, ids: bytes, parts: bytes, beyond: bytes = b""):
        self.beyond = _beyond(beyond)
        self.ids = np.frombuffer(ids, np.int64)
        self.parts = np.frombuffer(parts, float).reshape(width, n)
        self.high, self.low = (self.parts.max(axis=1), self.parts.min(axis=1)) if n else (np.zeros(width), np.zeros(width))
        self.reach = np.maximum(np.abs(self.high), np.abs(self.low))
        self.narrow: np.ndarray | None = None

    def search(self, query: np.ndarray, own: int, top: tuple[np.ndarray, np.ndarray], k: int,
               beyond: dict[int, int] = {}) -> tuple[np.ndarray, np.ndarray]:
        """``top`` (scores, ids; best first) with what this shard has for the query."""
        width = min(len(query), len(self.parts))
        query = query[:width]
        with np.errstate(invalid="ignore", over="ignore"):
            total = float((np.abs(query) * self.reach[:width]).sum())
        if not total < 2 ** 53:  # also where an infinite component meets a zero
            return _merged(top, self._exact(_whole(query, beyond), width), self.ids, own, k)
        if total < 2 ** 24 and self.narrow is None:
            self.narrow = self.parts.astype(np.float32)
        parts = self.narrow if total < 2 ** 24 else self.parts
        query = query.astype(parts.dtype)
        bound = np.maximum(query * self.high[:width], query * self.low[:width]).astype(float)
        order = np.argsort(-bound, kind="stable")
        left = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0.0]])  # bounds of the components from each on
        worst = float(top[0][-1]) if len(top[0]) == k else -np.inf
        if worst == -np.inf and len(self.ids) > SEEDS:
            head = order[:PROBED]
            seeds = np.argpartition(-(query[head] @ parts[head]), SEEDS)[:SEEDS]
            seeds = seeds[self.ids[seeds] != own]
            if len(seeds) >= k:
                worst = float(np.partition(query @ parts[:width, seeds], len(seeds) - k)[len(seeds) - k])
        # Essential: up to where the bounds that are left fall below the k-th best score.
        essential = int(np.argmax(left < worst)) if (left < worst).any() else width
        if essential == 0:
            return top
        first = order[:essential]
        score = query[first] @ parts[first]
        going = np.flatnonzero(score + left[essential] >= worst)
        score = score[going]
        for a in range(essential, width, PROBED):
            some = order[a:a + PROBED]
            score = score + query[some] @ parts[np.ix_(some, going)]
            keep = score + left[min(width, a + PROBED)] >= worst
            going, score = going[keep], score[keep]
        return _merged(top, score.astype(np.int64), self.ids[going], own, k)

    def _exact(self, query: list[int], width: int) -> np.ndarray:
        sums = [sum(q * x for q, x in zip(query, _whole(column, self.beyond.get(row, {}))))
                for row, column in enumerate(self.parts[:width].T)]
        return np.array([min(max(s, -2 ** 63), 2 ** 63 - 1) for s in sums], np.int64)


def _merged(top: tuple[np.ndarray, np.ndarray], score: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    other = ids != own
    score, ids = np.concatenate([top[0], score[other]]), np.concatenate([top[1], ids[other]])
    if len(score) > 4 * k:  # all that can be among the best, ties included
        keep = score >= np.partition(score, len(score) - k)[len(score) - k]
        score, ids = score[keep], ids[keep]
    best = np.lexsort((ids, ~score))[:k]  # ~ turns the order around without overflow
    return score[best], ids[best]


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` best other rows, ties to the lesser id."""
    spark = vectors.sparkSession
    sound = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound)
    plain = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")]
    shards = pin(_pack(rows.select(*plain), SHARD))
    queries = pin(_pack(rows.filter(is_query).select(*plain), QUERIES))
    n_shards, n_blocks = shards.count(), queries.count()
    if not n_shards or not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    groups = -(-n_shards // SHARDS_TOGETHER)
    wanted = max(1, CELLS_PER_CORE * spark.sparkContext.defaultParallelism)
    together = min(BLOCKS_TOGETHER, max(1, n_blocks * groups // wanted))
    bands = -(-n_blocks // together)

    def dealt(blocks: DataFrame, own: int, others: int, cell: Callable[[Column, Column], Column]) -> DataFrame:
        """Each block in all cells of its band or group."""
        number = blocks.select("block", (F.row_number().over(Window.orderBy("block")) - 1).alias("number"))  # one narrow row a block
        spread = blocks.join(number, "block").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        return spread.withColumn("cell", cell(F.col("number") % own, F.col("other"))).select("cell", *_NAMES).repartition(
            min(bands * groups, MOST_PARTITIONS), "cell")

    asked = dealt(queries, bands, groups, lambda band, group: band * groups + group)
    held = dealt(shards, groups, bands, lambda group, band: band * groups + group)
    found = asked.groupBy("cell").cogroup(held.groupBy("cell")).applyInArrow(
        lambda left, right: _cell(left, right, k), "block long, at long, query_id long, id long, score long")
    order = Window.partitionBy("block", "at").orderBy(F.col("score").desc(), F.col("id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def _cell(queries: pa.Table, shards: pa.Table, k: int) -> pa.Table:
    """The best of a cell's shards for each query of its blocks."""
    none = np.empty(0, np.int64)
    held = []  # of each block: number, ids, vectors, components beyond a double, best so far
    for block, n, width, ids, parts, beyond in zip(*(queries[c].to_pylist() for c in _NAMES)):
        held.append((block, np.frombuffer(ids, np.int64), np.frombuffer(parts, float).reshape(width, n).T, _beyond(beyond), [(none, none)] * n))
    for row in range(shards.num_rows):
        shard = Shard(*(shards[c][row].as_py() for c in _NAMES[1:]))
        for _, ids, vectors, beyond, best in held:
            for j in range(len(ids)):
                best[j] = shard.search(vectors[j], int(ids[j]), best[j], k, beyond.get(j, {}))
    columns = [[none] for _ in range(5)]
    for block, ids, _, _, best in held:
        count = [len(s) for s, _ in best]
        parts = (np.repeat(np.full(len(ids), block), count), np.repeat(np.arange(len(ids)), count), np.repeat(ids, count),
                 np.concatenate([none, *[i for _, i in best]]), np.concatenate([none, *[s for s, _ in best]]))
        for column, part in zip(columns, parts):
            column.append(part)
    return pa.table({name: pa.array(np.concatenate(column), pa.int64())
                     for name, column in zip(("block", "at", "query_id", "id", "score"), columns)})
