"""What the operators share: reading tables, Arrow tasks, and words as numpy arrays.

Words, hashes and windows are computed for a whole group of documents at once, on
the UTF-8 bytes that Arrow hands over; groups are cut by bytes, so a task's memory
follows ``GROUP_BYTES`` (and its longest single text), not the size of a partition.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import estimated_bytes

# Arrow batches hold at most so many rows and bytes, and tasks work on so many bytes of text at once.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20
GROUP_BYTES = 1 << 20

# A shuffle partition gets so many bytes at most, as they are stored (texts are about three times that in memory).
STORED_BYTES = 32 << 20

# Fixed values of the word rule [^\x20\x09-\x0D]+.
SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has such a column already."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Bound what Arrow hands to a task at once; results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def least_hashes(df: DataFrame, draw: str, wanted: int, total: int) -> DataFrame:
    """The ``wanted`` rows of least ``draw`` (a 64-bit hash) of about ``total``, or a few less.

    Rows far beyond them are dropped where they are read, so what meets on the driver
    does not grow with the number of tasks.
    """
    share = (wanted + 4 * wanted ** 0.5) / max(total, 1)
    near = df if share >= 1 else df.filter(F.col(draw) <= int(-2 ** 63 + share * 2 ** 64))
    return near.orderBy(draw).limit(wanted)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(df: DataFrame) -> int:
    """How many partitions a shuffle of ``df`` gets: the session's number, or more where its stored size asks for it."""
    return max(shuffle_partitions(df.sparkSession), -(-estimated_bytes(df) // STORED_BYTES))


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` through ``rows``, batch by batch."""
    bounded_batches(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = rows(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(task, schema)


def kept_by_worker(name: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` made for ``key``, kept by the Python worker from task to task.

    One thing is kept per name, so a worker's memory is bounded by what ``make`` bounds.
    Results must not depend on what an earlier task left in it.
    """
    home = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if name not in home or home[name][0] != key:
        home[name] = key, make()
    return home[name][1]


def texts(column: pa.Array) -> list[str]:
    """Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row starts (one offset more than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    if len(column) == 0 or at is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def groups(offsets: np.ndarray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last
        first = last


def byte_class(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[np.frombuffer(members, np.uint8)] = True
    return found


IS_SPACE = byte_class(SPACES)


class Words:
    """The words of a range of rows: byte bounds, and for each row its first word (one more than rows)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE):
        inner = ~between[raw]
        fresh = np.empty(len(raw) + 1, bool)
        fresh[0] = fresh[-1] = True
        np.logical_not(inner[:-1], out=fresh[1:-1])
        fresh[offsets] = True  # no word goes on into the next row
        self.starts = np.flatnonzero(inner & fresh[:-1])
        last = np.empty(len(raw), bool)
        if len(raw):
            last[-1] = True
            np.logical_not(inner[1:], out=last[:-1])
            ends = offsets[1:][offsets[1:] > 0] - 1
            last[ends] = True
        self.ends = np.flatnonzero(inner & last) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def room(self) -> np.ndarray:
        """For each word, how many words its row has from it on."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self))


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as long as was asked for."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.tables[0]) < n:
            for k, base in enumerate(self.bases):
                have = self.tables[k]
                step = np.uint64(pow(base, len(have), 1 << 64))
                self.tables[k] = np.concatenate([have, have * step])
        return self.tables[0][:n], self.tables[1][:n]


BYTE_POWERS = Powers(0x9E3779B97F4A7C15)
WORD_POWERS = Powers(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def spans_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over all bytes."""
    up, down = BYTE_POWERS.upto(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[raw] * up[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def runs_hash(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each ``n`` consecutive word hashes (rows are not told apart)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    up, down = WORD_POWERS.upto(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[:len(words) - n + 1])
