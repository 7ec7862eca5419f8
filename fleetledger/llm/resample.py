"""Importance resampling towards a target's distribution of hashed word runs.

The features of a text are its runs of one to three words, hashed into ``BUCKETS``. Bucket
counts of the raw and the target texts give each bucket a gain, kept as one array; a
document's weight is the sum of its features' gains, and a draw without replacement
takes the highest weights with Gumbel noise.

CRC-32 is linear, so the hash of a run follows from the hashes of its words by table
look-ups: all runs of a group of texts are hashed by numpy at once, none is spelled out.

The cutoff comes from a quantile sketch that brackets it. Exact counts above and
inside the bracket either prove that it holds the cutoff or widen it. Only the bracket is
sorted to locate it; the drawn rows above are sorted for their ranks. No step gathers rows at the driver.

Defined cases: a null text has no words, no features and weight 0; a null id is hashed as an
empty one and loses ties. Repeated rows are rows each, in any order among themselves. Empty
tables give gains of their own counts, and no rows where ``raw`` is empty. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import number_rows
from ..session import pin
from .frames import Words, bounded_batches, byte_class, groups, utf8

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
# The sketch's ranks are off by one part in so many at most.
SKETCH = 10_000

# Fixed values of the word rule: A-Z are lower-cased, then [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_LOWERED = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_BETWEEN = ~byte_class(_WORD)
# Fixed value: the polynomial of CRC-32, bits reversed.
_POLYNOMIAL = 0xEDB88320

SHORT = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_BYTE = _byte_table()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by what it makes of each byte at each place."""
    return (tables[0][crc & 255] ^ tables[1][(crc >> np.uint32(8)) & 255]
            ^ tables[2][(crc >> np.uint32(16)) & 255] ^ tables[3][crc >> np.uint32(24)])


def _one_byte(crc: np.ndarray) -> np.ndarray:
    return _BYTE[crc & 255] ^ (crc >> np.uint32(8))


def _short_tables() -> np.ndarray:
    """[n, place, byte]: a hash after ``n`` zero bytes."""
    held = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(SHORT):
        held.append(_one_byte(held[-1]))
    return np.stack(held)


_AFTER = _short_tables()


def _after(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each hash after so many zero bytes."""
    low = zeros % SHORT
    out = _AFTER[low, 0, crc & 255]
    for k in range(1, 4):
        out ^= _AFTER[low, k, (crc >> np.uint32(8 * k)) & 255]
    rest, doubled = zeros // SHORT, _AFTER[SHORT]
    while rest.any():
        some = np.flatnonzero(rest & 1)
        out[some] = _apply(doubled, out[some])
        rest, doubled = rest >> 1, _apply(doubled, doubled)
    return out


_SPACE = np.uint32(zlib.crc32(b" "))


def _joined(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The hash of two texts with a space between, the right one of this length."""
    return _after(_one_byte(left) ^ _SPACE, length) ^ right


def word_hashes(raw: np.ndarray, words: Words) -> np.ndarray:
    """CRC-32 of every word."""
    length = words.ends - words.starts
    crc = np.full(len(words), 0xFFFFFFFF, np.uint32)
    going = np.flatnonzero(length <= SHORT)
    for k in range(SHORT):
        going = going[length[going] > k]
        if not len(going):
            break
        crc[going] = _one_byte(crc[going] ^ raw[words.starts[going] + k])
    crc ^= np.uint32(0xFFFFFFFF)
    data = raw.tobytes()
    for k in np.flatnonzero(length > SHORT).tolist():
        crc[k] = zlib.crc32(data[words.starts[k]:words.ends[k]])
    return crc


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature of some texts, and their numbers of words."""
    raw = _LOWERED[raw]
    words = Words(raw, offsets, _BETWEEN)
    single, length, room, row = word_hashes(raw, words), words.ends - words.starts, words.room(), words.rows()
    buckets, rows, run = [single % BUCKETS], [row], single
    for n in range(2, LONGEST + 1):
        run = _joined(run[:-1], single[n - 1:], length[n - 1:]) if len(run) > 1 else run[:0]
        inside = np.flatnonzero(room[:len(run)] >= n)
        buckets.append(run[inside] % BUCKETS)
        rows.append(row[inside])
    return np.concatenate(buckets), np.concatenate(rows), np.diff(words.first)


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            raw, offsets = utf8(batch.column(0))
            for a, b in groups(offsets):
                bucket, _, _ = features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                total += np.bincount(bucket, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], names=["bucket", "n"])

    bounded_batches(texts.sparkSession)
    found = texts.select(F.col(text_col).cast("string")).mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for r in found.collect():  # one row per bucket
        counts[r.bucket] = r.n
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain, from its counts in the raw and in the target texts."""
    total_raw, total_target = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log(((t + 1.0) * total_raw) / ((s + 1.0) * total_target)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            n_words, n_features, weight = [], [], []
            for a, b in groups(offsets):
                bucket, row, own = features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                total = np.zeros(b - a, np.int64)
                np.add.at(total, row, gain[bucket])
                n_words.append(own)
                n_features.append(np.bincount(row, minlength=b - a))
                weight.append(total)
            none = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(np.concatenate(x or none), pa.int64()) for x in (n_words, n_features, weight)]],
                names=["id", "n_words", "n_features", "weight"])

    bounded_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(task, "id long, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: int = SEED) -> Column:
    """A thousandth of Gumbel noise, drawn from the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))


def bracket(scored: DataFrame, wanted: int, total: int, width: float = 2 / SKETCH) -> tuple[int | None, int | None, int]:
    """Least and greatest score of a range that holds the ``wanted``-th highest one (none: open), and how many are above.

    The range comes from a sketch; exact counts prove it or have it widened.
    """
    while True:
        share = 1 - wanted / total
        ends = [max(0.0, share - width), min(1.0, share + width)]
        low, high = scored.agg(F.percentile_approx("score", ends, SKETCH).alias("ends")).first().ends
        low, high = (None if ends[0] <= 0 else low), (None if ends[1] >= 1 else high)
        above = F.lit(False) if high is None else F.col("score") > high
        inside = ~above & (F.lit(True) if low is None else F.col("score") >= low)
        counted = scored.agg(F.count_if(above).alias("above"), F.count_if(inside).alias("inside")).first()
        if counted.above < wanted <= counted.above + counted.inside:
            return low, high, counted.above
        width *= 8


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; ``rank`` numbers the drawn ones from 1, highest score first.

    Drawn are ``percent`` of a hundred of the rows with at least ``min_words`` words, rounded down.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    scored = pin(weighed(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("id"), seed)))
    columns = ["id", "n_features", "weight", "score"]
    able = scored.filter(F.col("n_words") >= min_words)
    total = able.count()
    wanted = percent * total // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*columns, unranked)
    low, high, above = bracket(able, wanted, total)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    over = F.lit(False) if high is None else F.col("score") > high
    under = F.lit(False) if low is None else F.col("score") < low
    short = F.col("n_words") < min_words
    first = number_rows(able.filter(over).select(*columns), order, "at").select(*columns, (F.col("at") + 1).alias("rank"))
    located = number_rows(able.filter(~over & ~under).select(*columns), order, "at").withColumn("rank", F.col("at") + (above + 1))
    middle = located.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    others = scored.filter(short | under).select(*columns, unranked)
    return others.unionByName(first).unionByName(middle)
