"""Benchmark passages in documents, by one Aho-Corasick automaton over words.

Benchmark texts are normalised to words and cut into windows; the automaton's
alphabet is their words, so a document is scanned once, word by word, whatever the
number of windows. Word numbers are mapped back to the places in the original text.

The benchmark's size is checked: up to ``SHARD_CHARS`` of it make one automaton, and
what is larger makes several, each of bounded size, that scan one after the other.

Defined cases: a null text has no words, as a document and as an item; an item
without words has no window; equal items count once each, equal item ids once
together, and a null item id marks words but is not listed. Repeated documents each
get a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .frames import LOWER, UPPER, bounded_batches, utf8

WINDOW = 10
SHARD_CHARS = 2_000_000

# Fixed values of the word rule: A-Z are lower-cased, then [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_DIGITS = b"0123456789"
_NORMAL = bytes(c if c >= 0x80 or c in LOWER or c in _DIGITS else LOWER[c - 65] if c in UPPER else 0x20 for c in range(256))

Windows = dict[tuple[bytes, ...], list[str | None]]


def words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def windows(items: list[tuple[str | None, str]], size: int) -> Windows:
    """Every window of words, with the ids of the items it is from."""
    found: Windows = {}
    for item, text in items:
        own = words(text.encode())
        for k in range(max(1, len(own) - size + 1) if own else 0):
            found.setdefault(tuple(own[k:k + size]), []).append(item)
    return found


class Scanner:
    """The automaton, and the numbers of the words it knows."""

    def __init__(self, found: Windows):
        self.numbers: dict[bytes, int] = {}
        self.items = [sorted({i for i in ids if i is not None}) for ids in found.values()]
        self.sizes = [len(window) for window in found]
        self.shortest = min(self.sizes, default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, window in enumerate(found):
            self.automaton.add_word(tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window), k)
        if found:
            self.automaton.make_automaton()

    def scan(self, own: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Numbers of the words inside any occurrence, and the items that occur."""
        if not own or not self.numbers:
            return np.empty(0, np.int64), []
        number = self.numbers.get
        numbers = np.array([0, *(number(w, 0) for w in own), 0])
        ends, windows = [], []
        # A word of no window ends every match: only runs of known words as long as some window are walked.
        breaks = np.flatnonzero(numbers == 0)
        for run in np.flatnonzero(np.diff(breaks) > self.shortest).tolist():
            first = int(breaks[run])
            for end, window in self.automaton.iter(tuple(numbers[first + 1:breaks[run + 1]].tolist())):
                ends.append(first + end)
                windows.append(window)
        if not ends:
            return np.empty(0, np.int64), []
        last = np.array(ends) + 1
        change = np.zeros(len(own) + 1, np.int64)
        np.add.at(change, last - np.array([self.sizes[k] for k in windows]), 1)
        np.add.at(change, last, -1)
        return np.flatnonzero(np.cumsum(change)), sorted({i for k in set(windows) for i in self.items[k]})


def places(text: bytes, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points at which these words of the original text start and end."""
    plain = np.frombuffer(text.translate(_NORMAL), np.uint8)
    inner = np.concatenate([[False], plain != 0x20, [False]])
    edges = np.flatnonzero(inner[1:] != inner[:-1])
    point = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return point[edges[::2][numbers]], point[edges[1::2][numbers]]


_HITS = "array<struct<word:int,start:int,end:int>>"
_WORDS = pa.struct([("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def _shards(benchmark: DataFrame, item_col: str, text_col: str, size: int, chars: int) -> Iterator[Windows]:
    """Windows of the benchmark; one shard is on the driver at a time, and bounded."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body")).distinct()
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    count = -(-total // chars) or 1
    for shard in range(count):
        part = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(count)) == shard) if count > 1 else items
        yield windows([(r.item, r.body) for r in part.collect()], size)


def _scan(docs: DataFrame, found: Windows) -> DataFrame:
    """(id, text_key, n_words, hits, items) of every row, for one shard."""
    held = docs.sparkSession.sparkContext.broadcast(found)  # bounded by SHARD_CHARS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(held.value)
        for batch in batches:
            raw, offsets = utf8(batch.column(2))
            data = raw.tobytes()
            count, hits, items = [], [], []
            for a, b in zip(offsets, offsets[1:]):
                own = words(text := data[a:b])
                hit, named = scanner.scan(own)
                starts, ends = places(text, hit) if len(hit) else (hit, hit)
                count.append(len(own))
                hits.append(pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (hit, starts, ends)], fields=list(_WORDS)))
                items.append(named)
            first = np.concatenate([[0], np.cumsum([len(h) for h in hits])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.concat_arrays(hits) if hits else pa.array([], _WORDS)),
                 pa.array(items, pa.list_(pa.string()))], names=["id", "text_key", "n_words", "hits", "items"])

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(task, f"id long, text_key long, n_words long, hits {_HITS}, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(id, n_words, hits, items) of every row of ``docs``.

    ``hits`` are the words inside an occurrence: number, and start and end (exclusive)
    in code points of the original text; ``items`` the ids, as sorted text.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"),
                        F.col(text_col).cast("string").alias("text"))
    shards = [_scan(plain, found) for found in _shards(benchmark, item_col, item_text_col, window, shard_chars)]
    if len(shards) == 1:
        return shards[0].select("id", "n_words", "hits", "items")
    base, *more = [pin(s) for s in shards]
    every = base
    for other in more:
        every = every.unionByName(other)
    merged = (every.filter(F.size("hits") > 0).groupBy("id", "text_key")
              .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("hits"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
              .withColumnsRenamed({"id": "hit_id", "text_key": "hit_key"}))
    joined = base.select("id", "text_key", "n_words").join(
        merged, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    return joined.select("id", "n_words", F.coalesce("hits", F.array().cast(_HITS)).alias("hits"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The rows of ``docs``, whole, in which no window of the benchmark occurs."""
    at, schema = docs.columns.index(text_col), docs.schema
    for found in _shards(benchmark, item_col, item_text_col, window, shard_chars):
        held = docs.sparkSession.sparkContext.broadcast(found)  # bounded by SHARD_CHARS

        def task(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(held.value)
            for batch in batches:
                raw, offsets = utf8(batch.column(at))
                data = raw.tobytes()
                clean = [not len(scanner.scan(words(data[a:b]))[0]) for a, b in zip(offsets, offsets[1:])]
                yield batch.filter(pa.array(clean, pa.bool_()))

        bounded_batches(docs.sparkSession)
        docs = docs.mapInArrow(task, schema)
    return docs
