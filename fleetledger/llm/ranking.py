"""Ranked lexical search with the Best Position Algorithm over shards of impact lists.

One pass over the texts finds the words that some query asks for and packs them with the
collection's statistics. A shard turns its part into one list per term, sorted by impact.
Lists are read from the top, all at one depth (sorted access). A document met there is looked up in
every list (direct access), which gives its whole score and marks its positions as seen. A
list's best position is where its unbroken run of seen positions ends: no document that is
still unseen can stand before it, so the impacts found there bound every unseen score. The
bound is tighter than one from the last position read. Reading stops once it is strictly below
the k-th best score, so that ties are never lost. Scores are integers; k-th best scores carry
over from shard to shard of a task, and the shards' answers are merged.

The queries' terms are held in every task: queries go in rounds of about ``ROUND_BYTES`` of
terms, each over all documents; the terms of one query are held whole.

Defined cases: a null text has no terms, as a document and as an item; an item without
terms ranks nothing. Rows of one item id are one item with the terms of all of them, a null id
included. Repeated document ids are ranked row by row; a null one loses ties. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .frames import LOWER, UPPER, bounded_batches, utf8

TOP = 10
ROUND_BYTES = 16 << 20
SHARD_DOCS = 16_384
SHARD_ENTRIES = 4_000_000
NO_ID = 2 ** 63 - 1

# Fixed values of the term rule: only A-Z are lower-cased, and a term is a run of these.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_DIGITS = b"0123456789"
_NORMAL = bytes(c if c >= 0x80 or c in LOWER or c in _DIGITS else LOWER[c - 65] if c in UPPER else 0x20 for c in range(256))
# Fixed values of the score.
_FLAT, _LENGTH, _UNIT = 10, 90, 10 ** 9

_BLOCKS = "docs binary, lengths binary, n_docs long, n_terms long, terms array<int>, found array<int>, doc binary, tf binary"


def _index(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Blocks of documents: their ids and lengths, and by term the places and counts of those that hold it."""
    held = docs.sparkSession.sparkContext.broadcast(numbers)  # bounded by ROUND_BYTES

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            data = raw.tobytes()
            lengths, keys = np.zeros(batch.num_rows, np.int64), []
            for k, (a, b) in enumerate(zip(offsets, offsets[1:])):
                own = data[a:b].translate(_NORMAL).split()
                lengths[k] = len(own)
                terms = np.fromiter(map(number, own, repeat(-1)), np.int64, len(own))
                keys.append(terms[terms >= 0] * batch.num_rows + k)
            key, tf = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
            terms, found = np.unique(key // max(1, batch.num_rows), return_counts=True)
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({
                "docs": [ids.astype("<i8").tobytes()], "lengths": [lengths.astype("<i8").tobytes()],
                "n_docs": [int((lengths > 0).sum())], "n_terms": [int(lengths.sum())],
                "terms": pa.array([terms.astype(np.int32)], pa.list_(pa.int32())),
                "found": pa.array([found.astype(np.int32)], pa.list_(pa.int32())),
                "doc": [(key % max(1, batch.num_rows)).astype("<i4").tobytes()], "tf": [tf.astype("<i4").tobytes()]})

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(task, _BLOCKS)


class Shard:
    """Impact lists by term, best first; documents of equal impact by place."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray,
                 weights: np.ndarray, documents: int, words: int):
        self.ids = ids
        scale = _FLAT + _LENGTH * lengths * documents // max(1, words)
        impact = weights[term] * (_UNIT * tf // (1000 * tf + 8 * scale[doc]))
        held = impact > 0
        term, doc, impact = term[held], doc[held], impact[held]
        order = np.lexsort((doc, -impact, term))
        self.docs, self.impacts = doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def search(self, query: np.ndarray, top: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """``top`` (scores, ids; best first) with what this shard has for the query's terms."""
        begins, ends = self.first[query], self.first[query + 1]
        query, begins, ends = (x[ends > begins] for x in (query, begins, ends))
        edges = np.concatenate([[0], np.cumsum(ends - begins)])
        total, lists = int(edges[-1]), len(begins)
        if not total or (len(top[0]) == k and self.impacts[begins].sum() < top[0][-1]):
            return top
        docs = np.concatenate([self.docs[a:b] for a, b in zip(begins, ends)])
        impacts = np.append(np.concatenate([self.impacts[a:b] for a, b in zip(begins, ends)]), 0)
        # Where each document stands in each list; ``total`` where it doesn't.
        place = np.full((lists, len(self.ids)), total, np.int32)
        place[np.repeat(np.arange(lists), ends - begins), docs] = np.arange(total)
        seen, met = np.zeros(total + 1, bool), np.zeros(len(self.ids), bool)
        depth, step = 0, k
        while True:
            at = np.concatenate([np.arange(a + depth, min(a + depth + step, b)) for a, b in zip(edges, edges[1:])])
            fresh = docs[at[~seen[at]]]
            fresh = np.unique(fresh[~met[fresh]])
            met[fresh] = True
            found = place[:, fresh]
            seen[found] = True
            top = _best(np.concatenate([top[0], impacts[found].sum(axis=0)]), np.concatenate([top[1], self.ids[fresh]]), k)
            # The first unseen position of each list, or its end.
            unseen = np.append(np.flatnonzero(~seen[:total]), total)
            position = unseen[np.searchsorted(unseen, edges[:-1])]
            bound = impacts[position[position < edges[1:]]].sum()
            if bound == 0 or (len(top[0]) == k and bound < top[0][-1]):
                return top
            depth, step = depth + step, 2 * step


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, words: int) -> Iterator[Shard]:
    """Blocks gathered to shards of about ``SHARD_DOCS`` documents or ``SHARD_ENTRIES`` entries."""
    held: list[tuple[np.ndarray, ...]] = []
    docs = entries = 0

    def made() -> Shard:
        ids, lengths, term, doc, tf = (np.concatenate(column) for column in zip(*held))
        return Shard(ids, lengths, term, doc, tf, weights, documents, words)

    for batch in batches:
        for row in batch.to_pylist():
            ids, doc = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["doc"], "<i4").astype(np.int64)
            if held and (docs + len(ids) > SHARD_DOCS or entries + len(doc) > SHARD_ENTRIES):
                yield made()
                held, docs, entries = [], 0, 0
            term = np.repeat(np.array(row["terms"], np.int64), np.array(row["found"], np.int64))
            held.append((ids, np.frombuffer(row["lengths"], "<i8"), term, doc + docs, np.frombuffer(row["tf"], "<i4").astype(np.int64)))
            docs, entries = docs + len(ids), entries + len(doc)
    if held:
        yield made()


def _searched(blocks: DataFrame, queries: list[np.ndarray], weights: np.ndarray, documents: int, words: int, k: int) -> DataFrame:
    """(query, id, score): each task's best documents."""
    held = blocks.sparkSession.sparkContext.broadcast((queries, weights))  # bounded by ROUND_BYTES

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = held.value
        none = np.empty(0, np.int64)
        best = [(none, none)] * len(asked)
        for shard in _shards(batches, weight, documents, words):
            best = [shard.search(query, top, k) for query, top in zip(asked, best)]
        count = [len(s) for s, _ in best]
        ids = np.concatenate([none, *[i for _, i in best]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), count), pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID),
             pa.array(np.concatenate([none, *[s for s, _ in best]]), pa.int64())], names=["query", "id", "score"])

    return blocks.select("docs", "lengths", "terms", "found", "doc", "tf").mapInArrow(task, "query long, id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(item, rank, id, score): each item's ``k`` best documents with a score above 0, ties to the lesser id."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    lowered = F.translate(F.col(item_text_col).cast("string"), UPPER.decode(), LOWER.decode())
    asked = pin(items.select(F.col(item_col).alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), 0)).alias("term")).distinct())
    total = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    rounds = -(-total // round_bytes) or 1
    ranked = None
    for turn in range(rounds):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(rounds)) == turn)
        found = _round(plain, mine, k)
        ranked = found if ranked is None else ranked.unionByName(found)
    return ranked


def _round(plain: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = plain.sparkSession
    numbers: dict[bytes, int] = {}
    by_item: dict[object, list[int]] = {}
    for item, term in asked.collect():  # bounded by ROUND_BYTES
        by_item.setdefault(item, []).append(numbers.setdefault(term.encode(), len(numbers)))
    bounded_batches(spark)
    blocks = pin(_index(plain, numbers))
    size = blocks.agg(F.sum("n_docs").alias("documents"), F.sum("n_terms").alias("words")).first()
    documents, words = size.documents or 0, size.words or 0
    holding = np.zeros(len(numbers), np.int64)
    pairs = blocks.select(F.explode(F.arrays_zip("terms", "found")).alias("p")).groupBy("p.terms").agg(F.sum("p.found").alias("n"))
    for r in pairs.collect():  # one row per term of the queries
        holding[r.terms] = r.n
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holding.tolist()], np.int64)
    names = list(by_item)
    queries = [np.array(sorted(by_item[i]), np.int64) for i in names]
    found = _searched(blocks, queries, weights, documents, words, k)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    kind = asked.schema["item"].dataType.simpleString()
    named = spark.createDataFrame(list(enumerate(names)), f"query long, item {kind}")
    return best.join(F.broadcast(named), "query").select("item", "rank", "id", "score")
