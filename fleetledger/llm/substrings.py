"""Repeated passages of words, by suffix trees in groups by prefix.

A suffix matters only if its opening, the first ``min_words`` words, recurs: then it hangs under a node of
at least that depth of the suffix tree. The tree is built in parts, and only where it is that deep:

1. A suffix is dealt by a piece of its opening, which is all that a part needs to have in common. That piece is
   its least run of ``GRAM`` words (by hash), so that neighbouring suffixes mostly share one and travel together,
   their words once. Every batch lists its runs with the number of suffixes under them; groups by hash find what recurs
   and add up the sizes. A run with more than ``GROUP_SUFFIXES`` suffixes is lengthened: its suffixes are dealt by their
   whole opening, a prefix of ``min_words`` words, under which there is at most one for each block of documents.
2. The remaining suffixes are cut out, each distinct opening once per block, with the least document that has it.
3. Each part numbers its words exactly, sorts its suffixes and takes the common depth of neighbours: the nodes
   of its subtrees. Leaves under one node of depth ``min_words`` are one repeat; blocks whose document is not
   the node's least learn about that one by its place in the block.
4. Blocks mark the words of every opening that starts in a lesser document too.

``maximal_repeats`` goes on from the same parts: it follows the suffixes to ``deep`` words, and its deep
inner nodes with different words before their leaves are the maximal repeats.

Blocks of documents are dealt by hash and are read in every step from one shuffle. A
passage that very many documents share is listed once per block, never per document.

Hashes only choose where suffixes meet. Words are told apart by their bytes, and openings by
their words: where hashes of two openings are equal, the words are compared.

Defined cases: a null text has no words; a null id counts as greater than every id.
Rows of equal id don't repeat each other. Texts shorter than ``min_words`` words repeat
nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import IS_SPACE, Words, bounded_batches, groups, partitions_for, runs_hash, spans_hash, utf8

MIN_WORDS = 13
GRAM = 5
# A run with more suffixes than this is lengthened to the whole opening. A suffix takes about a
# hundred bytes, so that a group has some 20 MB at most; equal openings number at most the blocks.
GROUP_SUFFIXES = 200_000
BLOCKS_PER_PARTITION = 4
# A task takes the groups of suffixes that it is dealt in so many turns.
TURNS = 8
NO_ID = 2 ** 63 - 1
# How far ``maximal_repeats`` follows a suffix.
DEEP = 64


def _ids(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _ordered(docs: pa.Table) -> pa.Table:
    """A block's rows in an order that doesn't depend on how they came: by id, then text."""
    return docs.take(pc.sort_indices(docs, sort_keys=[("id", "ascending"), ("text", "ascending")])).combine_chunks()


def numbered(raw: np.ndarray, words: Words) -> np.ndarray:
    """Exact numbers of the words: equal ones for equal bytes only."""
    plain = raw[~IS_SPACE[raw]]
    bounds = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(plain))])
    return column.dictionary_encode().indices.to_numpy()


def exact_classes(hashes: np.ndarray, ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for each opening at ``at``, equal for equal words only. Words are compared where hashes are equal."""
    order = np.argsort(hashes, kind="stable")
    same = np.concatenate([[False], hashes[order][1:] == hashes[order][:-1]]) if len(order) else np.empty(0, bool)
    pairs = np.flatnonzero(same)
    here, before = at[order[pairs]], at[order[pairs - 1]]
    equal = np.ones(len(pairs), bool)
    for k in range(size):
        equal &= ids[here + k] == ids[before + k]
    found = np.empty(len(order), np.int64)
    group = np.cumsum(~same) - 1
    found[order] = group
    if not equal.all():  # different words with one hash: told apart one by one
        mixed = np.unique(group[pairs[~equal]])
        known: dict[tuple, int] = {}
        for k in np.flatnonzero(np.isin(found, mixed)).tolist():
            spelled = tuple(ids[at[k]:at[k] + size].tolist())
            found[k] = known.setdefault(spelled, len(order) + len(known))
    return found


class Openings:
    """The openings of some texts: word and opening hashes, and the keying run of each opening."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, size: int):
        self.words = Words(raw, offsets)
        self.hashes = spans_hash(raw, self.words.starts, self.words.ends)
        self.at = np.flatnonzero(self.words.room() >= size)  # words at which an opening starts
        self.row = self.words.rows()[self.at]
        self.whole = runs_hash(self.hashes, size)[self.at]
        self.size = size

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """For each opening the word at which its least run starts (the first of equal ones), and that run's hash."""
        gram = min(GRAM, self.size)
        runs = runs_hash(self.hashes, gram)
        if not len(self.at):
            return self.at, runs[:0]
        width = self.size - gram + 1
        last = len(runs) - width + 1
        least, place = runs[:last].copy(), np.zeros(last, np.int64)
        for step in range(1, width):
            other = runs[step:step + last]
            less = other < least
            least[less] = other[less]
            place[less] = step
        return self.at + place[self.at], least[self.at]


def _opened(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, int, Openings]]:
    """Openings by groups of rows: the first row, its byte, the number of words before, and the group."""
    words = 0
    for a, b in groups(offsets):
        found = Openings(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], size)
        yield a, int(offsets[a]), words, found
        words += len(found.words)


def _stacked(parts: list[tuple[np.ndarray, ...]], kinds: str) -> list[np.ndarray]:
    return [np.concatenate([np.empty(0, k), *column]) for k, column in zip(kinds.split(), zip(*parts) if parts else [()] * len(kinds.split()))]


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows that are equal in all (sorted) columns begins."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _list_keys(batch: pa.RecordBatch, size: int, buckets: int, twice: bool = False) -> pa.RecordBatch:
    """Keying runs by bucket and block: each at most twice a block (for two of its documents), with its number of suffixes.

    ``twice`` also lists a run twice that recurs in one document.
    """
    raw, offsets = utf8(batch.column(1))
    block = batch.column(2).to_numpy()
    keys, rows, weights = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, _, _, found in _opened(raw, offsets, size):
        place, key = found.keys()
        new = _heads(place)
        keys.append(key[new])
        rows.append(found.row[new] + a)
        weights.append(np.diff(np.append(new, len(place))))
    key, row, weight = (np.concatenate(x) for x in (keys, rows, weights))
    home = block[row]
    same = home if twice else row  # a run counts once for each document, or as often as it is there
    order = np.lexsort((same, key))
    key, home, same, weight = key[order], home[order], same[order], weight[order]
    new = _heads(key, same)
    several = np.diff(np.append(new, len(key))) > 1
    weight = np.add.reduceat(weight, new) if len(new) else weight
    key, home = key[new], home[new]
    if twice:
        key, home, weight = (np.concatenate([x, x[several]]) for x in (key, home, weight))
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((key, home, bucket))
    key, home, bucket, weight = (x[order] for x in (key, home, bucket, weight))
    third = np.zeros(len(key), bool)
    third[2:] = (key[2:] == key[:-2]) & (home[2:] == home[:-2])
    # What is not listed counts with the second one listed.
    listed = np.flatnonzero(~third)
    weight = np.add.reduceat(weight, listed) if len(listed) else weight
    key, home, bucket = key[listed], home[listed], bucket[listed]
    heads = _heads(bucket, home)
    ends = np.append(heads[1:], len(key))
    few = np.minimum(weight, 2 ** 16 - 1).astype("<u2")
    parts = list(zip(heads.tolist(), ends.tolist()))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[heads], pa.int64()), pa.array(home[heads], pa.int64()), pa.array([key[a:b].tobytes() for a, b in parts], pa.binary()),
         pa.array([few[a:b].tobytes() for a, b in parts], pa.binary())], names=["bucket", "block", "keys", "sizes"])


def _recurring(table: pa.Table) -> pa.Table:
    """Of a bucket's keys those listed twice or more, for each block that has them; those of large groups apart."""
    lists = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    home = np.repeat(table["block"].to_numpy(), [len(k) for k in lists])
    key = np.concatenate(lists)
    size = np.concatenate([np.frombuffer(k, "<u2") for k in table["sizes"].to_pylist()]).astype(np.int64)
    order = np.lexsort((home, key))
    key, home, size = key[order], home[order], size[order]
    heads = _heads(key)
    count = np.diff(np.append(heads, len(key)))
    each, total = np.repeat(count, count), np.repeat(np.add.reduceat(size, heads), count)
    new = np.zeros(len(key), bool)
    new[_heads(key, home)] = True
    keep = new & (each > 1)
    key, home, large = key[keep], home[keep], total[keep] > GROUP_SUFFIXES
    order = np.argsort(home, kind="stable")
    key, home, large = key[order], home[order], large[order]
    heads = _heads(home)
    parts = list(zip(heads.tolist(), np.append(heads[1:], len(home)).tolist()))
    return pa.table({"block": pa.array(home[heads], pa.int64()),
                     "keys": pa.array([key[a:b].tobytes() for a, b in parts], pa.binary()),
                     "large": pa.array([key[a:b][large[a:b]].tobytes() for a, b in parts], pa.binary())})


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(column.to_pylist()), np.uint64))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


_SUFFIXES = "part long, turn long, block long, words binary, place long, least binary"


def _cut_out(docs: pa.Table, kept: pa.Table, size: int, parts: int) -> pa.Table:
    """A block's suffixes under recurring keys: runs of distinct openings, their place in the block, and the least document of each."""
    empty = pa.table({"part": pa.array([], pa.int64()), "turn": pa.array([], pa.int64()), "block": pa.array([], pa.int64()),
                      "words": pa.array([], pa.binary()), "place": pa.array([], pa.int64()), "least": pa.array([], pa.binary())})
    if not kept.num_rows or not docs.num_rows:
        return empty
    known, large = _joined(kept["keys"]), _joined(kept["large"])
    docs = _ordered(docs)
    raw, offsets = utf8(docs["text"])
    ids = _ids(docs["id"])
    found_parts = []
    for a, byte, before, found in _opened(raw, offsets, size):
        _, key = found.keys()
        mine = np.flatnonzero(_among(key, known))
        at = found.at[mine]
        found_parts.append((at + before, found.whole[mine], key[mine], ids[found.row[mine] + a],
                            found.words.starts[at] + byte, found.words.ends[at + size - 1] + byte))
    at, whole, key, doc, begin, end = _stacked(found_parts, "i8 u8 u8 i8 i8 i8")
    if not len(at):
        return empty
    opening = exact_classes(whole, numbered(raw, Words(raw, offsets)), at, size)
    order = np.lexsort((doc, opening))
    chosen = np.sort(order[_heads(opening[order])])  # one place of each opening, of its least document
    at, key, whole, doc, begin, end = (x[chosen] for x in (at, key, whole, doc, begin, end))
    prefix = np.where(_among(key, large), whole, key)
    cut = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (prefix[1:] != prefix[:-1]) | (doc[1:] != doc[:-1])])
    heads = np.flatnonzero(cut)
    tails = np.append(heads[1:], len(at)) - 1
    begin, end = begin[heads], end[tails]
    data = raw.tobytes()
    group = prefix[heads] % np.uint64(parts * TURNS)
    return pa.table({"part": pa.array((group % np.uint64(parts)).astype(np.int64)),
                     "turn": pa.array((group // np.uint64(parts)).astype(np.int64)),
                     "block": pa.array(np.full(len(heads), docs["block"][0].as_py()), pa.int64()),
                     "words": pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
                     "place": pa.array(at[heads], pa.int64()),
                     "least": pa.array([doc[a:b + 1].tobytes() for a, b in zip(heads.tolist(), tails.tolist())], pa.binary())})


def sorted_suffixes(ids: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that start at ``at`` by their first ``size`` words, and how many words each shares with the one before."""
    table = np.stack([ids[at + k] for k in range(size)])
    bits = max(1, int(ids.max()).bit_length())
    per = max(1, 63 // bits)
    packed = []
    for k in range(0, size, per):
        line = np.zeros(len(at), np.int64)
        for row in table[k:k + per]:
            line = (line << bits) | row
        packed.append(line)
    order = np.lexsort(packed[::-1])
    equal = table[:, order[1:]] == table[:, order[:-1]]
    shared = np.where(equal.all(axis=0), size, np.argmin(equal, axis=0))
    return order, np.concatenate([[0], shared])


def _subtrees(table: pa.Table, size: int) -> pa.Table:
    """The deep nodes of a task's groups: for each block whose document is not a node's least, the opening's place and that least."""
    turn = table["turn"].to_numpy()
    found = [_deep_nodes(table.filter(pa.array(turn == t)), size) for t in np.unique(turn)]
    home, place, lowest = _stacked(found, "i8 i8 i8")
    by = np.argsort(home, kind="stable")
    home, place, lowest = home[by], place[by], lowest[by]
    heads = _heads(home)
    parts = list(zip(heads.tolist(), np.append(heads[1:], len(home)).tolist()))
    return pa.table({"block": pa.array(home[heads], pa.int64()),
                     "places": pa.array([place[a:b].tobytes() for a, b in parts], pa.binary()),
                     "least": pa.array([lowest[a:b].tobytes() for a, b in parts], pa.binary())})


def _read_runs(column: pa.ChunkedArray) -> tuple[np.ndarray, Words, np.ndarray]:
    """The bytes of runs of words, their words, and the words' exact numbers."""
    data = column.to_pylist()
    raw = np.frombuffer(b"".join(data), np.uint8)
    words = Words(raw, np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))
    return raw, words, numbered(raw, words)


def _deep_nodes(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, place, least document) of the leaves under nodes of depth ``size`` that are not their node's least."""
    _, words, ids = _read_runs(table["words"])
    at = np.flatnonzero(words.room() >= size)
    openings = np.diff(words.first) - size + 1
    least = np.frombuffer(b"".join(table["least"].to_pylist()), np.int64)
    block = np.repeat(table["block"].to_numpy(), openings)
    ends = np.cumsum(openings)
    place = np.repeat(table["place"].to_numpy() - (ends - openings), openings) + np.arange(len(at))
    order, shared = sorted_suffixes(ids, at, size)
    node = np.cumsum(shared < size) - 1  # leaves under one node of depth ``size`` or more
    heads = np.flatnonzero(shared < size)
    lowest = np.minimum.reduceat(least[order], heads)[node]
    told = np.flatnonzero(lowest < least[order])
    leaf = order[told]
    return block[leaf], place[leaf], lowest[told]


def _remove(docs: pa.Table, told: pa.Table, size: int) -> pa.Table:
    """A block's texts without the words of openings that start in a lesser document."""
    docs = _ordered(docs)
    raw, offsets = utf8(docs["text"])
    ids, parts, counts = _ids(docs["id"]), [], [np.zeros(1, np.int64)]
    for a, _, before, found in _opened(raw, offsets, size):
        parts.append((found.at + before, found.whole, ids[found.row + a]))
        counts.append(np.diff(found.words.first))
    at, whole, doc = _stacked(parts, "i8 u8 i8")
    first = np.cumsum(np.concatenate(counts))
    covered = np.zeros(int(first[-1]) + 1, np.int64)
    if len(doc):
        opening = np.unique(exact_classes(whole, numbered(raw, Words(raw, offsets)), at, size), return_inverse=True)[1]
        least = np.full(int(opening.max()) + 1, NO_ID)
        np.minimum.at(least, opening, doc)
        if told.num_rows:
            place = np.frombuffer(b"".join(told["places"].to_pylist()), np.int64)
            np.minimum.at(least, opening[np.searchsorted(at, place)], np.frombuffer(b"".join(told["least"].to_pylist()), np.int64))
        start = at[least[opening] < doc]
        np.add.at(covered, start, 1)
        np.add.at(covered, start + size, -1)
    out = np.cumsum(covered)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(out)])
    removed = total[first[1:]] - total[first[:-1]]
    data, kept = raw.tobytes(), []
    for k, gone in enumerate(removed.tolist()):
        own = data[offsets[k]:offsets[k + 1]].split()
        kept.append(b" ".join(compress(own, ~out[first[k]:first[k + 1]]) if gone else own))
    return pa.table({"id": docs["id"], "n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                     "kept": pa.array(kept, pa.binary()).cast(pa.string())})


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(id, text, block) of every row, dealt to blocks, and the number of partitions."""
    bounded_batches(docs.sparkSession)
    n = partitions_for(docs)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(BLOCKS_PER_PARTITION * n))).repartition(n, "block"), n


def _recurring_keys(dealt: DataFrame, size: int, buckets: int, twice: bool = False) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _list_keys(batch, size, buckets, twice)

    listed = dealt.mapInArrow(task, "bucket long, block long, keys binary, sizes binary")
    return listed.groupBy("bucket").applyInArrow(_recurring, "block long, keys binary, large binary")


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept) of every row; ``kept`` are the words left, joined by one space."""
    # Every step reads this one shuffle; the plans are equal up to it.
    dealt, n = _dealt(docs, id_col, text_col)
    kept = _recurring_keys(dealt, min_words, n)
    suffixes = (dealt.groupBy("block").cogroup(kept.groupBy("block"))
                .applyInArrow(lambda left, right: _cut_out(left, right, min_words, n), _SUFFIXES))
    told = suffixes.groupBy("part").applyInArrow(lambda t: _subtrees(t, min_words), "block long, places binary, least binary")
    return (dealt.groupBy("block").cogroup(told.groupBy("block"))
            .applyInArrow(lambda left, right: _remove(left, right, min_words), "id long, n_words long, n_removed long, kept string"))


# --- maximal repeats -----------------------------------------------------------


_LEAVES = "part long, before binary, words binary, ends boolean, n long, least long"


def _leaves(docs: pa.Table, kept: pa.Table, size: int, deep: int, parts: int) -> pa.Table:
    """A block's suffixes under recurring keys to ``deep`` words, with the word before; equal ones once, with their number and least document."""
    empty = pa.table({"part": pa.array([], pa.int64()), "before": pa.array([], pa.binary()), "words": pa.array([], pa.binary()),
                      "ends": pa.array([], pa.bool_()), "n": pa.array([], pa.int64()), "least": pa.array([], pa.int64())})
    if not kept.num_rows or not docs.num_rows:
        return empty
    known, large = _joined(kept["keys"]), _joined(kept["large"])
    raw, offsets = utf8(docs["text"])
    ids, data, rows = _ids(docs["id"]), raw.tobytes(), []
    for a, byte, _, found in _opened(raw, offsets, size):
        _, key = found.keys()
        mine = np.flatnonzero(_among(key, known))
        at, words = found.at[mine], found.words
        prefix = np.where(_among(key[mine], large), found.whole[mine], key[mine])
        room = words.room()[at]
        last = at + np.minimum(room, deep) - 1
        first = words.first[found.row[mine]]
        for k, w, end, p, doc, cut, start in zip(at.tolist(), words.starts[at] + byte, words.ends[last] + byte, prefix.tolist(),
                                                 ids[found.row[mine] + a].tolist(), (room <= deep).tolist(), first.tolist()):
            before = data[words.starts[k - 1] + byte:words.ends[k - 1] + byte] if k > start else None
            rows.append((p % parts, before, b" ".join(data[w:end].split()), cut, doc))
    if not rows:
        return empty
    part, before, words, cut, doc = zip(*rows)
    table = pa.table({"part": pa.array(part, pa.int64()), "before": pa.array(before, pa.binary()), "words": pa.array(words, pa.binary()),
                      "ends": pa.array(cut, pa.bool_()), "doc": pa.array(doc, pa.int64())})
    own = table.group_by(["part", "before", "words", "ends"]).aggregate([("doc", "count"), ("doc", "min")])
    return own.select(["part", "before", "words", "ends", "doc_count", "doc_min"]).rename_columns(empty.column_names)


def inner_nodes(shared: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first leaf, last leaf) of every inner node of at least this depth, from the words that neighbours share."""
    open_nodes: list[tuple[int, int]] = []
    for k in range(1, len(shared) + 1):
        depth = int(shared[k]) if k < len(shared) else 0
        first = k - 1
        while open_nodes and open_nodes[-1][0] > depth:
            node, first = open_nodes.pop()
            yield node, first, k - 1
        if depth >= least and (not open_nodes or open_nodes[-1][0] < depth):
            open_nodes.append((depth, first))


def _maximal(table: pa.Table, size: int, deep: int) -> pa.Table:
    """The maximal repeats of a task's groups: deep inner nodes whose leaves have different words before them."""
    before, spelled = table["before"].to_pylist(), [w.split(b" ") for w in table["words"].to_pylist()]
    ends, count, doc = (table[c].to_pylist() for c in ("ends", "n", "least"))
    order = sorted(range(len(spelled)), key=lambda k: spelled[k])
    shared = np.zeros(len(order), np.int64)
    for k in range(1, len(order)):
        a, b = spelled[order[k - 1]], spelled[order[k]]
        shared[k] = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    found = []

    def node(depth: int, leaves: list[int]) -> None:
        total = sum(count[k] for k in leaves)
        words = {before[k] for k in leaves}
        # The start of a text differs from every word, also from another start.
        several = len(words) > 1 or (None in words and total > 1)
        if total > 1 and several and depth >= size:
            found.append((b" ".join(spelled[leaves[0]][:depth]).decode(), depth, total, min(doc[k] for k in leaves),
                          depth == deep and not all(ends[k] and len(spelled[k]) == depth for k in leaves)))

    for depth, first, last in inner_nodes(shared, size):
        node(depth, [order[k] for k in range(first, last + 1)])
    for k, leaf in enumerate(order):  # equal suffixes were put together before: a node of their own
        depth = len(spelled[leaf])
        if count[leaf] > 1 and max(int(shared[k]), int(shared[k + 1]) if k + 1 < len(order) else 0) < depth:
            node(depth, [leaf])
    text, depth, total, least, longer = zip(*found) if found else ([],) * 5
    return pa.table({"text": pa.array(text, pa.string()), "n_words": pa.array(depth, pa.int64()), "occurrences": pa.array(total, pa.int64()),
                     "least_id": pa.array([None if x == NO_ID else x for x in least], pa.int64()), "longer": pa.array(longer, pa.bool_())})


def maximal_repeats(docs: DataFrame, min_words: int = MIN_WORDS, deep: int = DEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, n_words, occurrences, least_id, longer) of every maximal repeat of at least ``min_words`` words.

    A maximal repeat occurs at two places or more, in one text or several, and any word added before or behind
    it loses some of them. Suffixes are followed for ``deep`` words: of a longer repeat the first ``deep`` words are
    given, marked ``longer``. Each suffix travels with its words, so the cost grows with ``deep``.
    """
    dealt, n = _dealt(docs, id_col, text_col)
    kept = _recurring_keys(dealt, min_words, n, twice=True)
    leaves = (dealt.groupBy("block").cogroup(kept.groupBy("block"))
              .applyInArrow(lambda left, right: _leaves(left, right, min_words, deep, n), _LEAVES))
    same = leaves.groupBy("part", "before", "words", "ends").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    return same.groupBy("part").applyInArrow(lambda t: _maximal(t, min_words, deep),
                                             "text string, n_words long, occurrences long, least_id long, longer boolean")
