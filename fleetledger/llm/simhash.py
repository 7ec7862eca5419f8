"""Near copies by SimHash fingerprints, found with tables of pivot distances.

Fingerprints of equal value are one node. Two that differ in at most three bits
agree in one of four blocks of their bits, so candidates meet in buckets (block,
value); a bucket that many share is cut by the same rule over its other bits, and
what is still large by pairs of slices, so no task gets an unbounded bucket and no
pair is lost. In a bucket every fingerprint has its row of the pivot table: the
Hamming distances to ``PIVOTS`` reference fingerprints. By the triangle inequality
two fingerprints within three bits differ by at most three in every coordinate;
the bucket is swept in the order of the first coordinate, pairs whose largest
difference is over three are discarded, and the rest are verified. Links leave a
task as one per fingerprint, to the least of its group there.

Defined cases: null and empty texts have no words and the fingerprint zero, which
links like any other; fewer words than a shingle are one shingle. Repeated rows
each get a row. A null id counts as no id: it never is a component's id, and a
component without any has none. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .components import components
from .frames import LOWER, UPPER, groups, map_batches, mix, partitions_for, unused, utf8

SHINGLE = 3
MAX_BITS = 3
SEED = 42
PIVOTS = 32
# A bucket above this many fingerprints is cut further.
BUCKET = 4_096

_LANES = np.uint64(0x0101010101010101)
_LOWERED = bytes.maketrans(UPPER, LOWER)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of all shingles of a text, repeats included."""
    words = text.translate(_LOWERED).split()  # bytes.split parts at exactly \x20 and \x09-\x0D
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    last = min(size, len(words)) - 1
    ends = (starts + lengths)[last:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends)), np.uint64, len(ends))


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row (its hashes start at ``first``, which has one more than rows) the bits set in over half of them."""
    rows = len(first) - 1
    found = np.zeros(rows, np.uint64)
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    if not len(full):
        return found
    # Eight counters of a byte each are added at once, over at most 255 hashes.
    pieces = -(-sizes[full] // 255)
    owner = np.repeat(np.arange(len(full)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = first[full][owner] + 255 * nth
    heads = np.cumsum(pieces) - pieces
    for low in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(low)) & _LANES, cuts)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), heads, axis=0)
        over = (2 * counts > sizes[full][:, None]).astype(np.uint64)
        for byte in range(8):
            found[full] |= over[:, byte] << np.uint64(8 * byte + low)
    return found


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_key, fingerprint) of every row; ``text_key`` tells texts of one id apart."""
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, offsets = utf8(batch.column(2))
        data = raw.tobytes()
        found = []
        for a, b in groups(offsets):
            each = [shingle_hashes(data[offsets[k]:offsets[k + 1]], shingle) for k in range(a, b)]
            first = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
            found.append(majority_bits(np.concatenate(each), first))
        prints = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)],
                                         names=["id", "text_key", "fingerprint"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"),
                        F.col(text_col).cast("string").alias("text"))
    return map_batches(plain, rows, "id long, text_key long, fingerprint long")


def _blocks(width: int, count: int) -> list[tuple[int, int]]:
    """(shift, width) of ``count`` blocks that cover ``width`` bits."""
    edges = [width * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bits(column, shift: int, width: int):
    return F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << width) - 1))


def _buckets(prints: DataFrame, bits: int, bucket: int) -> DataFrame:
    """(bucket, fingerprint): fingerprints within ``bits`` share a bucket of bounded size at least once."""
    first = _blocks(64, bits + 1)
    node = F.col("fingerprint")
    keyed = prints.select(node, F.explode(F.array(*[
        F.struct(F.lit(k).alias("block"), _bits(node, shift, width).alias("value"))
        for k, (shift, width) in enumerate(first)])).alias("b")).select("fingerprint", "b.*")

    def crowded(rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.count("*").alias("members")).filter(F.col("members") > bucket)

    # Of a crowded bucket, the bits outside its block are cut into blocks in the same way.
    finer = []
    for k, (shift, width) in enumerate(first):
        above = F.shiftrightunsigned(node, shift + width) if shift + width < 64 else F.lit(0).cast("long")
        rest = F.shiftleft(above, shift).bitwiseOR(_bits(node, 0, shift)) if shift else above
        finer.append(F.array(*[F.struct(F.lit(j).alias("part"), _bits(rest, s, w).alias("inner"))
                               for j, (s, w) in enumerate(_blocks(64 - width, bits + 1))]))
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("inner")))
    cut = F.when(F.col("members").isNull(), whole)
    for k, parts in enumerate(finer):
        cut = cut.when(F.col("block") == k, parts)
    by = ["block", "value", "part", "inner"]
    rows = (keyed.join(crowded(keyed, "block", "value"), ["block", "value"], "left")
            .select("fingerprint", "block", "value", F.explode(cut).alias("p"))
            .select("fingerprint", "block", "value", "p.*"))
    # What is still crowded is dealt to slices, and every pair of slices is a bucket.
    still = crowded(rows.filter("part >= 0"), *by).select(*by, F.ceil(F.col("members") / bucket).cast("int").alias("slices"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("slices")).cast("int")
    pairs = F.when(F.col("slices").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("slices") - 1),
                    lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j"))))
    return (rows.join(still, by, "left").select("fingerprint", *by, F.explode(pairs).alias("s"))
            .select(F.xxhash64(*by, "s.i", "s.j").alias("bucket"), "fingerprint"))


def pivot_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances, one line per pivot."""
    return np.stack([np.bitwise_count(prints ^ p).astype(np.int8) for p in pivots])


def reference_prints(count: int) -> np.ndarray:
    """The pivots: zero, then spread numbers; the same on every task."""
    return np.concatenate([np.zeros(1, np.uint64), mix(np.arange(1, count, dtype=np.uint64) << np.uint64(32))])


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a[i] and b[i]; ``root`` names the least member of each group."""
    while True:
        left, right = root[a], root[b]
        apart = left != right
        if not apart.any():
            return
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(root, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def bucket_links(bucket: np.ndarray, prints: np.ndarray, bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link from each fingerprint to the least one of its group, over all buckets."""
    table = pivot_table(prints, pivots)
    order = np.lexsort((prints, table[0], bucket))
    bucket, prints, table = bucket[order], prints[order], table[:, order]
    root, last = np.arange(len(prints)), len(prints)
    near = np.arange(last)
    step = 0
    while len(near):
        step += 1
        near = near[near < last - step]
        other = near + step
        # Sorted by the first coordinate: once a partner is too far there, so are all later ones.
        going = (bucket[near] == bucket[other]) & (table[0, other] - table[0, near] <= bits)
        near, other = near[going], other[going]
        apart = root[near] != root[other]
        a, b = near[apart], other[apart]
        for line in table[1:]:
            if not len(a):
                break
            keep = np.abs(line[a] - line[b]) <= bits
            a, b = a[keep], b[keep]
        if len(a):
            close = np.bitwise_count(prints[a] ^ prints[b]) <= bits
            if close.any():
                _merge(root, a[close], b[close])
    hung = np.flatnonzero(root != np.arange(last))
    return prints[hung], prints[root[hung]]


def links(prints: DataFrame, bits: int = MAX_BITS, pivots: int = PIVOTS, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links that join exactly the fingerprints (distinct, column ``fingerprint``) connected within ``bits``."""
    references = reference_prints(pivots)

    def task(table: pa.Table) -> pa.Table:
        found = bucket_links(table["bucket"].to_numpy(), table["fingerprint"].to_numpy().view(np.uint64), bits, references)
        return pa.table({"u": found[0].view(np.int64), "v": found[1].view(np.int64)})

    parts = 4 * partitions_for(prints)  # a fingerprint is in four buckets
    return (_buckets(prints, bits, bucket)
            .select(F.pmod("bucket", F.lit(parts)).alias("part"), "bucket", "fingerprint")
            .groupBy("part").applyInArrow(task, "u long, v long"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: (id, text_key, fingerprint, root, component).

    ``component`` is the least id reachable over links, ``root`` the least fingerprint.
    """
    marked = pin(fingerprints(docs, id_col, text_col, shingle))
    nodes = marked.groupBy("fingerprint").agg(F.min("id").alias("least"))
    grown = components(links(nodes.select("fingerprint"), bits))
    rooted = (nodes.join(grown.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
              .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))
    named = pin(rooted).groupBy("root").agg(F.min("least").alias("component"))
    by_print = pin(rooted.select("fingerprint", "root").join(named, "root"))
    return marked.join(by_print, "fingerprint").select("id", "text_key", "fingerprint", "root", "component")


def as_hex(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the least id; of repeated rows any, of an id's texts one."""
    rows = near_copies(docs, id_col, text_col, shingle, bits)
    # The joined columns are those by which repeated rows are dropped, so texts are shuffled once.
    names = [unused(docs, c) for c in ("kept_none", "kept_id", "kept_text")]

    def keys(none, key, text) -> list:
        return [c.alias(n) for c, n in zip((none, F.coalesce(key, F.lit(0)), text), names)]

    first = (rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("k"))
             .select(*keys(F.col("k.none"), F.col("k.id"), F.col("k.text_key"))))
    own = F.col(id_col).cast("long")
    keyed = docs.select(docs["*"], *keys(own.isNull(), own, F.xxhash64(text_col)))
    return keyed.join(first, names, "left_semi").dropDuplicates(names).select(*docs.columns)
