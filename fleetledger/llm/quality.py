"""Quality scores from compressed sizes with trained zstandard dictionaries.

One dictionary is built from good, one from bad labelled text. A whole text is
compressed piece by piece with either; the difference of the sizes over their sum,
with the length and the compression ratio, goes through a logistic calibration. The
labelled texts are dealt to ``FOLDS`` folds: a pair of dictionaries is built without
each fold and calibrated on it, so no pair is calibrated on text it has seen, and the
score is that of the pairs' mean log-odds.

Training reads a bounded sample: per class the ``SAMPLE_TEXTS`` texts of least id
hash, of which the dictionaries take ``PIECES`` pieces each, drawn by hash over the
whole text. Scoring reads every text whole, in tasks that hold one batch.

Defined cases: null text counts as empty; an empty text gets the score of its length.
Ids that are null or labelled both ways, and labels that are null, don't train. A
class without texts has an empty dictionary, and labels of one class give every text
their smoothed share; without any labels every score is 0.5.
Repeated rows each get a row, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import bounded_batches, least_hashes, map_batches, utf8

SAMPLE_TEXTS = 6_000
FOLDS = 3
PIECE = 1_024
PIECES = 4
DICT_BYTES = 64 << 10
# A dictionary has a byte for so many of the smaller class's sample, up to DICT_BYTES.
SAMPLE_PER_DICT = 4
LEAST_DICT = 256  # zstandard's own
LEVEL = 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class Pair:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] = ()

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        return [zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None,
            write_content_size=False, write_dict_id=False) for d in (self.good, self.bad)]


def sizes(data: np.ndarray, offsets: np.ndarray, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """(good, bad, raw) bytes of each text."""
    raw = memoryview(np.ascontiguousarray(data))
    good, bad = (c.compress for c in compressors)
    found = np.zeros((len(offsets) - 1, 3))
    for k in range(len(found)):
        a, b = int(offsets[k]), int(offsets[k + 1])
        pieces = [raw[i:min(b, i + PIECE)] for i in range(a, b, PIECE)]
        found[k] = sum(len(good(p)) for p in pieces), sum(len(bad(p)) for p in pieces), b - a
    return found


def features(found: np.ndarray) -> np.ndarray:
    good, bad, raw = found.T
    lean = (bad - good) / np.maximum(1, bad + good)
    ratio, length = good / np.maximum(1, raw), np.log1p(raw)
    return np.stack([np.ones(len(raw)), lean, lean * length, length, ratio, ratio * length, np.minimum(ratio, 0.2)], axis=1)


def log_odds(found: np.ndarray, weights: tuple[float, ...]) -> np.ndarray:
    return np.clip(features(found) @ np.array(weights), -30, 30) if weights else np.zeros(len(found))


def calibrate(found: np.ndarray, label: np.ndarray, ridge: float = 0.3, steps: int = 200) -> tuple[float, ...]:
    """Weights of a ridge logistic fit; damped Newton steps on standardised features."""
    if not len(label):
        return ()
    if len(set(label.tolist())) == 1:  # nothing to tell apart: the smoothed share alone
        return (float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1))), *[0.0] * (features(found).shape[1] - 1))
    plain = features(found)
    mean, spread = plain.mean(axis=0), plain.std(axis=0) + 1e-9
    mean[0], spread[0] = 0, 1
    x = (plain - mean) / spread
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - label) + ridge * w
        w -= 0.5 * np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
    w = w / spread
    w[0] -= mean[1:] @ w[1:]
    return tuple(w.tolist())


def _trained(samples: list[bytes], size: int) -> bytes | None:
    """A trained dictionary, or nothing where zstandard refuses."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return None


def dictionaries(*classes: list[bytes]) -> list[bytes]:
    """A dictionary of each class's pieces, all trained at one size, which follows the smallest class that has any.

    Where zstandard refuses a class (a few pieces), its joined pieces serve raw, and the others are trained at their size.
    """
    total = [sum(map(len, c)) for c in classes]
    size = max(LEAST_DICT, min(DICT_BYTES, min(filter(None, total), default=0) // SAMPLE_PER_DICT))
    made = [_trained(c, size) for c in classes]
    if refused := [n for d, n in zip(made, total) if n and d is None]:
        size = min(DICT_BYTES, *refused)
        made = [d and _trained(c, size) for c, d in zip(classes, made)]
    return [d or b"".join(c)[-size:] for c, d in zip(classes, made)]


def _labelled_ids(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
            .groupBy(F.col(id_col).cast("long").alias("train_id"))
            .agg(F.min(label_col).cast("int").alias("train_label"), F.max(label_col).cast("int").alias("top"))
            .filter("train_label = top").select("train_id", "train_label", F.xxhash64("train_id").alias("draw")))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> list[Pair]:
    """Fit on the rows of ``labels``; ``docs`` holds their texts."""
    bounded_batches(docs.sparkSession)
    ids = _labelled_ids(labels, id_col, label_col)
    total = {r.train_label: r["count"] for r in ids.groupBy("train_label").count().collect()}  # two rows
    sides = [least_hashes(ids.filter(F.col("train_label") == c), "draw", SAMPLE_TEXTS, total.get(c, 0)) for c in (0, 1)]
    # At most 2 * SAMPLE_TEXTS narrow rows are broadcast.
    sample = (docs.select(F.col(id_col).cast("long").alias("train_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
              .join(F.broadcast(sides[0].unionByName(sides[1])), "train_id")
              .select("train_id", "train_label", "draw", F.pmod("draw", F.lit(FOLDS)).alias("fold"), "body"))

    last = F.floor(F.greatest(F.length("body") - 1, F.lit(0)) / PIECE).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.xxhash64("train_id", i).alias("draw"), F.substring("body", i * PIECE + 1, F.lit(PIECE)).alias("piece")))
    rows = sample.select("train_label", "fold", "draw", F.slice(F.array_sort(cut), 1, PIECES)["piece"].alias("pieces")).collect()
    rows.sort(key=lambda r: (r.draw, r.pieces))

    def pieces(fold: int, label: int) -> list[bytes]:
        return list(dict.fromkeys(p.encode() for r in rows if r.fold != fold and r.train_label == label for p in r.pieces if p))

    pairs = [Pair(*dictionaries(pieces(f, 1), pieces(f, 0))) for f in range(FOLDS)]

    def task(batch: pa.RecordBatch) -> pa.RecordBatch:
        fold, data, offsets = batch.column(0).to_numpy(), *utf8(batch.column(2))
        found = np.zeros((len(fold), 3))
        for f, pair in enumerate(pairs):
            own = np.flatnonzero(fold == f)
            compressors = pair.compressors()
            for k in own:
                found[k] = sizes(data[offsets[k]:offsets[k + 1]], offsets[k:k + 2] - offsets[k], compressors)[0]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, found.T)],
                                          names=["fold", "label", "good", "bad", "raw"])

    fit = np.array(map_batches(sample.select("fold", "train_label", "body"), task, "fold long, label int, good double, "
                               "bad double, raw double").collect(), dtype=float).reshape(-1, 5)
    fit = fit[np.lexsort(fit.T)]
    return [Pair(p.good, p.bad, calibrate(fit[fit[:, 0] == f, 2:], fit[fit[:, 0] == f, 1])) for f, p in enumerate(pairs)]


def scorer(model: list[Pair]) -> Callable[[pa.Array], np.ndarray]:
    """Scores of a column of texts."""
    tools = [(pair.compressors(), pair.weights) for pair in model]

    def found(column: pa.Array) -> np.ndarray:
        data, offsets = utf8(column)
        odds = sum((log_odds(sizes(data, offsets, c), w) for c, w in tools), np.zeros(len(column))) / max(1, len(tools))
        return 1 / (1 + np.exp(-odds))

    return found


def score(docs: DataFrame, model: list[Pair], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(model)(batch.column(1)))], names=["id", "score"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")),
                       rows, "id long, score double")


def keep_good(docs: DataFrame, model: list[Pair], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, whole, whose text scores ``threshold`` or more."""
    at = docs.columns.index(text_col)

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(scorer(model)(batch.column(at)) >= threshold))

    return map_batches(docs, rows, docs.schema)


def held_out(column):
    """The rows that never train: crc32 of the id as text leaves 2 by 4; a null id is not held out."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
