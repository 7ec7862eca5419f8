"""Toxicity categories by a chain of linear models over hashed words.

A text's features are its distinct words and word beginnings (of some bytes, lower-cased
in A-Z), by hash. Categories are predicted in the given order; each linear model also gets the
probabilities of the categories before it. In training those come out of folds: a text's
earlier probabilities are predicted by models that haven't seen it.

Training reads a bounded sample, ``SAMPLE_TEXTS`` labelled texts of least id hash for each value of the
last single category, weighted back to their shares; of the features the
``SELECTED`` that tell a category most are kept. Features are counted and picked where the texts are, so
the driver gets a line per feature and at most ``SELECTED`` places per text. The models of a category, one for each
fold and one for all, are fitted in a task each. Scoring reads every text whole.

Defined cases: a null text counts as empty and gets the score of no features. Ids that
are null, labelled more than one way, or without a label of some category don't train; without any
labels every probability is 0.5. Repeated rows each get a row; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin
from .frames import UPPER, Words, bounded_batches, byte_class, groups, least_hashes, map_batches, spans_hash, utf8

SAMPLE_TEXTS = 6_000
FOLDS = 3
SELECTED = 2_000
SPACE = 3 << 17
BEGINNINGS = (4, 6)
THRESHOLD = 0.5

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[np.frombuffer(UPPER, np.uint8)] += 32
# A word is letters and whatever is beyond ASCII.
_BETWEEN = byte_class(bytes(c for c in range(128) if not chr(c).isalpha()))


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of the texts, row by row, and where each row's start (one more than rows)."""
    rows, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, b in groups(offsets):
        part = _LOWERED[raw[offsets[a]:offsets[b]]]
        words = Words(part, offsets[a:b + 1] - offsets[a], _BETWEEN)
        ends = [words.ends, *(np.minimum(words.ends, words.starts + n) for n in BEGINNINGS)]
        each = np.uint64(SPACE // len(ends))
        hashes = np.concatenate([spans_hash(part, words.starts, e) % each + np.uint64(k) * each for k, e in enumerate(ends)])
        distinct = np.unique(np.tile(words.rows() + a, len(ends)) * SPACE + hashes.astype(np.int64))
        rows.append(distinct // SPACE)
        found.append(distinct % SPACE)
    rows, found = np.concatenate(rows), np.concatenate(found)
    return found, np.searchsorted(rows, np.arange(len(offsets)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Sparse:
    """Selected features of some texts, with the logarithm of how many features each text has."""

    row: np.ndarray
    column: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(found: np.ndarray, first: np.ndarray, places: np.ndarray) -> Sparse:
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        column = places[found]
        known = column >= 0
        return Sparse(row[known], column[known].astype(np.int64), np.log1p(np.diff(first)))

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], len(self.size))


@dataclass(frozen=True)
class Linear:
    """Weights of the selected features, and of one, the size and the earlier categories' log-odds."""

    words: np.ndarray
    dense: np.ndarray

    def odds(self, x: Sparse, earlier: list[np.ndarray]) -> np.ndarray:
        return x.sums(self.words) + np.stack([np.ones(len(x.size)), x.size, *earlier], axis=1) @ self.dense


def fit(x: Sparse, earlier: list[np.ndarray], label: np.ndarray, weight: np.ndarray, width: int,
        ridge: float = 3e-5, steps: int = 250, rate: float = 0.5) -> Linear:
    """Weighted logistic regression by Adagrad; size and earlier log-odds are standardised."""
    weight = weight / max(weight.sum(), 1e-9)
    dense = np.stack([np.ones(len(label)), x.size, *earlier], axis=1)
    mean = weight @ dense
    spread = np.sqrt(weight @ (dense - mean) ** 2) + 1e-6
    mean[0], spread[0] = 0, 1
    dense = (dense - mean) / spread
    words, other = np.zeros(width), np.zeros(dense.shape[1])
    seen_words, seen_other = np.full(width, 1e-8), np.full(dense.shape[1], 1e-8)
    for _ in range(steps):
        off = weight * (_sigmoid(x.sums(words) + dense @ other) - label)
        slope = np.bincount(x.column, off[x.row], width) + ridge * words
        slope_other = off @ dense
        seen_words += slope ** 2
        seen_other += slope_other ** 2
        words -= rate * slope / np.sqrt(seen_words)
        other -= rate * slope_other / np.sqrt(seen_other)
    other = other / spread
    other[0] -= mean[1:] @ other[1:]
    return Linear(words, other)


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    places: np.ndarray  # of each feature: its number among the selected, or -1
    models: tuple[Linear, ...]

    def probabilities(self, column: pa.Array) -> list[np.ndarray]:
        """Of each category in turn, for a column of texts."""
        if not self.models:
            return [np.full(len(column), 0.5) for _ in self.categories]
        x = Sparse.of(*features(*utf8(column)), self.places)
        odds: list[np.ndarray] = []
        for model in self.models:
            odds.append(np.clip(model.odds(x, odds), -8, 8))
        return [_sigmoid(o) for o in odds]


def _selected(total: np.ndarray, with_label: np.ndarray, texts: int, labelled: np.ndarray) -> np.ndarray:
    """Numbers of the features that differ most between a category's texts and the others (chi-square).

    ``total`` counts the texts with each feature, ``with_label`` those of each category; ``labelled`` are a category's texts.
    """
    each = SELECTED // len(with_label)
    chosen: set[int] = set()
    for own, n in zip(with_label, labelled):
        share = max(1.0, float(n)) / max(texts, 1)
        expected = total * share
        score = np.where(total >= 3, (own - expected) ** 2 / np.maximum(expected * (1 - share), 1e-9), 0)
        best = np.argsort(-score, kind="stable")[:each]
        chosen.update(best[score[best] > 0].tolist())
    places = np.full(SPACE, -1, np.int16)
    places[sorted(chosen)] = np.arange(len(chosen))
    return places


def _fits(spark: SparkSession, x: Sparse, earlier: list[np.ndarray], label: np.ndarray, weights: list[np.ndarray], width: int) -> list[Linear]:
    """A model for each of the weightings, each fitted in a task of its own."""
    held = spark.sparkContext.broadcast((x, earlier, label, weights, width))  # bounded by the sample

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, earlier, label, weights, width = held.value
        for batch in batches:
            models = [fit(x, earlier, label, weights[k], width) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([v.tobytes() for v in side], pa.binary()) for side in (
                [m.words for m in models], [m.dense for m in models])]], names=["id", "words", "dense"])

    found = spark.range(0, len(weights), 1, len(weights)).mapInArrow(task, "id long, words binary, dense binary").collect()
    held.unpersist()
    return [Linear(np.frombuffer(r.words), np.frombuffer(r.dense)) for r in sorted(found)]


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], stratum: str, id_col: str = "doc_id",
          text_col: str = "text") -> Chain:
    """Fit the chain on ``labels`` (id, one 0/1 column per category, sampled per value of ``stratum``)."""
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(id_col).isNotNull())
    for c in categories:
        known = known.filter(F.col(c).isin(0, 1))
    single = (known.groupBy(F.col(id_col).cast("long").alias("train_id"))
              .agg(*[F.min(c).cast("int").alias(c) for c in categories], F.count_distinct(*categories).alias("ways"))
              .filter("ways = 1").withColumn("draw", F.xxhash64("train_id", F.lit("toxicity"))))
    total = {r[stratum]: r["count"] for r in single.groupBy(stratum).count().collect()}  # two rows
    if not total:
        return Chain(tuple(categories), np.empty(0, np.int16), ())
    sides = [least_hashes(single.filter(F.col(stratum) == v), "draw", SAMPLE_TEXTS, n) for v, n in sorted(total.items())]
    drawn = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, first = features(*utf8(batch.column(batch.num_columns - 1)))
        lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(found, pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "features"])

    texts = docs.select(F.col(id_col).cast("long").alias("train_id"), F.col(text_col).cast("string").alias("body"))
    # At most two samples of narrow rows are broadcast.
    sample = texts.join(F.broadcast(drawn), "train_id").select("draw", *categories, "body")
    named = ", ".join(f"{c} int" for c in categories)
    held = pin(map_batches(sample, rows, f"draw long, {named}, features array<int>"))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(batch.num_columns - 1)
        flat, many = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
        feature, place = np.unique(flat, return_inverse=True)
        weights = [np.ones(len(flat)), *[np.repeat(batch.column(k + 1).to_numpy(zero_copy_only=False), many) for k in range(len(categories))]]
        return pa.RecordBatch.from_arrays(
            [pa.array(feature, pa.int32()), *[pa.array(np.bincount(place, w, len(feature)).astype(np.int64)) for w in weights]],
            names=["feature", "n", *[f"n_{k}" for k in range(len(categories))]])

    sums = ["n", *[f"n_{k}" for k in range(len(categories))]]
    lines = (map_batches(held, counted, "feature int, " + ", ".join(f"{c} long" for c in sums))
             .groupBy("feature").agg(*[F.sum(c).alias(c) for c in sums]).toArrow())  # at most SPACE lines
    counts = np.zeros((len(sums), SPACE))
    counts[:, lines["feature"].to_numpy()] = [lines[c].to_numpy() for c in sums]
    size = held.agg(F.count("*").alias("texts"), *[F.sum(c).alias(f"n_{k}") for k, c in enumerate(categories)]).first()
    places = _selected(counts[0], counts[1:], size.texts, np.array([size[f"n_{k}"] or 0 for k in range(len(categories))]))
    width = int(places.max()) + 1

    def picked(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(batch.num_columns - 1)
        many = lists.value_lengths().to_numpy(zero_copy_only=False)
        column = places[lists.flatten().to_numpy(zero_copy_only=False)]
        row = np.repeat(np.arange(batch.num_rows), many)[column >= 0]
        first = np.searchsorted(row, np.arange(batch.num_rows + 1))
        own = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(column[column >= 0], pa.int16()))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(many, pa.int32()), own],
                                          names=[*batch.schema.names[:-1], "size", "columns"])

    table = map_batches(held, picked, f"draw long, {named}, size int, columns array<smallint>").toArrow().combine_chunks()
    lists = table["columns"].combine_chunks()
    spelled = [x.tobytes() for x in np.split(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1])]
    draw, total_size = table["draw"].to_numpy(), table["size"].to_numpy()
    order = sorted(range(len(draw)), key=lambda k: (draw[k], total_size[k], spelled[k]))
    table = table.take(pa.array(order, pa.int64()))
    lists = table["columns"].combine_chunks()
    label = {c: table[c].to_numpy().astype(float) for c in categories}
    weight = np.ones(table.num_rows)
    for v, n in total.items():
        own = label[stratum] == v
        weight[own] = n / max(1, own.sum())
    fold = table["draw"].to_numpy() % FOLDS
    whole = Sparse(np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False)),
                   lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.log1p(table["size"].to_numpy()))
    earlier: list[np.ndarray] = []
    models = []
    for c in categories:
        last = c == categories[-1]
        # Only the others' weights count, so a fold's own texts don't train what predicts them.
        weights = [weight, *([] if last else [weight * (fold != f) for f in range(FOLDS)])]
        model, *without = _fits(docs.sparkSession, whole, earlier, label[c], weights, width)
        models.append(model)
        if not last:
            out = np.zeros(len(fold))
            for f, other in enumerate(without):
                out[fold == f] = other.odds(whole, earlier)[fold == f]
            earlier = [*earlier, np.clip(out, -8, 8)]
    return Chain(tuple(categories), places, tuple(models))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one probability per category) of every row."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, chain.probabilities(batch.column(1)))],
                                          names=["id", *chain.categories])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(plain, rows, "id long, " + ", ".join(f"{c} double" for c in chain.categories))
