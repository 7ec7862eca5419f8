"""The compression classifier: held-out accuracy, bounds and odd input."""

import math
import random

import numpy as np
import pytest
import zstandard
from fleetledger.llm import quality
from pyspark.sql import functions as F


def corpus(n, seed=1):
    rng = random.Random(0)
    vocabulary = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 8))) for _ in range(400)]
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randint(15, 300))
        good = rng.random() < 0.7
        text = " ".join(words) if good else " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in words)
        rows.append((k, text))
        labels.append((k, int(good), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def model(spark, docs):
    rows, labels = corpus(400)
    return quality.train(docs(rows), spark.createDataFrame(labels, LABELS))


def test_unseen_texts_are_told_apart(spark, docs, model):
    rows, labels = corpus(200, seed=9)
    got = {r.id: r.score for r in quality.score(docs(rows), model).collect()}
    right = sum((got[i] >= quality.THRESHOLD) == bool(q) for i, q, _ in labels)
    assert right >= 190 and all(0 <= s <= 1 for s in got.values())


def test_whole_texts_count(spark, docs, model):
    rows, _ = corpus(50, seed=4)
    good = " ".join(t for _, t in rows if "#" not in t)
    bad_end = good + " " + " ".join(w + "###" for w in (good * 8).split())
    got = {r.id: r.score for r in quality.score(docs([(1, good), (2, bad_end)]), model).collect()}
    assert got[1] >= quality.THRESHOLD > got[2]


def test_null_empty_long_and_repeated_rows_get_a_score(spark, docs, model):
    got = quality.score(docs([(1, None), (1, None), (2, ""), (3, "word " * 200_000), (None, "x")]), model).collect()
    assert len(got) == 5 and all(r.score is not None for r in got)
    assert len({r.score for r in got if r.id in (1, 2)}) == 1  # null is empty
    assert quality.score(docs([]), model).count() == 0


def test_labels_missing_contradictory_or_of_one_kind(spark, docs):
    rows, _ = corpus(20)
    none = quality.train(docs(rows), spark.createDataFrame([], LABELS))
    assert {r.score for r in quality.score(docs(rows), none).collect()} == {0.5}
    odd = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 0), (3, None, 0)], LABELS)
    assert {r.score for r in quality.score(docs(rows), quality.train(docs(rows), odd)).collect()} == {0.5}
    one = spark.createDataFrame([(k, 1, 0) for k in range(20)], LABELS)
    assert all(r.score > 0.5 for r in quality.score(docs(rows), quality.train(docs(rows), one)).collect())


def test_the_same_rows_give_the_same_model(spark, docs):
    rows, labels = corpus(60)
    frame = spark.createDataFrame(labels, LABELS)
    assert quality.train(docs(rows), frame) == quality.train(docs(rows[::-1]), frame.repartition(5))


def test_kept_rows_keep_every_column(spark, docs, model):
    rows, labels = corpus(60, seed=2)
    frame = docs(rows).withColumns({"score": F.lit("mine"), "train_id": F.lit(None).cast("int")})
    kept = quality.keep_good(frame, model)
    assert kept.schema == frame.schema
    scored = {r.id for r in quality.score(frame, model).filter(F.col("score") >= quality.THRESHOLD).collect()}
    assert {r.doc_id for r in kept.collect()} == scored and 0 < len(scored) < 60


def test_held_out_rows_are_the_crc_of_the_id_as_text(spark):
    import zlib

    got = spark.range(200).select("id", quality.held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


TRAINED = bytes.fromhex("37a430ec")  # how zstandard marks a trained dictionary


def test_small_and_uneven_classes_train_dictionaries_of_one_size(spark, docs):
    rows, labels = corpus(700, seed=3)
    bad = [i for i, q, _ in labels if not q][:60]  # a rare class beside a common one
    labels = [row for row in labels if row[1] or row[0] in bad]
    for pair in quality.train(docs(rows), spark.createDataFrame(labels, LABELS)):
        assert pair.good[:4] == pair.bad[:4] == TRAINED
        assert len(pair.good) == len(pair.bad) < quality.DICT_BYTES


def test_a_class_too_small_to_train_keeps_all_its_pieces():
    texts = [text.encode() for _, text in corpus(300)[0]]
    few, many = quality.dictionaries(texts[:3], texts[3:])
    assert few == b"".join(texts[:3]) and many[:4] == TRAINED and len(many) <= len(few)
    assert quality.dictionaries([], texts)[0] == b"" and quality.dictionaries([], []) == [b"", b""]
    assert quality.dictionaries([b"a"], [b"b"]) == [b"a", b"b"]


def test_a_score_equals_a_plain_computation(spark, docs):
    """Every piece compressed by itself with either dictionary, the features and their weighted sum written out."""
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(2, 8)))
    rows = [(k, " ".join(word("aeinrst" if k % 2 else "qxzjkw#") for _ in range(rng.randint(1, 400)))) for k in range(120)]
    model = quality.train(docs(rows), spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int"))
    asked = [(500 + k, t) for k, (_, t) in enumerate(rows[:20])] + [(600, ""), (601, None), (602, "é" * 5_000)]
    got = {r.id: r.score for r in quality.score(docs(asked), model).collect()}
    for i, text in asked:
        data, odds = (text or "").encode(), []
        for pair in model:
            both = []
            for held in (pair.good, pair.bad):
                tool = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(held), write_content_size=False, write_dict_id=False)
                both.append(sum(len(tool.compress(data[a:a + 1_024])) for a in range(0, len(data), 1_024)))
            good, bad = both
            lean, ratio, length = (bad - good) / max(1, bad + good), good / max(1, len(data)), math.log(1 + len(data))
            x = [1, lean, lean * length, length, ratio, ratio * length, min(ratio, 0.2)]
            odds.append(min(30, max(-30, sum(w * v for w, v in zip(pair.weights, x)))))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-sum(odds) / len(odds))), abs=1e-9)


def test_the_calibration_is_at_the_bottom_of_its_loss():
    rng = np.random.default_rng(2)
    found = np.stack([rng.integers(50, 500, 300), rng.integers(50, 500, 300), rng.integers(500, 2_000, 300)], axis=1).astype(float)
    label = (found[:, 0] + rng.normal(0, 100, 300) < found[:, 1]).astype(float)
    weights = quality.calibrate(found, label)
    x = quality.features(found)
    spread = x.std(axis=0) + 1e-9

    def loss(w):
        odds = x @ np.array(w)
        return (np.log1p(np.exp(odds)) - label * odds).sum() + 0.15 * ((np.array(w) * spread)[1:] ** 2).sum()

    best = loss(weights)
    for _ in range(50):
        assert loss(np.array(weights) + rng.normal(0, 0.02, len(weights)) / np.maximum(spread, 1e-3)) > best - 0.05
