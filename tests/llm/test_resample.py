"""Importance resampling against features spelled out one by one."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetledger.llm import resample
from fleetledger.llm.frames import Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[k:k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def bucket(run):
    return zlib.crc32(run.encode()) % 10_000


def brute(docs, target, percent=5, least=20):
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for run in runs(text)[1]:
                counts[bucket(run)] += 1
    big_s, big_t = s.sum(), t.sum()
    gain = [math.floor(1000 * math.log((b + 1) * (big_s + 10_000) / ((a + 1) * (big_t + 10_000)))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for i, text in docs:
        words, own = runs(text)
        weight = sum(gain[bucket(r)] for r in own)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able):
        r.append(k + 1 if k < percent * len(able) // 100 else None)
    return sorted((tuple([*r[:4], r[5] if len(r) > 5 else None]) for r in rows), key=repr)


def got(df):
    return sorted(((r.id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=repr)


def sample(seed, n=400):
    draw = random.Random(seed)
    words = [f"Word{k}" for k in range(200)] + ["été", "x" * 70, "y" * 150]
    return [(k, " ".join(draw.choices(words, k=draw.randrange(60)))) for k in range(n)], [" ".join(draw.choices(words[:40], k=30)) for _ in range(20)]


@pytest.mark.parametrize("text", ["", "a", "a b", "A b C d", "x" * 64 + " " + "y" * 65 + " z", "w" * 1_000_003 + " v", "été-ÀB 日本 1_2", "\x7f{}~"])
def test_run_hashes_are_crc32(text):
    raw, other = (np.frombuffer(x.encode(), np.uint8) for x in (text, "next row"))
    found, row, words = resample.features(np.concatenate([raw, other]), np.array([0, len(raw), len(raw) + len(other)]))
    assert sorted(found[row == 0].tolist()) == sorted(bucket(r) for r in runs(text)[1])
    assert sorted(found[row == 1].tolist()) == sorted(bucket(r) for r in ("next", "row", "next row"))
    assert words.tolist() == [len(runs(text)[0]), 2]


def test_word_hashes_at_every_length():
    data = b" ".join(b"q" * n for n in range(1, 200))
    raw = np.frombuffer(data, np.uint8)
    words = Words(raw, np.array([0, len(raw)]))
    assert resample.word_hashes(raw, words).tolist() == [zlib.crc32(w) for w in data.split()]


@pytest.mark.parametrize("seed", range(2))
def test_equal_to_brute_force(spark, docs, seed):
    rows, target = sample(seed)
    assert got(resample.resample(docs(rows), docs(list(enumerate(target))))) == brute(rows, target)


def test_copies_and_ties_draw_as_many_rows(spark, docs):
    rows, target = sample(5, 100)
    rows += [(50, rows[1][1] + " more" * 30)] * 300 + [(None, "null id " * 20)] * 20
    want = brute(rows, target, 40)
    assert got(resample.resample(docs(rows), docs(list(enumerate(target))), percent=40)) == want


@pytest.mark.parametrize("wanted", [1, 30, 999, 1_000])
@pytest.mark.parametrize("width", [1e-9, 0.3])
def test_bracket_holds_the_cutoff(spark, wanted, width):
    scored = spark.range(1_000).select((F.col("id") * 7919 % 1_000 / 10).cast("long").alias("score"))
    low, high, above = resample.bracket(scored, wanted, 1_000, width)
    scores = sorted((r.score for r in scored.collect()), reverse=True)
    assert above == sum(high is not None and s > high for s in scores)
    assert (low is None or low <= scores[wanted - 1]) and (high is None or scores[wanted - 1] <= high)


def test_odd_tables(spark, docs):
    rows = [(1, None), (2, ""), (3, "a b"), (None, "long words " * 40), (5, "word " * 300_000), (5, "word " * 300_000)]
    target = docs([(1, "long words"), (2, None)])
    want = brute(rows, ["long words", None], 50)
    clashing = docs(rows).withColumns({c: F.lit(1) for c in ("id", "score", "rank", "weight", "n_words", "at")})
    assert got(resample.resample(clashing, target, percent=50)) == want
    assert got(resample.resample(docs([]), target)) == []
    assert got(resample.resample(docs(rows), docs([]))) == brute(rows, [])
