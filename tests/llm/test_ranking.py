"""Ranked search against every document's score."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetledger.llm import ranking

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(ranking.TERM, (text or "").translate(LOWER))


def brute(docs, items, k=10):
    own = [(i, terms(t)) for i, t in docs]
    n_all, l_all = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = {}
    for _, w in own:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    found = []
    for item, query in asked.items():
        scores = []
        for i, w in own:
            m = 10 + 90 * len(w) * n_all // max(1, l_all)
            s = 0
            for t in query & set(w):
                tf = w.count(t)
                s += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf // (1000 * tf + 8 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0))
        found += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id string, text string")


def got(df):
    return sorted(((r.item, r.rank, r.id, r.score) for r in df.collect()), key=repr)


def sample(seed, n=300, words=40):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "x_y", "A1"]
    text = lambda most: " ".join(draw.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=draw.randrange(most)))
    return [(k, text(30)) for k in range(n)], [(f"q{k}", text(12)) for k in range(12)]


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_brute_force(spark, docs, seed):
    rows, items = sample(seed)
    assert got(ranking.rank(docs(rows), items_frame(spark, items))) == brute(rows, items)


def test_small_shards_and_rounds_change_nothing(spark, docs, monkeypatch):
    rows, items = sample(9)
    whole = got(ranking.rank(docs(rows), items_frame(spark, items)))
    assert got(ranking.rank(docs(rows), items_frame(spark, items), round_bytes=300)) == whole
    monkeypatch.setattr(ranking, "SHARD_DOCS", 7)
    assert got(ranking.rank(docs(rows), items_frame(spark, items))) == whole


def shard(impacts):
    """A shard with these impacts, one row per term and one column per document."""
    made = ranking.Shard.__new__(ranking.Shard)
    term, doc = np.nonzero(impacts)
    impact = impacts[term, doc]
    order = np.lexsort((doc, -impact, term))
    made.ids, made.docs, made.impacts = np.arange(impacts.shape[1]), doc[order], impact[order]
    made.first = np.searchsorted(term[order], np.arange(len(impacts) + 1))
    return made


@pytest.mark.parametrize("seed", range(20))
def test_best_positions_find_the_top_of_any_lists(seed):
    draw = np.random.default_rng(seed)
    impacts = draw.integers(0, 12, (6, 400)) * draw.integers(0, 2, (6, 400))
    made, none = shard(impacts), np.empty(0, np.int64)
    total = impacts.sum(axis=0)
    order = np.lexsort((np.arange(400), -total))[:10]
    scores, ids = made.search(np.arange(6), (none, none), 10)
    assert ids.tolist() == order.tolist() and scores.tolist() == total[order].tolist()


def test_reading_stops_early_and_only_strictly_below_the_last_score(monkeypatch):
    merged, best = [], ranking._best
    monkeypatch.setattr(ranking, "_best", lambda s, i, k: merged.append(len(s)) or best(s, i, k))
    impacts = np.ones((3, 5_000), np.int64)
    impacts[:, :20] = 1_000
    none = np.empty(0, np.int64)
    scores, ids = shard(impacts).search(np.arange(3), (none, none), 10)
    assert ids.tolist() == list(range(10)) and sum(merged) < 200
    merged.clear()
    shard(np.ones((3, 5_000), np.int64)).search(np.arange(3), (none, none), 10)  # all tie: none may be left out
    assert sum(merged) >= 5_000


def test_odd_tables(spark, docs):
    rows = [(1, None), (2, ""), (3, "alpha Beta"), (3, "alpha Beta"), (None, "alpha"), (4, "alpha " * 200_000), (5, "ALPHA-beta/gamma")]
    items = [("a", "Alpha beta"), ("a", "gamma"), (None, "beta"), ("none", None), ("blank", " - "), ("other", "delta")]
    clashing = docs(rows).withColumns({c: F.lit(1) for c in ("id", "item", "term", "score", "rank")})
    named = items_frame(spark, items).withColumns({c: F.lit("x") for c in ("item", "term", "query")})
    assert got(ranking.rank(clashing, named)) == brute(rows, items)
    assert got(ranking.rank(docs([]), items_frame(spark, items))) == []
    assert got(ranking.rank(docs(rows), items_frame(spark, []))) == []
