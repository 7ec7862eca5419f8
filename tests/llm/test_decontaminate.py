"""Benchmark passages: hits, items and places against brute force."""

import random
import re

import pytest
from fleetledger.llm import decontaminate
from pyspark.sql import functions as F

ITEMS = "item_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [(m[0], m.start(), m.end()) for m in re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)]


def brute(docs, items, size=10):
    found = []
    for i, text in docs:
        own = words(text)
        hit, named = set(), set()
        for item, other in items:
            target = [w for w, _, _ in words(other)]
            wide = min(size, len(target))
            wanted = {tuple(target[k:k + wide]) for k in range(len(target) - wide + 1)} if wide else set()
            for k in range(len(own) - wide + 1 if wide else 0):
                if tuple(w for w, _, _ in own[k:k + wide]) in wanted:
                    hit.update(range(k, k + wide))
                    named.add(item)
        found.append((i, len(own), [(k, *own[k][1:]) for k in sorted(hit)], sorted(str(x) for x in named if x is not None)))
    return sorted(found, key=str)


def rows_of(frame):
    return sorted(((r.id, r.n_words, [tuple(h) for h in r.hits], r["items"]) for r in frame.collect()), key=str)


def corpus():
    rng = random.Random(1)
    vocabulary = ["Zwölf", "été", "alpha", "Beta", "gamma7", "x", "delta", "épsilon"] + [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([2, 3, 9, 10, 11, 25])))) for k in range(12)]
    items += [(50, items[0][1]), (51, None), (52, "...!"), (53, "single"), (None, "w1 w2 w3 nobody")]
    docs = []
    for k in range(40):
        parts = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            part = rng.choice(items)[1] or ""
            parts.insert(rng.randint(0, len(parts)), re.sub(" ", rng.choice([" ", "\n", " -- ", "😀".join(["", ""]) or "_"]), part.upper()))
        docs.append((k, " ".join(parts)))
    return docs + [(100, None), (101, ""), (102, "SINGLE-single; é single"), (103, "w1 w2 w3 nobody w1"), (None, "single"), (102, "single")], items


@pytest.mark.parametrize("chars", [2_000_000, 300])
def test_hits_items_and_places_equal_brute_force(spark, docs, chars):
    texts, items = corpus()
    got = decontaminate.contamination(docs(texts), spark.createDataFrame(items, ITEMS), shard_chars=chars)
    want = brute(texts, items)
    assert rows_of(got) == want and any(h for _, _, h, _ in want)


def test_long_texts_and_overlapping_occurrences(spark, docs):
    item = " ".join(["ab"] * 12)
    text = "zz " * 50_000 + "ab " * 15 + "zz " * 50_000
    got = decontaminate.contamination(docs([(1, text)]), spark.createDataFrame([(1, item)], ITEMS)).first()
    assert got.n_words == 100_015 and [h.word for h in got.hits] == list(range(50_000, 50_015))


@pytest.mark.parametrize("chars", [2_000_000, 300])
def test_kept_rows_are_the_clean_ones_with_all_columns(spark, docs, chars):
    texts, items = corpus()
    frame = docs(texts).withColumns({"items": F.lit(1), "hits": F.lit("mine"), "item_id": F.lit(7)})
    kept = decontaminate.keep_clean(frame, spark.createDataFrame(items, ITEMS), shard_chars=chars)
    assert kept.schema == frame.schema
    clean = [i for i, _, hits, _ in brute(texts, items) if not hits]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_empty_tables(spark, docs):
    texts, items = corpus()
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(docs([]), spark.createDataFrame(items, ITEMS)).count() == 0
    assert all(not r.hits for r in decontaminate.contamination(docs(texts), none).collect())
    assert decontaminate.keep_clean(docs(texts), none).count() == len(texts)
