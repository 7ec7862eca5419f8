"""SimHash near copies against all pairs by brute force."""

import random

import numpy as np
import pytest
import xxhash
from fleetledger.llm import simhash
from fleetledger.llm.components import components
from pyspark.sql import functions as F


def print_of(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, bits=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(prints))]


def texts():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    found = [None, "", " \t\n", "One", "one", "a b", "Ünï cödé wörds", "x " * 30_000]
    for _ in range(30):
        words = rng.choices(vocabulary, k=rng.randint(30, 400))
        found.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            found.append(" ".join(near))
    return found


def test_fingerprints_and_components_equal_brute_force(spark, docs):
    rows = list(enumerate(texts()))
    got = {r.id: r for r in simhash.near_copies(docs(rows)).collect()}
    prints = [print_of(t) for _, t in rows]
    assert len(set(groups_of(prints))) < len(set(prints))  # there are links to find
    for (i, _), value, root in zip(rows, prints, groups_of(prints)):
        assert got[i].fingerprint % 2 ** 64 == value
        assert got[i].component == root


@pytest.mark.parametrize("bucket", [1, 5, 4_096])
def test_links_do_not_depend_on_the_size_of_a_bucket(spark, bucket):
    rng = random.Random(5)
    centre = [rng.getrandbits(64) for _ in range(6)]
    prints = {c for c in centre}
    for c in centre:
        for _ in range(40):
            x = c
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {0, 2 ** 64 - 1, 7, 15}
    prints = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fingerprint long")
    found = components(simhash.links(frame, bucket=bucket)).collect()
    mine = {r.node % 2 ** 64: r.root for r in found}
    want = groups_of(prints)
    for a in range(len(prints)):
        for b in range(a):
            together = want[a] == want[b]
            assert together == (mine.get(prints[a], prints[a]) == mine.get(prints[b], prints[b]))


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901), (901, 900), (5, 5), (None, 1)], "u long, v long")
    roots = {r.node: r.root for r in components(links).collect()}
    assert {roots[k] for k in range(301)} == {0} and roots[901] == 900


def test_null_ids_repeated_rows_and_empty_tables(spark, docs):
    rows = [(3, "same words here now"), (None, "same words here now"), (3, "same words here now"), (None, None), (8, "")]
    got = sorted((r.id is None, r.id, r.component) for r in simhash.near_copies(docs(rows)).collect() if r.id is not None)
    assert got == [(False, 3, 3), (False, 3, 3), (False, 8, 8)]
    assert simhash.near_copies(docs(rows)).count() == 5
    assert simhash.near_copies(docs([])).count() == 0
    only = docs([(None, "lonely words of nobody")])
    assert [r.component for r in simhash.near_copies(only).collect()] == [None]


def test_one_row_of_each_group_stays_with_all_its_columns(spark, docs):
    rows = [(5, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (9, "other words in this one"), (None, "nobody has this text"), (None, None)]
    frame = docs(rows).withColumns({"text_key": F.lit("mine"), "component": F.lit(1), "root": F.lit(2)})
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(2, "a b c d e"), (9, "other words in this one"), (None, "nobody has this text"), (None, None)], key=str)
    assert simhash.keep_one(docs([])).count() == 0
