"""Repeated passages against a window-by-window reading."""

import random

import numpy as np
import pyarrow as pa
import pytest
from fleetledger.llm import substrings
from pyspark.sql import functions as F


def brute(rows, size=13):
    own = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in own:
        key = float("inf") if i is None else i
        for k in range(len(words) - size + 1):
            window = tuple(words[k:k + size])
            least[window] = min(least.get(window, key), key)
    found = []
    for i, words in own:
        key = float("inf") if i is None else i
        gone = {j for k in range(len(words) - size + 1) if least[tuple(words[k:k + size])] < key for j in range(k, k + size)}
        found.append((str(i), len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(found)


def got(frame, **options):
    return sorted((str(r.id), r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(frame, **options).collect())


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 5))) for _ in range(60)]
    passages = [rng.choices(vocabulary, k=k) for k in (12, 13, 14, 30, 60)]
    rows = []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        rows.append((rng.randint(0, 10 ** 6) - 500, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize("frequent", [200_000, 0])
def test_equal_to_brute_force_with_short_and_long_prefixes(spark, docs, monkeypatch, frequent):
    monkeypatch.setattr(substrings, "GROUP_SUFFIXES", frequent)
    rows = corpus()
    want = brute(rows)
    assert got(docs(rows)) == want and sum(g for _, _, g, _ in want) > 100


def test_copies_ties_repeats_inside_and_nulls(spark, docs):
    rng = random.Random(9)
    text = " ".join(rng.choices("abcdefghijklmnop", k=40))
    rows = [(5, text), (3, text), (3, text), (9, text + " end"), (None, text), (None, text), (11, None), (12, ""), (13, " \t\n"),
            (14, "only twelve words are in this text which is not long enough"), (15, "w " * 50), (16, "w " * 30), (20, f"x {text} y {text}")]
    assert got(docs(rows)) == brute(rows)


def test_other_lengths_and_long_texts(spark, docs):
    rows = [(1, "a b c d"), (2, "x a b c y"), (3, "b c d"), (4, "word " * 100_000), (5, "other " + "word " * 50_000)]
    assert got(docs(rows), min_words=3) == brute(rows, 3)


def test_empty_tables_and_clashing_columns(spark, docs):
    assert got(docs([])) == []
    rows = corpus(5, 20)
    assert got(docs(rows).withColumns({"block": F.lit("mine"), "kept": F.lit(1), "part": F.lit(2)})) == brute(rows)


def test_sorted_suffixes_are_sorted_and_share_what_they_say():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 3, 500)
    at = np.arange(490)
    order, shared = substrings.sorted_suffixes(ids, at, 10)
    suffixes = [tuple(ids[a:a + 10]) for a in at[order]]
    assert suffixes == sorted(suffixes)
    for k in range(1, len(order)):
        equal = next((n for n in range(10) if suffixes[k][n] != suffixes[k - 1][n]), 10)
        assert shared[k] == equal


def test_long_words_of_one_hash_are_told_apart(spark, docs):
    tail = " ".join(f"w{k}" for k in range(12))
    rng = random.Random(1)
    pairs = []
    for k in range(40):  # words of 4,096 letters that differ everywhere hash alike now and then
        letters = rng.choices("abcdefghijklmnopqrstuvwxyz", k=4_096)
        pairs += [(2 * k, "".join(letters) + f" {k} " + tail), (2 * k + 1, "".join(chr(219 - ord(c)) for c in letters) + f" {k} " + tail)]
    assert got(docs(pairs)) == brute(pairs)


def test_openings_of_one_hash_are_told_apart():
    ids = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3, 5, 5, 5])
    at = np.array([0, 3, 6, 9])
    for hashes in (np.array([7, 7, 7, 8], np.uint64), np.array([7, 7, 7, 7], np.uint64)):
        a, b, c, d = substrings.exact_classes(hashes, ids, at, 3).tolist()
        assert a == c and len({a, b, d}) == 3


def test_a_weak_hash_changes_nothing(spark, docs, monkeypatch):
    rows = corpus(8, 30)
    weak = substrings.Openings

    class Weak(weak):
        def __init__(self, *args):
            super().__init__(*args)
            self.whole = self.whole % np.uint64(7)

    ids = np.array([i for i, _ in rows])
    monkeypatch.setattr(substrings, "Openings", Weak)
    table = pa.table({"id": pa.array(ids, pa.int64()), "text": [t for _, t in rows], "block": np.zeros(len(rows), np.int64)})
    none = pa.table({"places": pa.array([], pa.binary()), "least": pa.array([], pa.binary())})
    found = substrings._remove(table, none, 13)
    assert sorted((str(i), n, g, k) for i, n, g, k in zip(*(found[c].to_pylist() for c in found.column_names))) == brute(rows)


def brute_repeats(rows, size):
    """Every repeat that any word added before or behind would split."""
    places, end = {}, 0
    for i, text in rows:
        words = (text or "").split()
        for a in range(len(words)):
            for b in range(a + size, len(words) + 1):
                end += 2
                left = words[a - 1] if a else end
                right = words[b] if b < len(words) else end + 1
                places.setdefault(tuple(words[a:b]), []).append((left, right, i))
    return sorted((" ".join(w), len(w), len(p), min(i for _, _, i in p)) for w, p in places.items()
                  if len(p) > 1 and len({x for x, _, _ in p}) > 1 and len({x for _, x, _ in p}) > 1)


@pytest.mark.parametrize("large", [200_000, 0])
@pytest.mark.parametrize("seed", range(3))
def test_maximal_repeats_equal_brute_force(spark, docs, monkeypatch, seed, large):
    monkeypatch.setattr(substrings, "GROUP_SUFFIXES", large)
    rng = random.Random(seed)
    words = [f"v{k}" for k in range(3)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(25)))) for k in range(30)]
    rows += [(40, rows[3][1]), (41, rows[3][1]), (42, "x " + rows[5][1] + " y"), (43, "v1 " * 20), (44, "v1 " * 20), (45, None)]
    found = substrings.maximal_repeats(docs(rows), 6).collect()
    assert sorted((r.text, r.n_words, r.occurrences, r.least_id) for r in found) == brute_repeats(rows, 6)
    assert not any(r.longer for r in found) and found


def test_long_repeats_are_marked(spark, docs):
    long = " ".join(f"w{k}" for k in range(100))
    rows = [(1, "a " + long), (2, "b " + long + " c"), (3, None)]
    found = substrings.maximal_repeats(docs(rows), deep=20).collect()
    assert [(r.n_words, r.occurrences, r.least_id, r.longer) for r in found if r.text.startswith("w0 ")] == [(20, 2, 1, True)]
    assert substrings.maximal_repeats(docs([])).count() == 0
    exact = substrings.maximal_repeats(docs(rows), deep=200).collect()
    assert [(r.text, r.longer) for r in exact] == [(long, False)]


def test_inner_nodes_cover_their_leaves():
    shared = np.array([0, 3, 5, 5, 2, 0, 4])
    assert sorted(substrings.inner_nodes(shared, 3)) == [(3, 0, 3), (4, 5, 6), (5, 1, 3)]
