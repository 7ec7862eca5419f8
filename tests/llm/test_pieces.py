"""Shared-prefix Viterbi against a plain one, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from fleetledger.llm import pieces
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(PATH)


def brute(vocabulary, text):
    """Plain Viterbi over the whole marked text, without words, trie or cache."""
    text = text or ""
    if not text:
        return []
    marked = pieces.MARK + text.replace(" ", pieces.MARK)
    longest = max(map(len, vocabulary.pieces))
    unknown = min(s for s, _ in vocabulary.pieces.values()) - pieces.UNKNOWN_PENALTY
    best = [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            if (found := vocabulary.pieces.get(marked[start:end])) is not None:
                options.append((best[start][0] + found[0], -start))
            elif end - start == 1:
                options.append((best[start][0] + unknown, -start))
        score, start = max(options)
        best.append((score, -start))
    ids, end = [], len(marked)
    while end:
        start = best[end][1]
        piece = marked[start:end]
        ids = ([vocabulary.pieces[piece][1]] if piece in vocabulary.pieces else [vocabulary.byte_ids[b] for b in piece.encode()]) + ids
        end = start
    return ids


ODD = ["", " ", "  a  b ", "▁x", "日本語 テスト 🎉\n\t x", "\x00\x01 é", "a   ", "word " * 40, "ab" * 100, "A.B.C, d-e_f"]


def encoded(vocabulary, texts):
    return [np.frombuffer(e, np.int32).tolist() for e in pieces.Encoder(vocabulary).encode(texts)]


def test_paths_equal_plain_viterbi(vocabulary):
    rng = random.Random(4)
    texts = ODD + [" ".join("".join(rng.choices("abcdeinorst.,", k=rng.randint(1, 9))) for _ in range(25)) for _ in range(60)]
    assert encoded(vocabulary, texts) == [brute(vocabulary, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_any_text_comes_back(text):
    vocabulary = pieces.Vocabulary.load(PATH) if not hasattr(test_any_text_comes_back, "v") else test_any_text_comes_back.v
    test_any_text_comes_back.v = vocabulary
    ids = encoded(vocabulary, [text])[0]
    assert ids == brute(vocabulary, text)
    assert pieces.decode(np.array(ids, np.int64), vocabulary.spelling) == text.replace(pieces.MARK, " ")


def test_the_library_decodes_the_ids_to_the_same_text(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for ids, text in zip(encoded(vocabulary, ODD), ODD):
        assert model.decode(ids) == text.replace(pieces.MARK, " ")


def test_the_cache_is_bounded_and_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 20)
    rng = random.Random(6)
    encoder = pieces.Encoder(vocabulary)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abc", k=3)) for _ in range(15)) for _ in range(3)] + ["long" * 50]
        got = [np.frombuffer(e, np.int32).tolist() for e in encoder.encode(texts)]
        assert got == [brute(vocabulary, t) for t in texts]
        assert len(encoder.young) <= 20 + 46 and not any(len(w) > pieces.KEPT_CHARS for w in encoder.young)


def test_a_model_without_byte_pieces_uses_the_unknown_piece():
    vocabulary = pieces.Vocabulary({"▁": (-3.0, 1), "a": (-1.0, 2), "▁a": (-1.5, 3)}, [b" ? ", b" ", b"a", b" a"], (), 0)
    assert encoded(vocabulary, ["a z"]) == [[3, 1, 0]]


def test_equal_sums_take_the_longer_last_piece():
    vocabulary = pieces.Vocabulary({"▁": (0.0, 0), "a": (-1.0, 1), "b": (-1.0, 2), "ab": (-2.0, 3), "▁a": (-1.0, 4)}, [b""] * 5, (), 0)
    assert encoded(vocabulary, ["ab"]) == [[0, 3]]


def test_tables(spark, docs, vocabulary):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, None), (None, "x"), (0, ""), (60, "long words here " * 20_000)]
    frame = docs(rows).withColumns({"ids": F.lit("mine"), "n": F.lit(1)})
    out = pieces.encode(frame, vocabulary)
    assert out.columns == ["doc_id", "ids", "n", "ids_"] and out.count() == len(rows)
    short = {r.doc_id: r.ids_ for r in out.filter("doc_id < 50").collect()}
    assert all(short[k] == brute(vocabulary, t) for k, t in enumerate(ODD))
    back = pieces.decoded(out.drop("ids").withColumnRenamed("ids_", "ids"), vocabulary)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), (t or "").replace("▁", " ")) for i, t in rows)
    trips = pieces.round_trips(frame, vocabulary).collect()
    assert len(trips) == len(rows) and all(r.same for r in trips)
    assert pieces.encode(docs([]), vocabulary).count() == 0
