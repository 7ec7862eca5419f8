"""SentencePiece pieces by Viterbi over sorted words, with forward scores shared by prefix.

A text is marked (a space becomes U+2581, one more stands in front) and cut before
every mark that follows another character, as no piece goes over such a place. The
distinct marked words of a batch are sorted, which is a depth-first walk of their trie:
of each word only the part beyond its common prefix with the word before is scored,
the scores of the prefix are kept. Best paths maximise the sum of the model's piece scores;
of equal ones that with the longer last piece is taken, place by place. What no piece
covers is spelled in byte pieces, or is the unknown piece where the model has none.

Encoded words are kept from batch to batch in two generations of at most
``KEPT_WORDS``, so memory is bounded whatever the number of distinct words.

The model file's pieces and scores are used as they are; nothing is trained.

Defined cases: null and empty texts have no pieces; a U+2581 in a text can't be told
from a space and decodes to one. Everything else decodes to itself. Repeated rows
each get a row.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import bounded_batches, texts, unused

MARK = "▁"
KEPT_WORDS = 500_000
KEPT_CHARS = 64
# Fixed value: an unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """A model's pieces; its size is that of the model file."""

    pieces: dict[str, tuple[float, int]]  # score and id of what may stand in a path
    spelling: list[bytes]  # what each id decodes to
    byte_ids: tuple[int, ...]  # of the 256 bytes, or none
    unknown: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, spelling, byte_ids = {}, [], {}
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            spelling.append(b"" if model.is_control(k) else piece.replace(MARK, " ").encode())
            if model.is_byte(k):
                value = int(piece[3:5], 16)
                byte_ids[value], spelling[k] = k, bytes([value])
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                pieces[piece] = model.get_score(k), k
        unknown = model.unk_id()
        spelling[unknown] = " ⁇ ".encode()
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece goes over a word boundary")
        return Vocabulary(pieces, spelling, tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (), unknown)


def marked_words(text: str) -> list[str]:
    """The words of the marked text, without each one's first mark."""
    words = text.replace(MARK, " ").split(" ")
    if "" not in words:
        return words
    if not text:
        return []
    out, marks = [], ""
    for word in words:
        if word:
            out.append(marks + word)
            marks = ""
        else:
            marks += MARK
    return out + [marks[:-1]] if marks else out


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.scores = {piece: score for piece, (score, _) in vocabulary.pieces.items()}
        self.unknown_score = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        ending: dict[str, set[int]] = {}
        for piece in self.scores:
            if len(piece) > 2:
                ending.setdefault(piece[-3:], set()).add(len(piece))
        # By the last three characters: lengths of the pieces that end in them, longest first.
        self.lengths = {end: tuple(sorted(found, reverse=True)) for end, found in ending.items()}

    def words(self, distinct: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of each of these words, which must be sorted."""
        score_of, lengths_of, unknown = self.scores.get, self.lengths.get, self.unknown_score
        best, start = [0.0], [0]
        before, none = "", ()
        for word in distinct:
            marked = MARK + word
            shared, most = 0, min(len(before), len(marked))
            while shared < most and before[shared] == marked[shared]:
                shared += 1
            del best[shared + 1:], start[shared + 1:]
            for end in range(shared + 1, len(marked) + 1):
                top, place = -np.inf, end - 1
                if end > 2:
                    for length in lengths_of(marked[end - 3:end], none):
                        if length <= end and (score := score_of(marked[end - length:end])) is not None:
                            score += best[end - length]
                            if score > top:
                                top, place = score, end - length
                if end > 1 and (score := score_of(marked[end - 2:end])) is not None:
                    score += best[end - 2]
                    if score > top:
                        top, place = score, end - 2
                score = best[end - 1] + score_of(marked[end - 1], unknown)
                if score > top:
                    top, place = score, end - 1
                best.append(top)
                start.append(place)
            yield word, self._path(marked, start)
            before = marked

    def _path(self, marked: str, start: list[int]) -> bytes:
        pieces, byte_ids = self.vocabulary.pieces, self.vocabulary.byte_ids
        ids, end = [], len(marked)
        while end:
            piece = marked[start[end]:end]
            if piece in pieces:
                ids.append(pieces[piece][1])
            elif byte_ids:
                ids.extend(byte_ids[b] for b in reversed(piece.encode()))
            else:
                ids.append(self.vocabulary.unknown)
            end = start[end]
        ids.reverse()
        return array("i", ids).tobytes()

    def encode(self, batch: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit integers."""
        words = [marked_words(t) for t in batch]
        distinct = set().union(*words)
        if len(self.young) > KEPT_WORDS:
            self.old, self.young = self.young, {}
        for word in distinct & self.old.keys():
            self.young.setdefault(word, self.old[word])
        self.young.update(self.words(sorted(distinct - self.young.keys())))
        found = [b"".join(map(self.young.__getitem__, own)) for own in words]
        for word in distinct:
            if len(word) > KEPT_CHARS:
                del self.young[word]
        return found


def decode(ids: np.ndarray, spelling: list[bytes]) -> str:
    """The text of these ids."""
    joined = b"".join(map(spelling.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return joined.removeprefix(" ")


def _mapped(docs: DataFrame, vocabulary: Vocabulary, rows: Callable, schema: T.StructType | str) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)  # travels with the task; as large as the model file
        for batch in batches:
            yield rows(batch, encoder)

    return docs.mapInArrow(task, schema)


def _lists(encoded: list[bytes]) -> pa.ListArray:
    first = np.concatenate([[0], np.cumsum([len(e) // 4 for e in encoded])])
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text column in place of it (named ``ids_col``, or longer if that is taken)."""
    at = docs.columns.index(text_col)
    name = unused(docs.drop(text_col), ids_col)
    schema = T.StructType([*docs.drop(text_col).schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])

    def rows(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        ids = _lists(encoder.encode(texts(batch.column(at))))
        columns = [c for k, c in enumerate(batch.columns) if k != at]
        return pa.RecordBatch.from_arrays([*columns, ids], names=[*(n for k, n in enumerate(batch.schema.names) if k != at), name])

    return _mapped(docs, vocabulary, rows, schema)


def decoded(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with the text of the ids in place of them; null ids are the empty text."""
    at = docs.columns.index(ids_col)
    name = unused(docs.drop(ids_col), text_col)
    schema = T.StructType([*docs.drop(ids_col).schema.fields, T.StructField(name, T.StringType())])

    def rows(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        text = [decode(np.array(ids or [], np.int64), encoder.vocabulary.spelling) for ids in batch.column(at).to_pylist()]
        columns = [c for k, c in enumerate(batch.columns) if k != at]
        return pa.RecordBatch.from_arrays([*columns, pa.array(text, pa.string())],
                                          names=[*(n for k, n in enumerate(batch.schema.names) if k != at), name])

    return _mapped(docs, vocabulary, rows, schema)


def round_trips(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, ids_crc32, n_bytes, same) of every row: its encoding in short, and whether that decodes to the text.

    ``ids_crc32`` is over the ids as little-endian 32-bit integers, ``n_bytes`` counts byte pieces.
    """
    def rows(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        text, spelling = texts(batch.column(1)), encoder.vocabulary.spelling
        ids = [np.frombuffer(e, np.int32) for e in encoder.encode(text)]
        spelled = np.zeros(len(spelling), bool)
        spelled[list(encoder.vocabulary.byte_ids)] = True
        same = [decode(i, spelling) == t.replace(MARK, " ") for i, t in zip(ids, text)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(i) for i in ids], pa.int64()),
             pa.array([zlib.crc32(i.astype("<i4").tobytes()) for i in ids], pa.int64()),
             pa.array([int(spelled[i].sum()) for i in ids], pa.int64()), pa.array(same, pa.bool_())],
            names=["id", "n_pieces", "ids_crc32", "n_bytes", "same"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return _mapped(plain, vocabulary, rows, "id long, n_pieces long, ids_crc32 long, n_bytes long, same boolean")
