"""Token ids in files of fixed-width bit packing, with random access.

Every id takes the fewest bits that hold the vocabulary. Sixty-four ids fill as many
64-bit words as an id has bits, so packing and unpacking are a shift and an or per
column of a numpy table. A file holds consecutive documents; its tail lists each
document's id and length and the place of each block of ``BLOCK`` ids, so a reader can
fetch the blocks of one document alone.

Documents are dealt to files by ranges of their id, so file order is id order; a task
writes its file under a passing name and renames it, so a task that is run again leaves the
same file. Only the list of files meets on the driver.

Layout, little-endian: magic, bits, blocks of packed ids, then per document id (null
as least long) and number of ids, then per block its offset, then the numbers of documents,
blocks and ids and the offset of the tail.

Defined cases: null and empty texts have the end id alone; a null document id sorts
first. Repeated ids are written one after the other, by text. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import pin, scratch
from .frames import IS_SPACE, LOWER, UPPER, Words, bounded_batches, byte_class, groups, kept_by_worker, partitions_for, shuffle_partitions, utf8

MAGIC = b"PKIDS\x01"
BLOCK = 1 << 16
# Texts are encoded by groups of so many bytes, so that a word is looked up once for many places.
GROUP_BYTES = 8 << 20
GROUP = 64
# An encoder keeps the words of up to two spans of so many distinct ones (or so many ids), but no longer words.
KEPT_WORDS = 400_000
KEPT_IDS = 8_000_000
KEPT_BYTES = 64
JOINED_WORDS = 1_000
NO_ID = -2 ** 63


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` each, filled up with zeros to a whole group."""
    table = np.zeros((-(-len(ids) // GROUP), GROUP), np.uint64)
    table.reshape(-1)[:len(ids)] = ids
    words = np.zeros((len(table), bits), np.uint64)
    for k in range(GROUP):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= table[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= table[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of what ``pack`` made."""
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    table = np.empty((len(words), GROUP), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for k in range(GROUP):
        word, shift = divmod(k * bits, 64)
        column = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            column = column | (words[:, word + 1] << np.uint64(64 - shift))
        table[:, k] = column & mask
    return table.reshape(-1)[:count]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Writer:
    """One file; ids are packed as soon as a block is full."""

    def __init__(self, path: str, bits: int):
        self.files, self.path = _opened(path)
        self.files.create_dir(os.path.dirname(self.path), recursive=True)
        self.passing = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.passing)
        self.bits, self.held, self.waiting = bits, [], 0
        self.docs: list[np.ndarray] = []
        self.n_docs = 0
        self.offsets: list[int] = []
        self.ids = 0
        self.out.write(MAGIC + bytes([bits]))

    def add(self, docs: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents (``NO_ID`` for null), their numbers of ids, and all ids one after the other."""
        self.docs.append(np.stack([docs, lengths], axis=1).astype("<i8"))
        self.n_docs += len(docs)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        for a in range(0, upto, BLOCK):
            self.offsets.append(self.out.tell())
            self.out.write(pack(ids[a:min(upto, a + BLOCK)], self.bits))
        self.ids += upto
        self.held, self.waiting = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._flush(self.waiting)
        tail = self.out.tell()
        for listed in self.docs:
            self.out.write(listed.tobytes())
        self.out.write(np.array(self.offsets, "<i8").tobytes())
        self.out.write(np.array([self.n_docs, len(self.offsets), self.ids, tail], "<i8").tobytes())
        self.out.close()
        if self.files.get_file_info(self.path).type != fs.FileType.NotFound:
            self.files.delete_file(self.path)  # an earlier run of this task; the content is the same
        self.files.move(self.passing, self.path)


class Reader:
    """A file's documents, in order or one by one."""

    def __init__(self, path: str):
        files, place = _opened(path)
        self.file = files.open_input_file(place)
        size = self.file.size()
        docs, blocks, self.ids, tail = np.frombuffer(self.file.read_at(32, size - 32), "<i8").tolist()
        head = self.file.read_at(len(MAGIC) + 1, 0)
        if head[:-1] != MAGIC:
            raise ValueError(f"{path} is no file of packed ids")
        self.bits = head[-1]
        listed = np.frombuffer(self.file.read_at(16 * docs, tail), "<i8").reshape(-1, 2)
        self.docs, self.lengths = listed[:, 0], listed[:, 1]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.offsets = np.append(np.frombuffer(self.file.read_at(8 * blocks, tail + 16 * docs), "<i8"), tail)

    def block(self, k: int) -> np.ndarray:
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        return unpack(self.file.read_at(b - a, a), self.bits, min(BLOCK, self.ids - k * BLOCK))

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's document number ``k``; reads only the blocks it is in."""
        start, end = int(self.starts[k]), int(self.starts[k] + self.lengths[k])
        first = start // BLOCK
        found = [self.block(n) for n in range(first, -(-end // BLOCK))]
        return np.concatenate(found)[start - first * BLOCK:end - first * BLOCK] if found else np.empty(0, np.uint64)

    def documents(self) -> Iterator[np.ndarray]:
        held, at, k = np.empty(0, np.uint64), 0, 0  # ids from number ``at`` on, up to block ``k``
        for start, length in zip(self.starts.tolist(), self.lengths.tolist()):
            parts = [held[start - at:]]
            have = len(parts[0])
            while have < length:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            held, at = np.concatenate(parts) if len(parts) > 1 else parts[0], start
            yield held[:length]


def splits_at_spaces(tokenizer: str) -> bool:
    """Whether a tokenizer drops white space, so that each word's ids don't depend on its neighbours."""
    spec = json.loads(tokenizer)
    parts = spec.get("pre_tokenizer") or {}
    first = (parts.get("pretokenizers") or [parts])[0]
    # A split that keeps only its matches drops white space if no part of its pattern can match any.
    kept = (first.get("pattern") or {}).get("Regex", r"\s")
    dropped = first.get("type") in ("Whitespace", "WhitespaceSplit") or (
        first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
        and not re.search(r"\\s|\.|\[\^| ", kept.replace(r"[^\s", "")))
    rules = spec.get("normalizer") or {}
    local = all(r.get("type") in ("NFC", "Lowercase") or (r.get("type") == "Replace" and r.get("pattern") == {"Regex": "\\s+"})
                for r in rules.get("normalizers", [rules] if rules else []))
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
                    for t in spec.get("added_tokens", []))
    return bool(dropped and local and plain and not spec.get("truncation") and not spec.get("padding"))


class Met:
    """Words met so far: the place of each one's ids in one flat array."""

    def __init__(self):
        self.slots: dict[bytes, int] = {}
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.words = self.used = 0

    def add(self, words: list[bytes], ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Keep these words' ids, given one after the other; returns their slots."""
        slots = np.arange(self.words, self.words + len(words))
        self.first, self.count = _roomy(self.first, self.words + len(words)), _roomy(self.count, self.words + len(words))
        self.ids = _roomy(self.ids, self.used + len(ids))
        self.first[slots], self.count[slots] = self.used + np.cumsum(count) - count, count
        self.ids[self.used:self.used + len(ids)] = ids
        self.slots.update(zip(words, slots.tolist()))
        self.words, self.used = self.words + len(words), self.used + len(ids)
        return slots

    def find(self, words: list[bytes]) -> np.ndarray:
        """The words' slots, -1 for one not met."""
        return np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))

    def spelled(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these slots, one after the other, and how many each has."""
        count = self.count[slots]
        ends = np.cumsum(count)
        at = np.repeat(self.first[slots] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.ids[at], count


def _roomy(held: np.ndarray, size: int) -> np.ndarray:
    """``held`` with room for so many values."""
    if size <= len(held):
        return held
    grown = np.zeros(max(size, 2 * len(held)), held.dtype)
    grown[:len(held)] = held
    return grown


class Encoder:
    """Ids of whole texts. Where words are independent, only distinct ones not met before are encoded."""

    # Fixed value: the split of the given tokenizer, which parts marks from the letters and digits before them.
    PARTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _MARKS = byte_class(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")
    _LETTERS = byte_class(b"0123456789" + UPPER + LOWER)

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer)
        spec = json.loads(tokenizer)
        self.word_wise = splits_at_spaces(tokenizer)
        self.young, self.old = Met(), Met()
        rules = spec.get("normalizer") or {}
        parts = spec.get("pre_tokenizer") or {}
        first = (parts.get("pretokenizers") or [parts])[0]
        self.parts_marks = (first.get("pattern") or {}).get("Regex") == self.PARTING
        # A word with the first character of an added token is taken as it is, since it may hold that token.
        starts = b"".join(t["content"][:1].encode() for t in spec.get("added_tokens", []))
        self.kept_bytes = byte_class(starts + b"'")
        lowers = any(r.get("type") == "Lowercase" for r in rules.get("normalizers", [rules]))
        self.lowered = np.arange(256, dtype=np.uint8)
        if lowers:
            self.lowered[np.frombuffer(UPPER, np.uint8)] = np.frombuffer(LOWER, np.uint8)

    def _pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Words, marks at their ends apart where the tokenizer parts them; and for each row its first piece (one more than rows).

        Words end at white space of ASCII; further kinds stay inside a word.
        """
        words = Words(raw, offsets)
        inner = ~IS_SPACE[raw]
        plain = raw[inner]
        ends = np.cumsum(words.ends - words.starts)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        special = np.zeros(len(starts), bool)
        found = np.flatnonzero(self.kept_bytes[plain])
        special[np.searchsorted(ends, found, side="right")] = True
        kept = np.repeat(special, ends - starts)
        plain = np.where(kept, plain, self.lowered[plain])
        first = np.zeros(len(plain) + 1, bool)
        first[starts] = True
        if self.parts_marks and len(plain):
            last = np.maximum.accumulate(np.where(self._MARKS[plain], -1, np.arange(len(plain))))[ends - 1]
            cut = (last >= starts) & (last + 1 < ends) & ~special
            at = last[cut]
            letter = self._LETTERS[plain[at]]
            # A letter of U+00C0 to U+00FF; its two other signs are no letters.
            latin = (plain[np.maximum(at - 1, 0)] == 0xC3) & (plain[at] >= 0x80) & (plain[at] != 0x97) & (plain[at] != 0xB7) & (at > starts[cut])
            first[at[letter | latin] + 1] = True
        begin = np.flatnonzero(first)
        bounds = np.append(begin, len(plain)).astype(np.int32)
        column = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(plain))])
        return column, np.searchsorted(begin, np.append(starts, len(plain))[words.first])

    def _fresh(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that were not met before, and how many each has."""
        ids, count = [np.empty(0, np.uint32)], np.zeros(len(words), np.int64)
        for k in range(0, len(words), JOINED_WORDS):
            some = [w.decode() for w in words[k:k + JOINED_WORDS]]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            np.add.at(count, k + np.array(found.word_ids, np.int64), 1)
        return np.concatenate(ids), count

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if not self.word_wise:
            data = raw.tobytes()
            found = self.tokenizer.encode_batch_fast([data[a:b].decode() for a, b in zip(offsets, offsets[1:])], add_special_tokens=False)
            own = [np.array(e.ids, np.uint32) for e in found]
            return np.concatenate([np.empty(0, np.uint32), *own]), np.array([len(x) for x in own], np.int64)
        if len(self.young.slots) > KEPT_WORDS or self.young.used > KEPT_IDS:
            self.old, self.young = self.young, Met()
        column, first = self._pieces(raw, offsets)
        coded = column.dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        slots = self.young.find(words)
        lacking = np.flatnonzero(slots < 0)
        if len(lacking):
            unseen = [words[k] for k in lacking.tolist()]
            known = self.old.find(unseen)
            for some, (ids, count) in ((np.flatnonzero(known >= 0), self.old.spelled(known[known >= 0])),
                                       (new := np.flatnonzero(known < 0), self._fresh([unseen[k] for k in new.tolist()]))):
                slots[lacking[some]] = self.young.add([unseen[k] for k in some.tolist()], ids, count)
            for word in unseen:
                if len(word) > KEPT_BYTES:
                    del self.young.slots[word]
        ids, count = self.young.spelled(slots[codes])
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(total[first])


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, files: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write ``docs`` in order of their id; returns the list of files.

    The list is (part, path, n_docs, n_ids, start), one row per file; ``start`` counts the ids
    of all files before. ``tokenizer`` is the JSON of a tokenizer, ``folder`` a place that all executors share.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "ids")
    bits = bits_for(max(Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1))
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer = TaskContext.get().partitionId(), None
        encoder = kept_by_worker("packed", tokenizer, lambda: Encoder(tokenizer))
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            docs = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            writer = writer or Writer(f"{folder}/part-{part:06d}.ids", bits)
            for a, b in groups(offsets, GROUP_BYTES):
                ids, count = encoder.encode(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                writer.add(docs[a:b], count + 1, np.insert(ids, np.cumsum(count), np.uint32(end_id)))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/part-{part:06d}.ids"],
                                              "n_docs": [writer.n_docs], "n_ids": [writer.ids]})

    bounded_batches(spark)
    # Equal ids are told apart by text, and equal rows by where they were read, so that no range is one key.
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(text_col).alias("text_key"), F.monotonically_increasing_id().alias("at"))
    order = ["id", "text_key", "at"]
    listed = pin(keyed.repartitionByRange(files or partitions_for(docs), *order).sortWithinPartitions(*order)
                 .select("id", "text").mapInArrow(task, "part long, path string, n_docs long, n_ids long"))
    rows = sorted(listed.collect())  # one row per file
    starts = np.cumsum([0, *(r.n_ids for r in rows)]).tolist()
    return spark.createDataFrame([(*r, s) for r, s in zip(rows, starts)],
                                 "part long, path string, n_docs long, n_ids long, start long")


def read(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of these files, from the files alone."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = Reader(path)
                crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in reader.documents()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.docs, pa.int64(), mask=reader.docs == NO_ID), pa.array(reader.starts + start),
                     pa.array(reader.lengths), pa.array(crc, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    spread = listed.select("path", "start").repartition(max(1, shuffle_partitions(spark)))
    return spread.mapInArrow(task, "id long, start long, n_tokens long, ids_crc32 long")
