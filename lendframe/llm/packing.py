"""Packing of tokenised documents into sequences: bounded-space, online, best fit.

Each input partition keeps a fixed number of open windows. A document's full windows leave at once; its rest goes to the open
window with the least room that still holds it. If none does, the fullest window is topped up with the head of the rest and
emitted, so that a sequence is padded only where the data end. What is open at the end of a partition is merged there, and the
one unfinished sequence of each partition is merged with those of up to `FAN` others, level by level, until one is left.

Null and empty texts are the end id alone. Repeated rows are packed once each. Extra columns are ignored.
An empty table gives an empty result. Memory: the open windows, one batch and a bounded cache of words per task; a text is
tokenised by itself whatever its length.
"""

from __future__ import annotations

import re
import struct
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import give_back, staged, table

CAPACITY = 2048
OPEN_WINDOWS = 64
END_ID = 1
#: Unfinished sequences that one task of the final merge takes.
FAN = 512
#: Pieces a task hands on at once, 8 kB of ids each at most.
BATCH = 500
#: Words a task keeps with their ids, and the bytes of the longest.
CACHE = 200_000
LONGEST = 40
OUT = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64())]
)
DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, part long"
#: Words whose ids the model alone gives: precomposed Latin letters, then other ASCII signs. All others take the whole tokenizer.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, equal to those of `Tokenizer.encode(text, add_special_tokens=False)`.

    For a vocabulary that drops white space, a text's ids are those of its words, so each word is encoded once and kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words: dict[bytes, bytes] = {}
        # the byte alphabet of byte-level BPE: printable Latin-1 stands for itself, the others follow from 256
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in kept]
        self.letters = {b: 256 + i for i, b in enumerate(others)}

    def _ids(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        found = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(found)}I", *found)

    def _piece(self, piece: str) -> bytes:
        key = piece.encode()
        ids = self.words.get(key)
        if ids is None:
            ids = self._ids(piece)
            if len(key) <= LONGEST:
                self.words[key] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters alone
            return self._ids(word.lower().decode())
        text = word.decode("utf-8")
        if m := SIMPLE.fullmatch(text):
            return self._piece(m[1].lower()) + (self._piece(m[2]) if m[2] else b"")
        found = self.whole.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def __call__(self, text: str) -> bytes:
        data = text.encode("utf-8")
        # the tokenizer lowers all letters: A-Z can be lowered first, where no special token and no mark that joins a letter (U+0300 to U+037F) is near
        if b"<|" not in data and b"\xcc" not in data and b"\xcd" not in data:
            data = data.lower()
        words, known = data.split(), self.words
        out = list(map(known.get, words))
        try:
            return b"".join(out)
        except TypeError:  # a word that is not known yet
            pass
        if len(known) >= CACHE:
            known.clear()
        for i, ids in enumerate(out):
            if ids is None:
                word = words[i]
                ids = known.get(word)
                if ids is None:
                    ids = self._word(word)
                    if len(word) <= LONGEST:
                        known[word] = ids
                out[i] = ids
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Windows:
    """Open windows of one task, and the pieces it has emitted."""

    def __init__(self, capacity: int, most: int, first_id: int, part: int):
        self.capacity, self.most, self.next_id, self.part = capacity, most, first_id, part
        self.open: list[tuple[int, int]] = []  # room and slot, by room
        self.pieces: dict[int, list[tuple]] = {}
        self.slots = iter(range(1 << 62))
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple], sequence_id: int | None = None) -> None:
        if sequence_id is None:
            sequence_id, self.next_id = self.next_id, self.next_id + 1
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, ids, total, sequence_id, offset, self.part))
            offset += n

    def _put(self, at: int, piece: tuple) -> None:
        """Place a piece that fits into the open window number `at`."""
        room, slot = self.open.pop(at)
        self.pieces[slot].append(piece)
        if room == len(piece[2]) // 4:
            self.emit(self.pieces.pop(slot))
        else:
            insort(self.open, (room - len(piece[2]) // 4, slot))

    def add(self, doc_id, start: int, ids: bytes, total: int) -> None:
        full = self.capacity * 4
        while len(ids) >= full:
            self.emit([(doc_id, start, ids[:full], total)])
            start, ids = start + self.capacity, ids[full:]
        if not ids:
            return
        at = bisect_left(self.open, (len(ids) // 4, -1))
        if at < len(self.open):
            self._put(at, (doc_id, start, ids, total))
            return
        if len(self.open) >= self.most:
            room = self.open[0][0]
            self._put(0, (doc_id, start, ids[: room * 4], total))
            start, ids = start + room, ids[room * 4 :]
        slot = next(self.slots)
        self.pieces[slot] = [(doc_id, start, ids, total)]
        insort(self.open, (self.capacity - len(ids) // 4, slot))

    def close(self) -> list[tuple]:
        """Merge the open windows, the fullest first, and return the pieces of the one that stays unfinished."""
        left = [p for _, slot in self.open for p in self.pieces[slot]]
        self.open, self.pieces, self.most = [], {}, 1
        for piece in left:
            self.add(*piece)
        return [p for _, slot in self.open for p in self.pieces[slot]]

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [[] for _ in OUT]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OUT)], schema=OUT)


#: Sequence ids: 4 bits of merge level, 27 of the task, 32 of the number within the task.
def _first_id(level: int, part: int) -> int:
    return level << 59 | part << 32


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, fan: int = FAN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    end = np.array([end_id], "<u4").tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        give_back()  # what an earlier stage left in this worker
        encode, windows = encoder(tokenizer), Windows(capacity, open_windows, _first_id(0, part), part)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                windows.add(doc_id, 0, ids, len(ids) // 4)
                if len(windows.rows) >= BATCH:
                    yield windows.take()
        windows.emit(windows.close(), -1)
        yield windows.take()
        give_back()

    def merge(level: int, groups: int):
        def run(key, pieces):
            part = key[0].as_py()
            windows = Windows(capacity, 1, _first_id(level, part), part)
            for r in pieces.sort_by([("doc_id", "ascending"), ("start", "ascending")]).to_pylist():
                windows.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
            windows.emit(windows.close(), -1 if groups > 1 else None)
            return pa.Table.from_batches([windows.take()])

        return run

    placed = staged(docs.select("doc_id", "text").mapInArrow(place, DDL))
    done = [placed.where("sequence_id >= 0")]
    left = placed.where("sequence_id < 0")
    groups = (left.agg(F.max("part")).first()[0] or 0) + 1
    level = 0
    while True:
        level, groups = level + 1, -(-groups // fan)
        merged = left.withColumn("part", F.expr(f"part div {fan}")).groupBy("part").applyInArrow(merge(level, groups), DDL)
        if groups == 1:
            done.append(merged)
            break
        merged = staged(merged)
        done.append(merged.where("sequence_id >= 0"))
        left = merged.where("sequence_id < 0")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("part")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents with the checksum of their ids."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
