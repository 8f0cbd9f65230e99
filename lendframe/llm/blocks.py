"""Blocks of whole documents, and sharded exchanges between blocks and keys.

A block is some 8 MB of documents in one row: ids, offsets, and the bytes compressed. Operators that look up something for every
place of every text ask for the distinct keys of a block at a time: a block sends each shard of the key space the keys it holds, as
one array; the shard puts the arrays of all blocks together and answers each. So no key is sent more often than there are
blocks, whatever its frequency, shards are even because keys are hashes, and the work is numpy on arrays of bounded size.
Blocks are written once; a task that is lost reads its own again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lendframe.llm.common import staged, utf8

BLOCK = 8 << 20
DDL = "block long, ids array<long>, marks array<long>, offsets binary, text binary"


def put(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(array).tobytes())


def get(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


def _pack(batches):
    part, number = TaskContext.get().partitionId() << 32, 0
    ids, marks, lengths, texts, size = [], [], [], [], 0

    def row():
        nonlocal ids, marks, lengths, texts, size, number
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int64)
        out = pa.RecordBatch.from_arrays(
            [pa.array([part + number]), pa.array([sum(ids, [])], pa.list_(pa.int64())), pa.array([sum(marks, [])], pa.list_(pa.int64())),
             pa.array([put(offsets)], pa.binary()), pa.array([put(np.concatenate(texts))], pa.binary())],
            names=["block", "ids", "marks", "offsets", "text"],
        )
        ids, marks, lengths, texts, size, number = [], [], [], [], 0, number + 1
        return out

    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        low, n = 0, batch.num_rows
        while low < n:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + max(BLOCK - size, 0), "right")) - 1)
            ids.append(batch.column("doc_id").slice(low, high - low).to_pylist())
            marks.append(batch.column("mark").slice(low, high - low).to_pylist())
            lengths.append(np.diff(offsets[low : high + 1]))
            texts.append(data[offsets[low] : offsets[high]].copy())
            size += offsets[high] - offsets[low]
            if size >= BLOCK * 0.9:
                yield row()
            low = high
    if lengths:
        yield row()


def blocks(docs: DataFrame) -> DataFrame:
    """Written blocks of docs (doc_id, mark, text): block, ids, marks, offsets, text."""
    return staged(docs.select("doc_id", "mark", "text").mapInArrow(_pack, DDL))


def opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a block."""
    return get(row["text"], np.uint8), get(row["offsets"], np.int64)


def shards_for(written: DataFrame) -> int:
    """As many shards of the key space as there are blocks, so that a shard holds about what a block sends."""
    return max(6, written.count())


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the upper bits of a 64-bit key; it rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
