"""Helpers of the operators: Arrow text as byte arrays, hashes of words and byte strings, staged tables.

Everything works on whole Arrow batches with numpy; no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.session import staged

__all__ = ["staged", "utf8", "slices", "mix", "word_spans", "word_hashes", "window_hashes", "ascii_lower", "crc_of", "give_back", "ship", "table"]

#: White space of the word definition `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Lower case for A to Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Odd multiplier of the polynomial hashes, modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def ship(spark) -> None:
    """Send this package to the executors' Python workers, once for each application, as `spark-submit --py-files` does."""
    context = spark.sparkContext
    if not getattr(context, "_lendframe_shipped", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="lendframe-")) / "lendframe.zip"  # on the driver, which serves it to the executors
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._lendframe_shipped = True


def table(spark, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_of(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task, and keeps what it once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A random-looking 64-bit value for each byte.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


@lru_cache(2)
def _powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the offsets where each begins and the last ends. Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together; a longer text is a range of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, high
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words of each text. No word crosses texts."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, lower-cased in A to Z, and the number of words of each text."""
    found, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, high in slices(offsets, most):
        part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        starts, ends, n = word_spans(part, at)
        room = 1 << max(20, len(part).bit_length())
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE[LOWER[part]] * _powers(room, BASE)[: len(part)], dtype=np.uint64, out=sums[1:])
        h = (sums[ends] - sums[starts]) * _powers(room, INVERSE)[starts]
        found.append(mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        counts.append(n)
    return np.concatenate(found), np.concatenate(counts)


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each string of `width` bytes, by doubling: a string is its first and its second half."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, size, out, done = BYTE[data], 1, None, 0
    while True:
        if width & size:
            piece = h[done : done + n]
            out = piece.copy() if out is None else out * np.uint64(pow(BASE, size, 1 << 64)) + piece
            done += size
        if done == width:
            return mix(out)
        h = h[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + h[size:]
        size *= 2
