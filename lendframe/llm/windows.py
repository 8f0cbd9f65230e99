"""Removal of repeated windows of words: a count-min sketch of all windows first, exact groups of what it calls repeated second.

A window is WIDTH (35) consecutive words of one document, words being `[^\\x20\\x09-\\x0D]+`, unchanged. Each block of documents makes a
sketch of its windows: in each of ROWS hash rows the cells its windows fall into, with their counts up to two. The sketches of all
blocks are merged cell by cell, in shards of the cells, and each block is told which of its cells hold two windows or more. A
window whose cells do so in every row is estimated repeated. Estimates are never below the truth, so no repeated window is lost;
of the others about one in 270 gets that far (1 / LOAD a row), at any size, since there are LOAD cells a row for each window.

The second pass groups only the windows estimated repeated, by 128 bits of their words, and is exact but for a collision of those
(below 1e-10 at 1e14 windows). Within a block equal windows are one item, so a passage that a third of all documents share is an
item for each block in either pass.

Windows are judged on the input, and every occurrence of a repeated window goes, the first one too. Rows are documents of their own,
whatever their id, so a repeated row of 35 words or more loses all words. Null text has no words. Documents shorter than a
window are untouched. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.blocks import blocks, get, opened, put, shards_for
from lendframe.llm.common import BASE, BYTE, INVERSE, _powers, mix, slices, staged, table, word_spans

WIDTH = 35
ROWS, LOAD = 2, 16
#: Bytes of a word with its space, about; where words are shorter, estimates are coarser and the exact pass groups more.
LETTERS = 6
#: Multipliers of the hash rows, and of the second half of a window's key.
SALTS = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0xA24BAED4963EE407)]
OTHER = 0xD1342543DE82EF95
SLICE = 1 << 20
SENT = "shard int, block long, row int, cells binary, twice binary"
TOLD = "block long, shard int, row int, bits binary"
#: `row` of what belongs to the second pass.
EXACT = ROWS


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of all words, and the number of words of each text."""
    starts, ends, hashes, counts = ([np.zeros(0, t)] for t in (np.int64, np.int64, np.uint64, np.int64))
    for low, high in slices(offsets, SLICE):
        part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        a, b, n = word_spans(part, at)
        room = 1 << max(20, len(part).bit_length())
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE[part] * _powers(room, BASE)[: len(part)], dtype=np.uint64, out=sums[1:])
        h = (sums[b] - sums[a]) * _powers(room, INVERSE)[a]
        starts.append(a + offsets[low])
        ends.append(b + offsets[low])
        hashes.append(mix(h + (b - a).astype(np.uint64) * SALTS[0]))
        counts.append(n)
    return tuple(map(np.concatenate, (starts, ends, hashes, counts)))


def _rolled(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each run of `width` values, by doubling: a run is its first and its second half."""
    n, out, done, size = len(h) - width + 1, None, 0, 1
    while done < width:
        if width & size:
            piece = h[done : done + n]
            out = piece.copy() if out is None else out * np.uint64(pow(base, size, 1 << 64)) + piece
            done += size
        if done < width:
            h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
            size *= 2
    return mix(out)


def window_keys(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and both halves of the key of each window; none crosses documents."""
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(len(hashes))  # words to the end of the document
    at = np.flatnonzero(left[: len(hashes) - width + 1] >= width)
    return at, _rolled(hashes, width, BASE)[at], _rolled(mix(hashes ^ SALTS[1]), width, OTHER)[at]


def _in_block(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = opened(row)
    _, _, hashes, counts = words_of(data, offsets)
    return window_keys(hashes, counts, width)


def _cells(key: np.ndarray, row: int, shards: int, room: int) -> np.ndarray:
    """Cell of each window in a hash row: shard * room + place, one of shards * room."""
    h = mix(key * SALTS[row])
    shard = (h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    return (shard * np.uint64(room) + ((h & np.uint64(0xFFFFFFFF)) * np.uint64(room) >> np.uint64(32))).astype(np.int64)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, whether each occurs again, and the place of each of the given values among them."""
    by = np.argsort(values, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = values[by[1:]] != values[by[:-1]]
    at = np.flatnonzero(new)
    place = np.empty(len(by), np.int64)
    place[by] = np.cumsum(new) - 1
    return values[by[at]], np.diff(np.append(at, len(by))) > 1, place


def _steps(sorted_: np.ndarray) -> bytes:
    """Rising numbers as differences, in as few bytes as the largest needs; the first byte tells how many."""
    steps = np.diff(sorted_, prepend=0)
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(steps) or steps.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + put(steps.astype(kind))


def _unstep(blob: bytes) -> np.ndarray:
    return np.cumsum(get(blob[1:], f"u{blob[0]}").astype(np.int64))


def _bits(flags: np.ndarray) -> bytes:
    return put(np.packbits(flags))


def _unbits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(get(blob, np.uint8), count=n).astype(bool)


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    named = [x.split() for x in ddl.split(", ")]
    columns = zip(*rows) if rows else ([] for _ in named)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(named, columns)})


def sketch(shards: int, room: int, width: int):
    """The sketch of each block: for each hash row and shard its cells, and which of them hold two of its windows."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, key, _ = _in_block(row, width)
                for j in range(ROWS):
                    cells, twice, _ = _distinct(_cells(key, j, shards, room))
                    cuts = np.searchsorted(cells, np.arange(shards + 1) * room)
                    out = [(s, row["block"], j, _steps(cells[a:b] - s * room), _bits(twice[a:b])) for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if a < b]
                    yield from _table(out, SENT).to_batches(max_chunksize=64)

    return run


def merge(room: int):
    """The merged sketch of a shard of the cells; each block hears which of its cells hold two windows or more, over all blocks."""

    def run(rows):
        out = []
        for j in range(ROWS):
            held, mine = np.zeros(room, np.uint8), []
            for name, row, shard, cells, twice in zip(*(rows[c].to_pylist() for c in ("block", "row", "shard", "cells", "twice"))):
                if row == j:
                    at = _unstep(cells)
                    held[at] = np.minimum(held[at] + 1 + _unbits(twice, len(at)), 2)
                    mine.append((name, shard, at))
            out += [(name, shard, j, _bits(held[at] > 1)) for name, shard, at in mine]
        return _table(out, TOLD)

    return run


def _told(answers: dict, row: int, cells: np.ndarray, shards: int, room: int) -> np.ndarray:
    """What the shards said of a block's sorted distinct cells."""
    cuts = np.searchsorted(cells, np.arange(shards + 1) * room).tolist()
    said = [_unbits(answers[row, s], b - a) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
    return np.concatenate([np.zeros(0, bool), *said])


def _estimated(row: dict, answers: pa.Table, shards: int, room: int, width: int):
    """Windows of a block that are estimated repeated: first words, both halves of their keys; and all answers by row and shard."""
    at, key, other = _in_block(row, width)
    said = dict(zip(zip(answers["row"].to_pylist(), answers["shard"].to_pylist()), answers["bits"].to_pylist()))
    for j in range(ROWS):  # a window that the first row sets free need not be looked up in the second
        cells, _, place = _distinct(_cells(key, j, shards, room))
        if j == 0:
            again = _told(said, j, cells, shards, room)[place]
        else:
            again &= _told(said, j, cells, shards, room)[place]
    return at[again], key[again], other[again], said


def _whole(key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the distinct 128-bit keys: their places in the given arrays, whether they occur again, and each one's number."""
    by = np.lexsort((other, key))
    new = np.ones(len(by), bool)
    new[1:] = (key[by[1:]] != key[by[:-1]]) | (other[by[1:]] != other[by[:-1]])
    first = np.flatnonzero(new)
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(new) - 1
    return by[first], np.diff(np.append(first, len(by))) > 1, number


def _upper(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def ask(shards: int, room: int, width: int):
    """Keys of the windows of a block that are estimated repeated, for the shards of the exact groups."""

    def run(left, right):
        row = left.to_pylist()[0]
        _, key, other, _ = _estimated(row, right, shards, room, width)
        once, twice, _ = _whole(key, other)
        key, other = key[once], other[once]
        cuts = np.searchsorted(_upper(key, shards), np.arange(shards + 1)).tolist()
        out = [(s, row["block"], EXACT, put(np.stack([key[a:b], other[a:b]])), _bits(twice[a:b])) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
        return _table(out, SENT)

    return run


def exact(rows):
    """Groups equal keys of all blocks; each block hears which of its windows occur anywhere else."""
    names, shards = rows["block"].to_pylist(), rows["shard"].to_pylist()
    pairs = [get(x, np.uint64).reshape(2, -1) for x in rows["cells"].to_pylist()]
    cuts = np.cumsum([0, *(p.shape[1] for p in pairs)]).tolist()
    twice = np.concatenate([_unbits(x, p.shape[1]) for x, p in zip(rows["twice"].to_pylist(), pairs)])
    key, other = np.concatenate(pairs, axis=1)
    _, again, number = _whole(key, other)
    again |= np.bincount(number, twice, len(again)) > 0
    hit = again[number]
    return _table([(name, s, EXACT, _bits(hit[a:b])) for name, s, a, b in zip(names, shards, cuts[:-1], cuts[1:])], TOLD)


def kept_words(shards: int, room: int, width: int):
    """For each document of a block its words, how many of them go, and the others joined by one space."""

    def run(left, right):
        row = left.to_pylist()[0]
        at, key, other, said = _estimated(row, right, shards, room, width)
        once, _, number = _whole(key, other)
        cuts = np.searchsorted(_upper(key[once], shards), np.arange(shards + 1)).tolist()
        hit = np.concatenate([np.zeros(0, bool), *(_unbits(said[EXACT, s], b - a) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b)])
        data, offsets = opened(row)
        starts, ends, _, counts = words_of(data, offsets)
        change = np.zeros(len(starts) + 1, np.int32)
        gone_at = at[hit[number]]
        np.add.at(change, gone_at, 1)
        np.add.at(change, gone_at + width, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        words = np.concatenate([[0], np.cumsum(counts)])
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words])
        texts = []
        for low, high in slices(offsets, SLICE):
            a, b = words[low], words[high]
            stay = ~gone[a:b]
            s, size = starts[a:b][stay], (ends - starts)[a:b][stay] + 1  # a word and the space after it
            stop = np.cumsum(size)
            place = np.arange(size.sum()) + np.repeat(s - (stop - size), size)
            out = data[np.minimum(place, len(data) - 1)]
            out[stop - 1] = 32
            upto = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(stay)])[words[low : high + 1] - a]].tolist()
            out = out.tobytes()
            texts += [out[x : max(x, y - 1)] for x, y in zip(upto[:-1], upto[1:])]
        return pa.table({"doc_id": pa.array(row["ids"], pa.int64()), "n_words": pa.array(counts.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "kept": pa.array(texts, pa.binary())})

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, finish=None, kind: str = "doc_id long, n_words long, n_removed long, kept binary") -> DataFrame:
    """doc_id, n_words, n_removed and kept, the words that stay joined by one space, of every row of docs (doc_id, text)."""
    written = blocks(docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("mark"), "text"))
    shards = shards_for(written)
    size = written.select(F.sum(F.aggregate("marks", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    room = max(1 << 16, LOAD * size // LETTERS // shards)  # cells of a shard in a row
    sent = written.mapInArrow(sketch(shards, room, width), SENT)
    told = staged(sent.groupBy("shard").applyInArrow(merge(room), TOLD))
    asked = written.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(ask(shards, room, width), SENT)
    answers = told.unionByName(asked.groupBy("shard").applyInArrow(exact, TOLD))
    last = kept_words(shards, room, width)
    done = last if finish is None else (lambda left, right: finish(last(left, right)))
    return written.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(done, kind)


def _digest(done):
    sha = pa.array([hashlib.sha256(x).hexdigest() for x in done["kept"].to_pylist()], pa.string())
    return done.drop_columns(["kept"]).append_column("kept_sha256", sha)


def op11_windows(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), WIDTH, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (
  SELECT r, i, array_to_string(words[i : i + 34], ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)),
repeated AS (SELECT win FROM w GROUP BY win HAVING count(*) > 1),
hit AS (SELECT r, i FROM w SEMI JOIN repeated USING (win)),
gone AS (SELECT DISTINCT r, i + unnest(range(0, 35)) AS p FROM hit),
lists AS (SELECT r, list(p) AS ps FROM gone GROUP BY r),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lists USING (r) LEFT JOIN kept USING (r)
"""
