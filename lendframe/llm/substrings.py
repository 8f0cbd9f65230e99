"""Removal of repeated byte strings: depth-limited most-significant-digit passes over the suffixes of all texts.

Suffixes are told apart only through the first WIDTH (100) bytes, so equal groups are exactly the repeated windows. The suffixes
that could be equal are narrowed down digit by digit, and a suffix that a digit sets apart is settled and goes no further:

1. The first digit is the window's anchor, its smallest hash of GRAM (40) bytes. Equal windows have equal anchors at equal distance,
   and neighbouring windows mostly share one, so one row stands for a run of windows (a chunk, some 30 of them). Chunks whose
   anchor occurs once are settled: none of their windows is repeated.
2. The second digit is the whole chunk. All windows of a chunk that also occurs earlier are repeats.
3. Only the first occurrence of a chunk whose anchor also occurs in a different chunk is left open, at the edges of repeated
   passages; its windows are compared one by one by their last digit, the whole window.

Each digit is a sharded exchange: hashes with positions go to shards of the hash space, once per block of documents for each distinct
hash, so a passage in a third of all documents is a row per block. An anchor that many chunks of a block share is known to be
open without being counted, so no anchor has more than HOT rows a block either. Digits are 64-bit hashes of the bytes.

Order: smaller doc_id first, null ids last, rows of equal ids in the order of the input; so of a repeated row the first keeps its
text. Null and empty texts have no bytes. Texts shorter than a window are never touched. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.blocks import blocks, get, opened, put, shard_of, shards_for
from lendframe.llm.common import BASE, BYTE, mix, slices, staged, table

WIDTH, GRAM = 100, 40
HOT = 16
SLICE = 1 << 19
LAST = np.iinfo(np.int64).max
#: Columns of what is sent for a digit, with the types of the compressed arrays.
ITEM = {"key": np.uint64, "chunk": np.uint32, "id": np.int64, "at": np.int64, "more": np.uint8, "block": np.int64}
ASK = "shard int, key binary, chunk binary, id binary, at binary, more binary, block binary, kind int"
#: What a row holds: items to be compared, items that are known to be open, windows known to be repeats.
COMPARE, OPEN, REPEAT = 0, 1, 2


def _both(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all strings of GRAM (8 + 32) and of WIDTH (4 + 32 + 64) bytes."""
    h, doubled = BYTE[data], {}
    for size in (1, 2, 4, 8, 16, 32):
        doubled[size] = h
        h = h[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + h[size:]
    n = len(data) - GRAM + 1
    gram = doubled[8][:n] * np.uint64(pow(BASE, 32, 1 << 64)) + doubled[32][8 : 8 + n]
    n = len(data) - WIDTH + 1
    wide = (doubled[4][:n] * np.uint64(pow(BASE, 32, 1 << 64)) + doubled[32][4 : 4 + n]) * np.uint64(pow(BASE, 64, 1 << 64)) + h[36 : 36 + n]
    return mix(gram), mix(wide)


def chunks(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: key (of the anchor), chunk (of the whole run), at (first window), more (windows after it)."""
    out = []
    for low, high in slices(offsets, SLICE):
        part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        if len(part) < WIDTH:
            continue
        gram, wide = _both(part)
        bits = np.uint64(32)
        # the smallest gram of each window, the leftmost of equals: the upper half of its hash, then its place
        least = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)
        for step in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-step], least[step:])
        span = WIDTH - GRAM + 1
        least = np.minimum(least[: len(wide)], least[span - 32 : span - 32 + len(wide)])
        anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        room = np.diff(at) >= WIDTH
        edge = np.zeros(len(part) + 1, np.int32)
        np.add.at(edge, at[:-1][room], 1)
        np.add.at(edge, at[1:][room] - WIDTH + 1, -1)
        inside = np.cumsum(edge[: len(wide)]) > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
        last = inside.copy()
        last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        whole = mix(wide[a] + mix(wide[b]) * np.uint64(BASE) + (b - a).astype(np.uint64))
        out.append((gram[anchor[a]], whole, a + offsets[low], b - a))
    if not out:
        return {"key": np.zeros(0, np.uint64), "whole": np.zeros(0, np.uint64), "at": np.zeros(0, np.int64), "more": np.zeros(0, np.int64)}
    return dict(zip(("key", "whole", "at", "more"), map(np.concatenate, zip(*out))))


def _ids(row: dict, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    ids = np.array([LAST if x is None else x for x in row["ids"]], np.int64)
    return ids[np.searchsorted(offsets, at, "right") - 1]


def _firsts(key: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting by key and then by order, and which sorted rows are the first of their key."""
    by = np.lexsort((*order[::-1], key))
    new = np.ones(len(key), bool)
    new[1:] = key[by[1:]] != key[by[:-1]]
    return by, new


def _sent(shards: int, items: dict[str, np.ndarray], kind: int = COMPARE) -> pa.Table:
    """Rows that send items (columns of ITEM) to the shards of their keys."""
    shard = shard_of(items["key"], shards)
    by = np.argsort(shard.astype(np.int32), kind="stable")
    cuts = np.searchsorted(shard[by], np.arange(shards + 1))
    full = np.flatnonzero(np.diff(cuts))
    packed = {c: pa.array([put(items[c][by[cuts[s] : cuts[s + 1]]].astype(t)) for s in full], pa.binary()) for c, t in ITEM.items()}
    return pa.table({"shard": pa.array(full.astype(np.int32)), **packed, "kind": pa.array(np.full(len(full), kind, np.int32))})


def _repeats(shards: int, block: int, at: np.ndarray, more: np.ndarray) -> pa.Table:
    """The row that carries windows of a block that are known to be repeats through the exchange."""
    n = len(at)
    key = np.full(n, mix(np.array([block], np.uint64))[0])
    return _sent(shards, {"key": key, "chunk": np.zeros(n), "id": np.zeros(n), "at": at, "more": more, "block": np.full(n, block)}, REPEAT)


def _received(rows: pa.Table, *kinds: int) -> dict[str, np.ndarray]:
    """All items of these kinds that a shard was sent."""
    mine = np.flatnonzero(np.isin(rows["kind"].to_numpy(), kinds)).tolist()
    columns = {c: rows[c].to_pylist() for c in ITEM}
    return {c: np.concatenate([np.zeros(0, t), *(get(columns[c][i], t) for i in mine)]) for c, t in ITEM.items()}


def _split(block: np.ndarray, **columns: np.ndarray):
    """The rows of each block."""
    by = np.argsort(block, kind="stable")
    names, cuts = np.unique(block[by], return_index=True)
    for name, a, b in zip(names.tolist(), cuts, [*cuts[1:], len(by)]):
        yield name, {c: x[by[a:b]] for c, x in columns.items()}


def _marks(rows: list[tuple]) -> pa.Table:
    """Answers to blocks: at and more of windows that are repeats (what = 0) or still open (what = 1)."""
    block, at, more, what = zip(*rows) if rows else ([], [], [], [])
    return pa.table({"block": pa.array(block, pa.int64()), "at": pa.array(at, pa.binary()), "more": pa.array(more, pa.binary()), "what": pa.array(what, pa.binary())})


MARKS = "block long, at binary, more binary, what binary"


def _answer(block, at, more, what) -> tuple:
    return block, put(at.astype(np.int64)), put(more.astype(np.uint8)), put(what.astype(np.uint8))


def _carried(rows: pa.Table) -> list[tuple]:
    """Repeats that a shard only passes on."""
    items = _received(rows, REPEAT)
    return [_answer(name, x["at"], x["more"], np.zeros(len(x["at"]))) for name, x in _split(items["block"], at=items["at"], more=items["more"])]


def first_digit(shards: int):
    """Of each block its distinct chunks for the anchors' shards, and what needs no comparison: sure to be open, or a repeat."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = opened(row)
                found = chunks(data, offsets)
                found["id"] = _ids(row, offsets, found["at"])
                by, new = _firsts(found["whole"], found["id"], found["at"])
                again, once = by[~new], np.sort(by[new])
                mine = {c: x[once] for c, x in found.items()}
                mine |= {"chunk": mine["whole"] >> np.uint64(32), "block": np.full(len(once), row["block"])}
                by, new = _firsts(mine["key"], np.arange(len(once)))
                nth = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
                hot = np.zeros(len(once), bool)
                hot[by] = nth >= HOT
                sure = _chunk_items({c: x[hot] for c, x in mine.items()}, np.ones(hot.sum(), bool))
                sent = [_sent(shards, {c: x[~hot] for c, x in mine.items()}), _sent(shards, sure, OPEN), _repeats(shards, row["block"], found["at"][again], found["more"][again])]
                yield from pa.concat_tables(sent).to_batches(max_chunksize=64)

    return run


def _chunk_items(items: dict[str, np.ndarray], open_: np.ndarray) -> dict[str, np.ndarray]:
    """Items keyed by the whole chunk; `chunk` says whether other chunks share the anchor."""
    whole = mix(items["key"] * np.uint64(BASE) + items["chunk"].astype(np.uint64) + (items["more"].astype(np.uint64) << np.uint64(40)))
    return items | {"key": whole, "chunk": open_}


def second_digit(shards: int):
    """Chunks whose anchor occurs again, for the shards of the whole chunks."""

    def run(rows):
        items = _received(rows, COMPARE)
        by, new = _firsts(items["key"], items["chunk"])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        key, chunk = items["key"][by], items["chunk"][by]
        other = np.ones(len(by), bool)
        other[1:] = new[1:] | (chunk[1:] != chunk[:-1])
        different = np.bincount(group, other)
        keep = size[group] > 1
        by, open_ = by[keep], different[group][keep] > 1
        passed = rows.filter(pc.not_equal(rows["kind"], COMPARE))
        return pa.concat_tables([_sent(shards, _chunk_items({c: x[by] for c, x in items.items()}, open_), OPEN), passed])

    return run


def third_digit(rows):
    """For each block the chunks that occur earlier (repeats) and the first ones that stay open."""
    items = _received(rows, OPEN)
    block = items["block"]
    by, new = _firsts(items["key"], items["id"], block, items["at"])
    group = np.cumsum(new) - 1
    open_ = np.bincount(group, items["chunk"][by].astype(np.int64)) > 0
    keep = ~new | open_[group]
    by, what = by[keep], new[keep]
    return _marks([_answer(name, x["at"], x["more"], x["what"]) for name, x in _split(block[by], at=items["at"][by], more=items["more"][by], what=what)] + _carried(rows))


def windows(shards: int):
    """The open windows of a block for the shards of the whole windows, and its repeats so far (kind 2)."""

    def run(left, right):
        row = left.to_pylist()[0]
        data, offsets = opened(row)
        at, more, what = (np.concatenate([np.zeros(0, t), *(get(x, t) for x in right[c].to_pylist())]).astype(t) for c, t in (("at", np.int64), ("more", np.uint8), ("what", np.uint8)))
        at, more = at[what == 1], more[what == 1].astype(np.int64)
        hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i in range(0, len(at), 4096):  # the bytes of the open chunks side by side
            a, m = at[i : i + 4096], more[i : i + 4096]
            n = m + WIDTH
            starts = np.cumsum(n) - n
            near = np.arange(n.sum()) - np.repeat(starts, n)
            _, wide = _both(data[np.repeat(a, n) + near])
            use = np.flatnonzero(near <= np.repeat(m, n))
            hashes.append(wide[use])
            places.append((np.repeat(a, n) + near)[use])
        h, p = np.concatenate(hashes), np.concatenate(places)
        ids = _ids(row, offsets, p)
        by, new = _firsts(h, ids, p)
        again, once = by[~new], np.sort(by[new])
        n = len(once)
        asked = _sent(shards, {"key": h[once], "chunk": np.zeros(n), "id": ids[once], "at": p[once], "more": np.zeros(n), "block": np.full(n, row["block"])})
        return pa.concat_tables([asked, _repeats(shards, row["block"], p[again], np.zeros(len(again)))])

    return run


def last_digit(rows):
    """For each block the windows that also start earlier."""
    items = _received(rows, COMPARE)
    block = items["block"]
    by, new = _firsts(items["key"], items["id"], block, items["at"])
    by = by[~new]
    return _marks([_answer(name, x["at"], x["more"], np.zeros(len(x["at"]))) for name, x in _split(block[by], at=items["at"][by], more=items["more"][by])] + _carried(rows))


def cut(left, right):
    """For each document of a block its removed runs and the text that is left."""
    row = left.to_pylist()[0]
    data, offsets = opened(row)
    change = np.zeros(len(data) + 1, np.int32)
    for a, m, w in zip(*(right[c].to_pylist() for c in ("at", "more", "what"))):
        at, more, what = get(a, np.int64), get(m, np.uint8).astype(np.int64), get(w, np.uint8)
        at, more = at[what == 0], more[what == 0]
        np.add.at(change, at, 1)
        np.add.at(change, at + more + WIDTH, -1)
    gone = np.cumsum(change[:-1], dtype=np.int32) > 0
    del change
    start = gone.copy()
    start[1:] &= ~gone[:-1]
    start[offsets[:-1][np.diff(offsets) > 0]] |= gone[offsets[:-1][np.diff(offsets) > 0]]
    before, spans = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)])[offsets].astype(np.int64) for x in (gone, start))
    removed, spans = np.diff(before), np.diff(spans)
    rest, at = data[~gone].tobytes(), offsets - before
    kept = [rest[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return pa.table({"doc_id": pa.array(row["ids"], pa.int64()), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed.astype(np.int64)), "n_spans": pa.array(spans.astype(np.int64)), "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, finish=cut, kind: str = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept, the remaining bytes, of every document."""
    written = blocks(docs.select("doc_id", F.lit(0).cast("long").alias("mark"), "text"))
    shards = shards_for(written)
    counted = written.mapInArrow(first_digit(shards), ASK).groupBy("shard").applyInArrow(second_digit(shards), ASK)
    marks = staged(counted.groupBy("shard").applyInArrow(third_digit, MARKS))
    asked = written.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(windows(shards), ASK)
    found = marks.unionByName(asked.groupBy("shard").applyInArrow(last_digit, MARKS))
    return written.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(finish, kind)


def _digest(left, right):
    done = cut(left, right)
    sha = pa.array([hashlib.sha256(x).hexdigest() for x in done["kept"].to_pylist()])
    return done.drop_columns(["kept"]).append_column("kept_sha256", sha)


def op3_substrings(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
