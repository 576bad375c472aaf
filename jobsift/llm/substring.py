"""Removal of repeated passages with difference-cover anchors.

A window is L consecutive words of one document; every word covered by a window
that occurs more than once goes. Word positions in D modulo v are anchors, D being
a difference cover: for any two positions there is a shift below v that puts both
on anchors. So two equal windows always share an aligned anchor, a hash of
L - v + 1 words that lies inside both. Only these sparse hashes of all words meet
in the first shuffle; from shared anchors the candidate windows extend, and only
those meet, with 96-bit hashes, in the second.

Texts travel in compressed blocks of documents. Hashes travel as packed arrays,
one row per block and bucket. Equal hashes inside a block are settled where they
are read, so a passage that a third of all documents share reaches its bucket at
most once a block.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import combinations, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import bounded_batches, buffers, shuffle_partitions, stored, text_bytes

WINDOW, PERIOD = 35, 21
#: Bytes of text after which a block ends.
BLOCK_BYTES = 4_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache
def difference_cover(v: int) -> tuple[int, ...]:
    """A smallest set holding 0 of residues whose differences give every residue modulo v."""
    for k in range(1, v + 1):
        for rest in combinations(range(1, v), k - 1):
            d = (0, *rest)
            if len({(a - b) % v for a in d for b in d}) == v:
                return d
    raise ValueError("v must be positive")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@lru_cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


class Words:
    """The words of a block's documents: ``hashes`` of all, ``first`` word of each document, byte ``starts`` and ``ends``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = np.append(~_WHITE[data], False)
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.concatenate([[False], solid[:-1]])
        self.starts = np.flatnonzero(solid & (~before | cut))
        self.ends = np.flatnonzero(before & (~solid | cut))
        if len(data):
            size = 1 << int(len(data)).bit_length()
            up, down = _powers(size)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])])
            self.hashes = _mix((total[self.ends] - total[self.starts]) * down[self.starts])
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.starts, offsets)
        counts = np.diff(self.first)
        self.position = np.arange(len(self.starts)) - np.repeat(self.first[:-1], counts)
        self.left = np.repeat(counts, counts) - self.position

    def window_hashes(self, length: int, salt: int = 0) -> np.ndarray:
        """For each word the hash of the ``length`` words from it on, by doubling; only valid where ``left`` >= length."""
        h, size, out, have = _mix(self.hashes ^ np.uint64(salt)), 1, None, 0
        while True:
            if length & size:
                if out is None:
                    out, have = h, size
                else:
                    n = max(0, len(self.hashes) - have - size + 1)
                    out, have = _mix(out[:n] * np.uint64(_BASE) + h[have:have + n]), have + size
            if 2 * size > length:
                return out
            h, size = _mix(h[:max(0, len(h) - size)] * np.uint64(0xD6E8FEB86659FD93) + h[size:]), 2 * size

    def anchors(self, window: int, period: int) -> np.ndarray:
        length = window - period + 1
        on = np.zeros(period, bool)
        on[list(difference_cover(period))] = True
        enough = np.repeat(np.diff(self.first), np.diff(self.first)) >= window
        return np.flatnonzero(on[self.position % period] & (self.left >= length) & enough)

    def candidates(self, shared: np.ndarray, window: int, period: int) -> np.ndarray:
        """Windows around shared anchors."""
        doc = np.searchsorted(self.first, shared, side="right") - 1
        low = np.maximum(shared - period + 1, self.first[doc])
        high = np.minimum(shared, self.first[doc + 1] - window)
        ok = high >= low
        change = np.bincount(low[ok], minlength=len(self.starts) + 1) - np.bincount(high[ok] + 1, minlength=len(self.starts) + 1)
        return np.flatnonzero(np.cumsum(change[:len(self.starts) + 1])[:-1] > 0) if len(self.starts) else np.zeros(0, np.int64)


# Blocks -------------------------------------------------------------------------------------------

def _blocks(batches):
    """(block number, ids, data, offsets) of a task's rows, about BLOCK_BYTES each, in the order read."""
    part, number, ids, texts, size = TaskContext.get().partitionId() << 32, 0, [], [], 0

    def done():
        data = np.concatenate(texts) if texts else np.zeros(0, np.uint8)
        return part + number, pa.chunked_array(ids).combine_chunks(), data, np.cumsum([0, *map(len, texts)])

    for b in batches:
        data, offsets = buffers(b.column("__bytes"))
        at = 0
        for i in range(b.num_rows):
            texts.append(data[offsets[i]:offsets[i + 1]])
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                ids.append(b.column("__id").slice(at, i + 1 - at))
                yield done()
                number, at, ids, texts, size = number + 1, i + 1, [], [], 0
        if at < b.num_rows:
            ids.append(b.column("__id").slice(at))
    if texts:
        yield done()


def _pack(index: np.ndarray) -> bytes:
    """Rising numbers as differences, whose zero bytes the shuffle compresses."""
    return np.diff(index, prepend=0).astype("<u4").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4").astype(np.int64))


def _settle(block: int, index: np.ndarray, high: np.ndarray, low: np.ndarray, buckets: int):
    """Rows to shuffle (bucket, block, kind, index, high, low) for hashes at ``index`` of one block.

    Hashes that the block holds more than once are shared for certain: their
    places come as kind 1, to be passed through, and one of each is sent as
    kind 2. The rest are sent as kind 0, with their places.
    """
    order = np.lexsort((index, low, high))
    h, lo = high[order], low[order]
    same = (h[1:] == h[:-1]) & (lo[1:] == lo[:-1])
    again = np.zeros(len(h), bool)
    again[1:] |= same
    again[:-1] |= same
    lead = np.concatenate([[True], ~same])[:len(h)]
    shared = np.sort(index[order[again]])
    if len(shared):
        yield (block * 0x9E3779B97F4A7C15 >> 32) % buckets, block, 1, _pack(shared), b"", b""
    for kind, chosen in ((0, order[~again]), (2, order[again & lead])):
        chosen = np.sort(chosen)
        bucket = (high[chosen] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1, append=buckets))
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = chosen[by[a:b]]
            yield (int(bucket[by[a]]), block, kind, _pack(index[part]) if kind == 0 else b"", high[part].tobytes(),
                   low[part].astype("<u4").tobytes())


_SENT = "bucket int, block long, kind int, places binary, high binary, low binary"
_NAMES = ["bucket", "block", "kind", "places", "high", "low"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _batches(rows, names, types, most: int = 8_000_000):
    """Arrow batches of rows of at most about ``most`` bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes)) + 64
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _meet(batches):
    """Of one task's buckets: which places of which blocks hold a hash that occurs more than once."""
    blocks, places, high, low = [], [], [], []

    def rows():
        for b in batches:
            for block, kind, at, h, lo in zip(*(b.column(c).to_pylist() for c in ("block", "kind", "places", "high", "low"))):
                if kind == 1:
                    yield block, at
                    continue
                h = np.frombuffer(h, np.uint64)
                high.append(h)
                low.append(np.frombuffer(lo, "<u4"))
                places.append(_unpack(at) if kind == 0 else np.full(len(h), -1))
                blocks.append(np.full(len(h), block))
        if not high:
            return
        h, lo, at, block = (np.concatenate(x) for x in (high, low, places, blocks))
        for x in (high, low, places, blocks):
            x.clear()
        order = np.lexsort((lo, h))
        same = (h[order][1:] == h[order][:-1]) & (lo[order][1:] == lo[order][:-1])
        shared = np.zeros(len(h), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        shared &= at >= 0
        at, block = at[shared], block[shared]
        order = np.lexsort((at, block))
        at, block = at[order], block[order]
        cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(block[a]), _pack(at[a:b])

    yield from _batches(rows(), ["block", "places"], [pa.int64(), pa.binary()])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   period: int = PERIOD, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (words joined by one space).

    Windows are judged on the input. A null or empty text, or one shorter than a
    window, keeps all its words. Null and repeated ids keep their rows, and each
    row is a document of its own, so repeated rows repeat each other's windows.
    An empty table gives no rows; other columns are not read. Texts are stored once as numbered,
    compressed blocks, which all later steps read, so no number is made twice. The
    equality of windows is that of 96-bit hashes.
    """
    if not 1 <= period <= window:
        raise ValueError("the period must not exceed the window")
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = bounded_batches(docs).select(F.col(id_col).alias("__id"), text_bytes(text_col).alias("__bytes"))

    def send_anchors(batches):
        def rows():
            for block, _, data, offsets, _ in unpacked(batches):
                words = Words(data, offsets)
                at = words.anchors(window, period)
                h = words.window_hashes(window - period + 1)[at] if len(at) else np.zeros(0, np.uint64)
                yield from _settle(block, at, h, np.zeros(len(at), np.uint32), buckets)
        yield from _batches(rows(), _NAMES, _TYPES)

    def pack_blocks(batches):
        squeeze = zstandard.ZstdCompressor(level=6).compress
        for block, ids, data, offsets in _blocks(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([np.diff(offsets).astype("<i8").tobytes()], pa.binary()), pa.array([squeeze(data.tobytes())], pa.binary())],
                names=["block", "ids", "sizes", "texts"])

    def unpacked(batches):
        """(block, ids, data, offsets, places) of joined rows."""
        for b in batches:
            for i in range(b.num_rows):
                data = np.frombuffer(zstandard.ZstdDecompressor().decompress(b.column("texts")[i].as_py()), np.uint8)
                offsets = np.concatenate([[0], np.cumsum(np.frombuffer(b.column("sizes")[i].as_py(), "<i8"))]).astype(np.int64)
                found = (b.column("found")[i].as_py() or []) if "found" in b.schema.names else []
                places = np.unique(np.concatenate([_unpack(x) for x in found])) if found else np.zeros(0, np.int64)
                yield b.column("block")[i].as_py(), b.column("ids")[i].values, data, offsets, places

    def send_windows(batches):
        def rows():
            for block, _, data, offsets, shared in unpacked(batches):
                words = Words(data, offsets)
                at = words.candidates(shared, window, period)
                if len(at):
                    high, low = words.window_hashes(window)[at], words.window_hashes(window, salt=0x5851F42D4C957F2D)[at]
                    yield from _settle(block, at, high, low.astype(np.uint32), buckets)
        yield from _batches(rows(), _NAMES, _TYPES)

    def finish(batches):
        names = ["__id", "n_words", "n_removed", "kept_sha256", *(["kept_text"] * with_text)]
        for _, ids, data, offsets, places in unpacked(batches):
            words = Words(data, offsets)
            n = len(words.starts)
            change = np.bincount(places, minlength=n + 1) - np.bincount(np.minimum(places + window, n), minlength=n + 1)
            keep = np.cumsum(change)[:n] <= 0
            raw, first, out = data.tobytes(), words.first.tolist(), []
            for d in range(len(offsets) - 1):
                mine = keep[first[d]:first[d + 1]]
                split = raw[offsets[d]:offsets[d + 1]].split()
                removed = len(mine) - int(mine.sum())
                text = b" ".join(compress(split, mine) if removed else split)
                out.append((len(mine), removed, hashlib.sha256(text).hexdigest(), *([text.decode("utf-8")] * with_text)))
            cols = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([ids, *cols], names=names)

    def shared_places(sent: DataFrame) -> DataFrame:
        met = sent.repartition(buckets, "bucket").mapInArrow(_meet, "block long, places binary")
        return met.groupBy("block").agg(F.collect_list("places").alias("found"))

    blocks = stored(narrow.mapInArrow(pack_blocks, f"block long, ids array<{kind}>, sizes binary, texts binary"), "passage-blocks", "uncompressed")
    shared = shared_places(blocks.mapInArrow(send_anchors, _SENT))
    repeated = shared_places(blocks.join(shared, "block").mapInArrow(send_windows, _SENT))
    done = blocks.join(repeated, "block", "left").mapInArrow(
        finish, f"__id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    return done.withColumnRenamed("__id", id_col)
