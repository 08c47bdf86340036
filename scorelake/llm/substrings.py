"""Removal of repeated substrings with a sparse suffix array.

Each byte covered by a ``LENGTH``-byte string that also starts earlier (smaller
id, or same row and earlier start) goes. A suffix array of every position
would move many times the input, so only anchored suffixes are sorted: every
``LENGTH``-byte window names as its anchor the ``GRAM``-byte gram of smallest
hash that it holds, so equal windows have equal anchors at equal offsets.
Consecutive windows with one anchor form a block (anchor suffix with its left
context).

1. Blocks are spread over tasks by ranges of the hash of their leading gram
   (uniform, so even splitters need no sample) and sorted there by gram,
   content and position. Equal blocks: all but the first go whole.
2. Grams with several different blocks are compared window by window: the
   first block of each content travels with its bytes to its gram, the windows
   are sorted, and all but the first of each go. Grams with more than
   ``HOT_BLOCKS`` contents are dealt by window instead of by gram, so no gram
   meets in one task.
3. Removed intervals meet their row; what is left is concatenated.

Repeats inside a batch are settled there first, so a passage that very many
documents share reaches a task once per batch. Equal content is equality of
64-bit hashes together with equal anchors.

Defined results: null texts count as empty; texts under ``LENGTH`` bytes keep
all; null ids come first. Rows with one id (or null ids) and different texts are
rows of their own, in the order of a 64-bit hash of the text: each loses what
repeats in itself, and only that. Rows equal in id and text are one place in the
order, so a repeated row removes nothing from its twin.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_arrow, map_batches, stored
from scorelake.llm.textblock import BYTE_BASE, U64, Block, inverse, mix64, powers

LENGTH = 100
GRAM = 50
HOT_BLOCKS = 2_000
LOWEST = -(1 << 63)


class Hashes:
    """Hashes of any slice of a byte array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * powers(BYTE_BASE, n), out=self.prefix[1:])
        self.back = powers(inverse(BYTE_BASE), n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[end] - self.prefix[start]) * self.back[start] + (end - start).astype(U64))

    def grams(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes from each position."""
        raw = self.prefix[width:] - self.prefix[:-width]
        return mix64(raw * self.back[:len(raw)] + U64(width))


def blocks(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(gram hash, block hash, row, start in the row, bytes) of the blocks of a batch."""
    hashes = Hashes(data)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    grams = hashes.grams(gram)
    low, have, width = grams, 1, length - gram + 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    end = np.repeat(offsets[1:], np.diff(offsets))[:len(low)]
    at = np.flatnonzero(np.arange(len(low)) + length <= end)
    if not len(at):
        return none, none, none, none, none
    low, grams = low[at], grams[at]
    row = np.searchsorted(offsets, at, side="right") - 1
    new = np.ones(len(at), bool)
    # a window takes the leftmost of equal grams, so a window that starts with its anchor is the anchor's last
    new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1]) | (grams[:-1] == low[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    start, stop = at[first], at[last] + length
    return (low[first].view(np.int64), hashes(start, stop).view(np.int64), row[first],
            start - offsets[row[first]], stop - start)


def merged(doc: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The intervals of each row (id and text hash) with overlapping and touching ones joined."""
    order = np.lexsort((start, key, doc))
    doc, key, start, end = doc[order], key[order], start[order], end[order]
    if not len(doc):
        return doc, key, start, end
    group = np.concatenate(([0], np.cumsum((doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))))
    shift = group * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + shift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], key[at], start[at], reach[last] - shift[at]


def _not_first(*keys: np.ndarray, place: tuple[np.ndarray, np.ndarray, np.ndarray]):
    """(order, is first, is later): rows sorted by keys and place (id, text hash, start); later rows are in a place of
    their own behind the first of their key (a row at the very place of the first is neither)."""
    order = np.lexsort((*reversed(place), *reversed(keys)))
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        k = k[order]
        same &= k[1:] == k[:-1]
    head = np.concatenate((np.ones(min(len(order), 1), bool), ~same))
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = np.zeros(len(order), bool)
    for x in place:
        x = x[order]
        later |= x != x[lead]
    return order, head, later


def _longs(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns.values()], list(columns))


def _intervals(doc, key, start, end) -> pa.RecordBatch:
    return _longs(doc=doc, key=key, start=start, end=end)


_INTERVALS = "doc long, key long, start long, end long"


def _block_rows(docs: DataFrame, length: int, gram: int, repeats: bool) -> DataFrame:
    """First blocks of each batch, or (``repeats``) the intervals that repeat blocks of their batch."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        block = Block(batch.column(2))
        a, b, row, start, size = blocks(block.bytes, block.offsets, length, gram)
        doc, key = (np.asarray(batch.column(i))[row] for i in (0, 1))
        order, head, later = _not_first(a, b, place=(doc, key, start))
        if repeats:
            at = order[later]
            return _intervals(*merged(doc[at], key[at], start[at], start[at] + size[at]))
        at = order[head]
        return _longs(gram=a[at], block=b[at], doc=doc[at], key=key[at], start=start[at], size=size[at])

    schema = _INTERVALS if repeats else "gram long, block long, doc long, key long, start long, size long"
    return map_batches(docs, run, schema)


def _whole_runs(batches: Iterator[pa.RecordBatch], fn) -> Iterator[pa.RecordBatch]:
    """``fn`` on batches cut at changes of the first column (the frame is sorted by it)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = np.asarray(batch.column(0))
        cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if held and (cut or held[0].column(0)[0].as_py() != int(key[0])):
            full = held + ([batch.slice(0, cut)] if cut else [])
            yield from fn(pa.Table.from_batches(full).combine_chunks().to_batches()[0])
            held = []
        elif cut:
            yield from fn(batch.slice(0, cut))
        held.append(batch.slice(cut))
    if held:
        yield from fn(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _sorted_runs(frame: DataFrame, key: str, fn, schema: str, *order: str) -> DataFrame:
    n = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frame.repartition(n, key).sortWithinPartitions(key, *order)
    return map_arrow(dealt, lambda batches: _whole_runs(batches, fn), schema)


def _settle(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Whole repeats as intervals (contents 0); first blocks of grams with several contents (their number)."""
    gram, block, doc, key, start, size = (np.asarray(c) for c in batch.columns)
    order, head, later = _not_first(gram, block, place=(doc, key, start))
    gram, doc, key, start, size = gram[order], doc[order], key[order], start[order], size[order]
    edge = np.concatenate(([0], np.flatnonzero(gram[1:] != gram[:-1]) + 1))
    contents = np.repeat(np.add.reduceat(head.astype(np.int64), edge), np.diff(np.append(edge, len(gram))))
    keep = later | (head & (contents > 1))
    number = np.where(later, 0, contents)
    yield _longs(doc=doc[keep], key=key[keep], start=start[keep], end=(start + size)[keep], gram=gram[keep],
                 contents=number[keep])


def _window_repeats(*content: np.ndarray, place: tuple[np.ndarray, np.ndarray, np.ndarray], length: int):
    """Intervals of windows that repeat an earlier one with the same content."""
    order, _, later = _not_first(*content, place=place)
    doc, key, start = (x[order[later]] for x in place)
    return merged(doc, key, start, start + length)


def _windows(sizes: np.ndarray, length: int):
    """(block, offset) of each window of blocks of these sizes."""
    n = sizes - length + 1
    which = np.repeat(np.arange(len(sizes)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def _compare(length: int):
    """Windows of the blocks of each gram, on the bytes that came along."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        gram, doc, key, start = (np.asarray(batch.column(i)) for i in range(4))
        data = batch.column(4).to_pylist()
        sizes = np.array([len(x) for x in data], np.int64)
        flat = np.frombuffer(b"".join(data), np.uint8)
        which, offset = _windows(sizes, length)
        at = (np.cumsum(sizes) - sizes)[which] + offset
        h = Hashes(flat)(at, at + length)
        yield _intervals(*_window_repeats(gram[which], h, place=(doc[which], key[which], start[which] + offset),
                                          length=length))

    return run


def _requested(length: int, hot: bool, repeats: bool = False):
    """Of each row the requested blocks with their bytes, or (``hot``) the hash of each window;
    with ``repeats`` the intervals that the batch's own windows settle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        codec = zstandard.ZstdDecompressor()
        docs, keys, starts, grams, data = [], [], [], [], []
        for doc, key, packed, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            text = codec.decompress(packed)
            for w in wanted:
                docs.append(doc)
                keys.append(key)
                starts.append(w["start"])
                grams.append(w["gram"])
                data.append(text[w["start"]:w["end"]])
        if not docs:
            return None
        if not hot:
            return pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.int64()), pa.array(docs, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(starts, pa.int64()), pa.array(data, pa.binary())], ["gram", "doc", "key", "start", "data"])
        sizes = np.array([len(x) for x in data], np.int64)
        which, offset = _windows(sizes, length)
        at = (np.cumsum(sizes) - sizes)[which] + offset
        h = Hashes(np.frombuffer(b"".join(data), np.uint8))(at, at + length).view(np.int64)
        doc, key = np.array(docs, np.int64)[which], np.array(keys, np.int64)[which]
        start = np.array(starts, np.int64)[which] + offset
        if repeats:
            return _intervals(*_window_repeats(h, place=(doc, key, start), length=length))
        order, head, _ = _not_first(h, place=(doc, key, start))
        at = order[head]
        return _longs(window=h[at], doc=doc[at], key=key[at], start=start[at])

    return run


def repeated_intervals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                       hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """(doc, key, start, end) in bytes: intervals whose union is what repeats. ``docs``: doc long, key long
    (a hash of the text), text."""
    settled = stored(_sorted_runs(_block_rows(docs, length, gram, False), "gram", _settle,
                                  "doc long, key long, start long, end long, gram long, contents long",
                                  "block", "doc", "key", "start"), "settled")
    whole = settled.where("contents = 0").select("doc", "key", "start", "end")
    wanted = settled.where("contents > 0").groupBy("doc", "key").agg(
        F.collect_list(F.when(F.col("contents") <= hot_blocks, F.struct("start", "end", "gram"))).alias("some"),
        F.collect_list(F.when(F.col("contents") > hot_blocks, F.struct("start", "end", "gram"))).alias("hot"))
    wanted = stored(map_batches(docs, _pack, _PACKED).join(wanted, ["doc", "key"])
                    .select("doc", "key", "packed", "some", "hot"), "requested")
    by_gram = map_batches(wanted.where(F.size("some") > 0).select("doc", "key", "packed", "some"),
                          _requested(length, False), "gram long, doc long, key long, start long, data binary")
    parts = _sorted_runs(by_gram, "gram", _compare(length), _INTERVALS)
    busy = wanted.where(F.size("hot") > 0).select("doc", "key", "packed", "hot")
    windows = map_batches(busy, _requested(length, True), "window long, doc long, key long, start long")
    parts2 = _sorted_runs(windows, "window", lambda b: _later_windows(b, length), _INTERVALS, "doc", "key", "start")
    local = map_batches(busy, _requested(length, True, True), _INTERVALS)
    return _block_rows(docs, length, gram, True).union(whole).union(parts).union(parts2).union(local)


def _later_windows(batch: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    h, *place = (np.asarray(c) for c in batch.columns)
    yield _intervals(*_window_repeats(h, place=tuple(place), length=length))


_PACKED = "doc long, key long, packed binary"


def _pack(batch: pa.RecordBatch) -> pa.RecordBatch:
    codec = zstandard.ZstdCompressor(level=3)
    packed = pa.array([codec.compress(t.encode()) for t in batch.column(2).to_pylist()], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["doc", "key", "packed"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), kept_sha256."""
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("doc"),
                     F.xxhash64(text).alias("key"), text.alias("text"))
    found = repeated_intervals(docs, length, gram, hot_blocks).groupBy("doc", "key").agg(
        F.collect_list(F.struct("start", "end")).alias("cuts"))
    rows = map_batches(docs, _pack, _PACKED).join(found, ["doc", "key"], "left")
    out = map_batches(rows.select("doc", "packed", "cuts"), _cut,
                      "doc long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string", 200)
    return out.select(F.when(F.col("doc") != LOWEST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed",
                      "n_spans", "kept", "kept_sha256")


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    codec = zstandard.ZstdDecompressor()
    out = []
    for doc, packed, cuts in zip(*(c.to_pylist() for c in batch.columns)):
        text = codec.decompress(packed)
        kept, spans = text, 0
        if cuts:
            start, end = (np.array([c[k] for c in cuts], np.int64) for k in ("start", "end"))
            none = np.zeros(len(start), np.int64)
            _, _, start, end = merged(none, none, start, end)
            spans = len(start)
            kept = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(text)]))
        out.append({"doc": doc, "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": spans,
                    "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest()})
    return pa.RecordBatch.from_pylist(out, pa.schema([
        ("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept", pa.binary()), ("kept_sha256", pa.string())]))
