"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Benchmark windows (``width`` consecutive words; a shorter item is one window)
go to the executors as a hash set, in blocks of a bounded number of windows:
a benchmark of any size is handled in as many passes as it needs, with what
earlier passes found kept on the row. A document's windows are hashed in one
vectorised pass, filtered by a bitmap, looked up, and each hit is verified
against the window's own words before it counts.

Defined results: null texts have no words; an item without words never
matches; items without text are none; an item without id is searched like any
other (its hits count and contaminate), is left out of the list of items and sets
``unnamed``, as all items without id are one more item;
items that share a window are all reported; repeated rows give equal
rows; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_batches, stored
from scorelake.llm.textblock import ALNUM, LOWER, U64, Block, row_of, window_hashes

WIDTH = 10
#: Windows of one broadcast block: about 30 MB of hashes, words and item ids.
BLOCK_WINDOWS = 1 << 18
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _words(lowered: bytes) -> bytes:
    return b" ".join(_WORD.findall(lowered))


def _batch_windows(block: Block, widths: list[int], width: int, whole_items: bool):
    """Yield (hash, first word, width) arrays and word arrays of a batch."""
    hashes, starts, ends, first = block.word_hashes(ALNUM)
    out = []
    for n in widths:
        h, pos = window_hashes(hashes, first, n)
        if whole_items and n < width:
            rows = row_of(first)[pos]
            keep = np.diff(first)[rows] == n
            h, pos = h[keep], pos[keep]
        out.append((h, pos, n))
    return out, starts, ends, first


def benchmark_windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """Distinct (hash, width, words, item) of all windows of all items."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        block = Block(batch.column(1))
        found, starts, ends, first = _batch_windows(block, list(range(1, width + 1)), width, True)
        low, rows = LOWER[block.bytes].tobytes(), row_of(first)
        ids, out = batch.column(0).to_pylist(), []
        for hashes, pos, n in found:
            for h, p in zip(hashes.view(np.int64).tolist(), pos.tolist()):
                out.append({"hash": h, "width": n, "words": _words(low[starts[p]:ends[p + n - 1]]),
                            "item": ids[rows[p]]})
        return pa.RecordBatch.from_pylist(out, pa.schema([("hash", pa.int64()), ("width", pa.int32()),
                                                          ("words", pa.binary()), ("item", pa.string())]))

    src = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string").alias("__text")).where(
        F.col("__text").isNotNull())
    return map_batches(src, run, "hash long, width int, words binary, item string").distinct()


class _Set:
    """One block of windows, ready for look-up (built once per task from the broadcast rows)."""

    def __init__(self, rows):
        self.words: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for h, _, words, item in rows:
            self.words[h][bytes(words)].append(item)
        self.widths = sorted({r[1] for r in rows})
        self.sorted = np.sort(np.array(list(self.words), np.int64).view(U64))
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[self.sorted >> U64(44)] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.bitmap[hashes >> U64(44)])
        some = hashes[at]
        k = np.minimum(np.searchsorted(self.sorted, some), len(self.sorted) - 1)
        return at[self.sorted[k] == some]


def _mark(block: Block, windows: _Set):
    """(is a hit word, items of each row, starts, ends, first) of a batch."""
    found, starts, ends, first = _batch_windows(block, windows.widths, 0, False)
    low, rows = LOWER[block.bytes].tobytes(), row_of(first)
    cover = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for hashes, pos, n in found:
        for i in windows.hits(hashes).tolist():
            p = int(pos[i])
            same = windows.words[int(hashes[i:i + 1].view(np.int64)[0])]
            words = _words(low[starts[p]:ends[p + n - 1]])
            if words in same:
                cover[p] += 1
                cover[p + n] -= 1
                items[int(rows[p])].update(same[words])
    return np.cumsum(cover[:-1]) > 0, items, starts, ends, first


def scan(df: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
         text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per row: doc_id, n_words, ``hit_words`` (runs of hit word numbers), ``spans`` (the same
    runs in code points), n_hit, ``items`` (sorted strings), ``unnamed`` (an item without id hit)."""
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("__text"))
    return _marked(src, items, width, block_windows).drop("__text")


def _marked(src: DataFrame, items: DataFrame, width: int, block_windows: int) -> DataFrame:
    windows = stored(benchmark_windows(items, width), "benchmark")
    blocks = max(1, math.ceil(windows.count() / block_windows))
    run_type = "array<struct<start:long,end:long>>"
    out = src.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast(run_type).alias("hit_words"),
                     F.array().cast(run_type).alias("spans"), F.lit(0).cast("long").alias("n_hit"),
                     F.array().cast("array<string>").alias("items"), F.lit(False).alias("unnamed"))
    for k in range(blocks):
        part = [tuple(r) for r in windows.where(F.pmod("hash", F.lit(blocks)) == k)
                .select("hash", "width", "words", "item").collect()]
        sent = src.sparkSession.sparkContext.broadcast(part)
        out = map_batches(out, _scan_block, out.schema, state=lambda sent=sent: _Set(sent.value))
        if k + 1 < blocks:
            out = stored(out, "decontaminate")
    return out


def _scan_block(batch: pa.RecordBatch, windows: _Set) -> pa.RecordBatch:
    at = {n: i for i, n in enumerate(batch.schema.names)}
    block = Block(batch.column(at["__text"]))
    hit, items, starts, ends, first = _mark(block, windows)
    before, had = batch.column(at["hit_words"]).to_pylist(), batch.column(at["items"]).to_pylist()
    unnamed = batch.column(at["unnamed"]).to_pylist()
    for row, runs in enumerate(before):
        for r in runs:
            hit[first[row] + r["start"]:first[row] + r["end"]] = True
    number = np.concatenate(([0], np.cumsum(hit)))
    points = None
    n_hit, words, spans, names = number[first[1:]] - number[first[:-1]], [], [], []
    for row in range(block.rows):
        runs, cuts = [], []
        if n_hit[row]:
            if points is None:
                points = np.concatenate(([0], np.cumsum((block.bytes & 0xC0) != 0x80)))
            a, b = first[row], first[row + 1]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].view(np.int8), [0]))))
            zero = points[block.offsets[row]]
            for s, e in edge.reshape(-1, 2).tolist():
                runs.append({"start": s, "end": e})
                cuts.append({"start": int(points[starts[a + s]] - zero),
                             "end": int(points[ends[a + e - 1]] - zero)})
        words.append(runs)
        spans.append(cuts)
        unnamed[row] |= None in items.get(row, set())
        names.append(sorted((items.get(row, set()) | set(had[row])) - {None}))
    new = {"n_words": pa.array(np.diff(first), pa.int64()), "hit_words": pa.array(words, pa.list_(_SPAN)),
           "spans": pa.array(spans, pa.list_(_SPAN)), "n_hit": pa.array(n_hit, pa.int64()),
           "items": pa.array(names, pa.list_(pa.string())), "unnamed": pa.array(unnamed, pa.bool_())}
    return pa.RecordBatch.from_arrays([new.get(n, batch.column(i)) for n, i in at.items()], list(at))


def decontaminate(df: DataFrame, items: DataFrame, mode: str = "documents", width: int = WIDTH,
                  text_col: str = "text") -> DataFrame:
    """All columns of the clean rows; a hit row goes (``documents``) or loses its hit spans (``spans``)."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    rest = [c for c in df.columns if c != text_col]
    src = df.select(F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in rest]).alias("__row"),
                    F.col(f"`{text_col}`").cast("string").alias("__text"))
    marked = _marked(src, items, width, BLOCK_WINDOWS)
    text = F.col("__text")
    if mode == "documents":
        marked = marked.where("n_hit = 0")
    else:
        # what lies between the spans: from the end of one to the start of the next
        ends = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
        starts = F.concat(F.col("spans.start"), F.array(F.length(text).cast("long")))
        pieces = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda z: F.substring(
            text, z["a"].cast("int") + 1, (z["b"] - z["a"]).cast("int")))
        text = F.when(F.size("spans") > 0, F.array_join(pieces, "")).otherwise(text)
    return marked.select(*[text.alias(c) if c == text_col else F.col(f"__row.`{c}`").alias(c)
                           for c in df.columns])
