"""Document fingerprints from closed syncmers.

A k-mer of bytes is an anchor if the smallest of its s-mers (by hash) is its
first or its last. Whether a k-mer is an anchor depends on that k-mer alone,
so an edit elsewhere moves no anchor. The fingerprint keeps the ``KEEP``
anchors of smallest hash with their byte positions; likeness is the bottom-k
Jaccard estimate in which only anchors in the same order on both sides match
(longest increasing run of positions), so text that is merely reshuffled
counts less than text that stands in place.

``neighbours`` compares every document with the next one by descending id (the
last one's next is the first). Documents are routed to id ranges, sorted there
and streamed, so no task or driver holds more than a batch; the first document
of each range is copied to the end of the range before it.

Defined results: a null text counts as empty; an empty text has the empty
fingerprint; likeness of two empty fingerprints is 1, of an empty and another
0; a text shorter than k bytes is one anchor; null ids come last; equal ids
are ordered by text hash; a table of one row is its own neighbour.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_batches
from scorelake.llm.textblock import BYTE_BASE, U64, Block, inverse, mix64, powers

K, S, KEEP = 16, 9, 64
LOWEST = -(1 << 63)


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each position."""
    prefix = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(BYTE_BASE, len(data)), out=prefix[1:])
    return mix64((prefix[n:] - prefix[:-n]) * powers(inverse(BYTE_BASE), len(data) - n + 1))


def anchors(block: Block, k: int = K, s: int = S):
    """(rows, byte positions in the row, hashes) of the closed syncmers of a batch."""
    data = block.bytes
    none = np.zeros(0, np.int64)
    if len(data) < k:
        return none, none, np.zeros(0, U64)
    small = _grams(data, s)
    width = k - s + 1
    low, have = small, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    at = np.flatnonzero((small[:len(low)] == low) | (small[width - 1:] == low))
    row = np.searchsorted(block.offsets, at, side="right") - 1
    inside = at + k <= block.offsets[row + 1]
    at, row = at[inside], row[inside]
    return row, at - block.offsets[row], _grams(data, k)[at]


def sketches(texts: list[str], keep: int = KEEP) -> list[list[tuple[int, int]]]:
    """Per text its ``keep`` smallest (hash, first position) anchors, by hash."""
    block = Block(pa.array(texts, pa.large_string()))
    row, pos, h = anchors(block)
    h = h >> U64(32)
    count = np.bincount(row, minlength=block.rows)
    # far fewer to sort: a hash bound that about four times as many anchors pass as are kept
    bound = np.minimum(4 * keep / np.maximum(count, 1), 1.0)
    some = h < (bound * float(1 << 32))[row]
    out: list[list[tuple[int, int]]] = []
    picked = _smallest(row[some], pos[some], h[some], block.rows, keep)
    sizes = np.diff(block.offsets)
    for r in range(block.rows):
        mine = picked[r]
        if len(mine) < keep and bound[r] < 1:
            own = row == r
            mine = _smallest(np.zeros(int(own.sum()), np.int64), pos[own], h[own], 1, keep)[0]
        if not mine and sizes[r]:
            whole = block.bytes[block.offsets[r]:block.offsets[r + 1]].tobytes()
            mine = [(int.from_bytes(hashlib.md5(whole).digest()[:4], "big"), 0)]
        out.append(mine)
    return out


def _smallest(row, pos, h, rows: int, keep: int) -> list[list[tuple[int, int]]]:
    order = np.lexsort((pos, h, row))
    row, pos, h = row[order], pos[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, pos, h = row[new], pos[new], h[new]
    edge = np.searchsorted(row, np.arange(rows + 1))
    return [list(zip(h[a:min(b, a + keep)].tolist(), pos[a:min(b, a + keep)].tolist()))
            for a, b in zip(edge[:-1], edge[1:])]


def written(sketch: list[tuple[int, int]]) -> str:
    return ";".join(f"{h:08x}:{p:x}" for h, p in sketch)


def likeness(a: list[tuple[int, int]], b: list[tuple[int, int]], keep: int = KEEP) -> float:
    if a == b:
        return 1.0
    first, second = dict(a), dict(b)
    union = sorted(first.keys() | second.keys())[:keep]
    shared = sorted((first[h], second[h]) for h in union if h in first and h in second)
    tails: list[int] = []
    for _, p in shared:
        i = bisect_left(tails, p)
        tails[i:i + 1] = [p]
    return len(tails) / len(union) if union else 1.0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and fingerprint (``hash:position`` in hex, by hash)."""
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [written(s) for s in sketches(batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())],
                                          ["doc_id", "fingerprint"])

    return map_batches(src, run, f"doc_id {src.schema[0].dataType.simpleString()}, fingerprint string", 500)


def edited_text(text: str, other: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the other text."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               ranges: int | None = None) -> DataFrame:
    """Per row its fingerprint, that of its edited text, and the likeness to it and to the next row's."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * partitions
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(LOWEST)).alias("k"), F.xxhash64("text").alias("h"), "text")
    probs = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = keys.agg(F.percentile_approx("k", probs, 100 * ranges)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    # the first row of each range, and the range before it that needs a copy of that row
    def tops(batch: pa.RecordBatch, seen: dict) -> pa.RecordBatch:
        k, h = (np.asarray(c) for c in batch.columns)
        bucket = np.searchsorted(cuts, k)
        order = np.lexsort((h, k, bucket))
        last = np.append(np.flatnonzero(np.diff(bucket[order])), len(order) - 1)
        rows = order[last]
        return pa.RecordBatch.from_arrays([pa.array(bucket[rows]), pa.array(k[rows]), pa.array(h[rows])],
                                          ["bucket", "k", "h"])

    first = map_batches(keys.select("k", "h"), tops, "bucket long, k long, h long", 100_000, dict)
    first = {r["bucket"]: (r["m"]["k"], r["m"]["h"]) for r in
             first.groupBy("bucket").agg(F.max(F.struct("k", "h")).alias("m")).collect()}
    full = sorted(first)
    copied_to = {b: full[(i + 1) % len(full)] for i, b in enumerate(full)}

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        k, h = np.asarray(batch.column(1)), np.asarray(batch.column(2))
        bucket = np.searchsorted(cuts, k)
        copy = np.array([i for i in range(len(k)) if first[int(bucket[i])] == (k[i], h[i])], np.int64)
        take = pa.array(np.concatenate((np.arange(len(k)), copy)))
        to = np.concatenate((bucket, np.array([copied_to[int(bucket[i])] for i in copy], np.int64)))
        tail = np.arange(len(take)) >= len(k)
        return pa.RecordBatch.from_arrays(
            [pa.array(to, pa.int64()), pa.array(tail), *[c.take(take) for c in batch.columns]],
            ["bucket", "tail", *batch.schema.names])

    routed = map_batches(keys, route, "bucket long, tail boolean, doc_id long, k long, h long, text string")
    routed = routed.repartition(partitions, "bucket").sortWithinPartitions(
        F.col("bucket"), F.col("tail"), F.col("k").desc(), F.col("h").desc())
    out = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
    return map_batches(routed.select("bucket", "tail", "doc_id", "text"), _stream, out, 500, dict)


def _stream(batch: pa.RecordBatch, held: dict) -> pa.RecordBatch | None:
    """Pair each row with the next one of its range; the last row of a batch waits for the next batch."""
    rows = list(zip(*(c.to_pylist() for c in batch.columns)))
    if "row" in held:
        rows.insert(0, held["row"])
    held["row"] = rows[-1]
    pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
    if not pairs:
        return None
    own = sketches([a[3] for a, _ in pairs] + [pairs[-1][1][3]])
    follow = {id(a): s for (a, _), s in zip(pairs, own)}
    missing = [b for _, b in pairs[:-1] if id(b) not in follow]
    follow.update(zip(map(id, missing), sketches([b[3] for b in missing])))
    follow.setdefault(id(pairs[-1][1]), own[-1])
    edits = [edited_text(a[3], b[3]) for a, b in pairs]
    after = sketches(edits)
    cols = [[a[2] for a, _ in pairs], [len(a[3]) for a, _ in pairs],
            [hashlib.sha256(e.encode()).hexdigest() for e in edits],
            [written(follow[id(a)]) for a, _ in pairs], [written(e) for e in after],
            [likeness(follow[id(a)], e) for (a, _), e in zip(pairs, after)],
            [likeness(follow[id(a)], follow[id(b)]) for a, b in pairs]]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, kinds)],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
