"""Language-model scoring by context-tree weighting over bytes.

A text is scored as its lower-cased words joined by single spaces and closed
by one zero byte (a bijection with its token sequence). Each byte is coded as
eight binary decisions; every (byte context, bit prefix) is a node with a
Krichevsky-Trofimov estimate, and context-tree weighting mixes the estimates
of the contexts of 0 to ``DEPTH`` bytes. Every context that occurs is a node.
Counts cover every byte of every training text: (context, byte) grams are
counted per task and summed by shuffle; the grams of held-out texts stand among
them with no count, as a node without counts changes no estimate.

The grams are dealt by the last ``TOP`` + 1 bytes of their context, so that a
task holds whole subtrees and goes through them a slice at a time. A first pass
brings the evidence of the subtrees up to the contexts of ``TOP`` bytes, the
driver mixes those (at most 256 ** ``TOP`` * 255 nodes at any corpus size), and
a second pass mixes down to the log-probability of every gram.

Scoring looks up the gram at each byte. The most frequent grams, about
``FREQUENT`` of them, are broadcast with their log-probability; the others are
joined by shuffle.

The unigram base needs the count of every token. Tokens that hold at least
1 / ``FREQUENT`` of all training tokens (at most ``FREQUENT`` of them) are
broadcast; the others are joined by shuffle.

Defined results: null texts count as empty (one end token, one zero byte);
repeated rows are learned from as often as they occur; without training rows
all counts are zero and the model is uniform over bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_arrow, map_batches, map_counts, stored
from scorelake.llm.textblock import LOWER, NOT_SPACE, U64, Block, row_of

DEPTH = 6
#: Contexts up to so many bytes are mixed on the driver, longer ones in subtrees.
TOP = 2
FREQUENT = 2_000_000
#: Grams that a task of the tree gets, and that it works on at once (or one subtree, if that has more).
TASK_GRAMS = 1 << 18
SLICE_GRAMS = 1 << 16
END_TOKEN = np.int64(0x656E64)


def coded(block: Block):
    """(bytes, begin, size): row r in normal form is ``size[r]`` bytes from ``begin[r]``, its closing
    zero among them; DEPTH zeros stand before each row."""
    starts, _, first = block.words(NOT_SPACE)
    data = LOWER[block.bytes]
    keep = NOT_SPACE[data]
    later = np.ones(len(starts), bool)
    later[first[:-1][np.diff(first) > 0]] = False
    space = starts[later] - 1
    keep[space] = True
    data[space] = 0x20
    before = np.concatenate(([0], np.cumsum(keep)))[block.offsets]
    size = np.diff(before)
    begin = DEPTH + before[:-1] + DEPTH * np.arange(block.rows)
    out = np.zeros(DEPTH + int(before[-1]) + DEPTH * block.rows, np.uint8)
    out[np.repeat(begin - before[:-1], size) + np.arange(before[-1])] = data[keep]
    return out, begin, size + 1


def grams(block: Block):
    """(code, row) of each coded byte: its context from the newest byte to the oldest, then the byte itself."""
    data, begin, size = coded(block)
    n = len(data) - DEPTH
    code = np.zeros(n, np.int64)
    for d in (*range(1, DEPTH + 1), 0):
        code = (code << 8) | data[DEPTH - d:DEPTH - d + n]
    row = np.repeat(np.arange(block.rows), size)
    return code[np.repeat(begin - DEPTH - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(len(row))], row


def token_hashes(block: Block):
    """(hashes, row of each) of the words and of one end token per row."""
    h, _, _, first = block.word_hashes(NOT_SPACE)
    return (np.concatenate((h.view(np.int64), np.full(block.rows, END_TOKEN))),
            np.concatenate((row_of(first), np.arange(block.rows))))


# ----------------------------------------------------------------- the tree
def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5, by Stirling's series after eight steps of the recurrence."""
    steps = np.ones_like(x)
    for i in range(8):
        steps *= x + i
    y = x + 8
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / y ** 2) / y ** 2) / y ** 2) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(steps)


def _log_kt(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Log of the KT probability of a sequence with these counts."""
    return _log_gamma(zero + 0.5) + _log_gamma(one + 0.5) - math.log(math.pi) - _log_gamma(zero + one + 1.0)


def _bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte counts (n x 256) as counts of zeros and ones at the 255 bit nodes."""
    zero, one = [], []
    for level in range(8):
        split = counts.reshape(len(counts), 1 << level, 2, -1).sum(3)
        zero.append(split[:, :, 0])
        one.append(split[:, :, 1])
    return np.concatenate(zero, 1).astype(float), np.concatenate(one, 1).astype(float)


def _kt_one(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (one + 0.5) / (zero + one + 1.0)


def _byte_logs(p_one: np.ndarray) -> np.ndarray:
    """Chances of a one at the 255 bit nodes as log-probabilities of the 256 bytes."""
    log = np.zeros((len(p_one), 1))
    for level in range(8):
        p = np.clip(p_one[:, (1 << level) - 1:(2 << level) - 1], 1e-12, 1 - 1e-12)
        log = np.stack((log + np.log1p(-p), log + np.log(p)), 2).reshape(len(p_one), -1)
    return log


@dataclass
class Tree:
    """``child[node, byte]``: the node with one more byte of context (-1: none);
    ``logs[node, byte]``: log-probability of the byte where ``node`` is the longest context."""

    child: np.ndarray
    logs: np.ndarray

    def score(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(natural-log probability, coded bytes) of each row."""
        data, begin, size = coded(block)
        n = len(data) - DEPTH
        if n <= 0:
            return np.zeros(block.rows), size

        def back(d: int) -> np.ndarray:
            return data[DEPTH - d:DEPTH - d + n]

        # the first two steps by one table, the others where the context goes on
        node = self.start[back(1).astype(np.int64) | (back(2).astype(np.int64) << 8)]
        flat = self.child.reshape(-1)
        alive = np.flatnonzero(self.deep[node])
        for d in range(3, DEPTH + 1):
            step = flat[node[alive] * 256 + back(d)[alive]]
            on = step >= 0
            alive = alive[on]
            node[alive] = step[on]
        logs = self.logs.reshape(-1)[node * 256 + data[DEPTH:]]
        edge = np.stack((begin, begin + size), 1).reshape(-1) - DEPTH
        total = np.concatenate(([0.0], np.cumsum(logs, dtype=np.float64)))[edge]
        return total[1::2] - total[::2], size

    def __post_init__(self):
        """``start[b1 | b2 << 8]``: the node after two steps; ``deep``: nodes of two bytes of context."""
        one = np.where(self.child[0] >= 0, self.child[0], 0)
        two = np.where((self.child[0] >= 0)[None, :], self.child[one].T, -1)
        self.start = np.where(two >= 0, two, one[None, :]).reshape(-1).astype(np.int64)
        self.deep = np.zeros(len(self.child), bool)
        self.deep[two[two >= 0]] = True


def build_tree(levels: list[dict[int, dict[int, int]]]) -> Tree:
    """``levels[d]``: context of d bytes (newest in the low byte) -> byte -> count."""
    levels = [lv for lv in levels if lv]
    if not levels:
        return Tree(np.full((1, 256), -1, np.int32), np.full((1, 256), -math.log(256), np.float32))
    contexts = [sorted(lv) for lv in levels]
    start = np.concatenate(([0], np.cumsum([len(c) for c in contexts])))
    index = [{c: i for i, c in enumerate(cs)} for cs in contexts]
    counts = []
    for lv, cs in zip(levels, contexts):
        table = np.zeros((len(cs), 256), np.int64)
        for i, c in enumerate(cs):
            table[i, list(lv[c])] = list(lv[c].values())
        counts.append(table)
    child = np.full((start[-1], 256), -1, np.int32)
    parent = [np.zeros(0, np.int64)]
    for d in range(1, len(levels)):
        up = np.array([index[d - 1][c & ((1 << 8 * (d - 1)) - 1)] for c in contexts[d]])
        child[start[d - 1] + up, np.array([c >> 8 * (d - 1) for c in contexts[d]])] = start[d] + np.arange(len(up))
        parent.append(up)
    # bottom up: evidence of each node, and the share of it that stops there
    stop, rest, below = [None] * len(levels), [None] * len(levels), None
    for d in reversed(range(len(levels))):
        own = _log_kt(*_bits(counts[d]))
        if d == len(levels) - 1:
            below, stop[d], rest[d] = own, np.ones_like(own), counts[d]
            continue
        left = counts[d].copy()
        np.subtract.at(left, parent[d + 1], counts[d + 1])
        deeper = _log_kt(*_bits(left))
        np.add.at(deeper, parent[d + 1], below)
        both = np.logaddexp(own, deeper) + math.log(0.5)
        stop[d], rest[d], below = np.exp(own + math.log(0.5) - both), left, both
    # top down: the mixture along the path to each node, then that of its pooled rest
    logs = np.empty((start[-1], 256), np.float32)
    mixed = remaining = None
    for d in range(len(levels)):
        one = _kt_one(*_bits(counts[d]))
        before = (0.0, 1.0) if d == 0 else (mixed[parent[d]], remaining[parent[d]])
        mixed = before[0] + before[1] * stop[d] * one
        remaining = before[1] * (1 - stop[d])
        final = mixed if d == len(levels) - 1 else mixed + remaining * _kt_one(*_bits(rest[d]))
        logs[start[d]:start[d + 1]] = _byte_logs(final)
    return Tree(child, logs)


def train_tree(df: DataFrame, text_col: str = "text", nodes: int | None = None) -> Tree:
    """The tree of a corpus small enough to hold it in one place; ``score`` deals it over tasks instead.

    With ``nodes``, only contexts that hold at least 1 / ``nodes`` of all bytes become nodes, and what a context's
    children leave over is pooled in one further child."""

    def tails(batch: pa.RecordBatch) -> np.ndarray:
        data, begin, size = coded(Block(batch.column(0)))
        n = len(data) - DEPTH
        code = np.zeros(n, np.int64)
        for d in range(DEPTH, -1, -1):
            code = (code << 8) | data[DEPTH - d:DEPTH - d + n]
        inside = np.zeros(n + 1, np.int8)
        inside[begin - DEPTH] += 1
        inside[begin - DEPTH + size] -= 1
        return code[np.cumsum(inside[:-1]) > 0]

    text = df.select(F.col(text_col).cast("string").alias("text"))
    counted = stored(map_counts(text, tails, "code").groupBy("code").agg(F.sum("n").alias("n")), "grams")
    total = counted.agg(F.sum("n")).first()[0] or 0
    levels: list[dict[int, dict[int, int]]] = []
    for d in range(DEPTH + 1):
        mask = (1 << 8 * (d + 1)) - 1
        tail = counted.groupBy(F.col("code").bitwiseAND(F.lit(mask)).alias("code")).agg(F.sum("n").alias("n"))
        context = F.shiftrightunsigned("code", 8)
        whole = tail.groupBy(context.alias("context")).agg(F.sum("n").alias("whole"),
                                                           F.collect_list(F.struct("code", "n")).alias("bytes"))
        kept = whole if nodes is None else whole.where(F.col("whole") * nodes >= total)
        levels.append({r["context"]: {b["code"] & 255: b["n"] for b in r["bytes"]} for r in kept.collect()})
        if not levels[-1]:
            break
    return build_tree(levels)


# ----------------------------------------------------- the whole tree, dealt
@dataclass
class Nodes:
    """The nodes of one depth; ``key``: context (newest byte first), then 1 and the bit prefix in one byte."""

    key: np.ndarray
    total: np.ndarray
    one: np.ndarray
    weight: np.ndarray  # log of the weighted evidence
    stop: np.ndarray  # share of it that stops at the node
    up: np.ndarray | None  # which node of the next depth above each belongs to


def _above(key: np.ndarray) -> np.ndarray:
    """The keys of the nodes whose context lacks the oldest byte."""
    return (key >> 16 << 8) | (key & 255)


def _climb(key: np.ndarray, total: np.ndarray, one: np.ndarray, below: np.ndarray | None, steps: int) -> list[Nodes]:
    """These nodes and those of the ``steps`` depths above; ``below``: log evidence of the children, if there are."""
    levels: list[Nodes] = []
    for step in range(steps + 1):
        own = _log_kt(total - one, one)
        weight, stop = own, np.ones_like(own)
        if below is not None:
            weight = np.logaddexp(own, below) + math.log(0.5)
            stop = np.exp(own + math.log(0.5) - weight)
        above, up = np.unique(_above(key), return_inverse=True) if step < steps else (None, None)
        levels.append(Nodes(key, total, one, weight, stop, up))
        if step < steps:
            total, one, below = (np.bincount(up, x, len(above)) for x in (total, one, weight))
            key = above
    return levels


def _mix(levels: list[Nodes], p: np.ndarray | float, mass: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """(chance of a one so far, weight left to longer contexts) at the deepest nodes, given both above the highest."""
    for i, nodes in reversed(list(enumerate(levels))):
        p = p + mass * nodes.stop * _kt_one(nodes.total - nodes.one, nodes.one)
        mass = mass * (1 - nodes.stop)
        if i:
            p, mass = p[levels[i - 1].up], mass[levels[i - 1].up]
    return p, mass


def _gram_nodes(code: np.ndarray, n: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, list[Nodes]]:
    """(node of each gram, its bit there, levels up to ``TOP`` + 1 bytes) for the bit after ``level`` bits; ``code``
    ascends."""
    prefix = code >> (8 - level)
    new = np.concatenate(([True], prefix[1:] != prefix[:-1]))
    first, node = np.flatnonzero(new), np.cumsum(new) - 1
    bit = code >> (7 - level) & 1
    key = (code[first] >> 8 << 8) | (1 << level) | ((code[first] & 255) >> (8 - level))
    return node, bit, _climb(key, np.add.reduceat(n, first), np.add.reduceat(n * bit, first), None, DEPTH - TOP - 1)


def _subtrees(batches: Iterator[pa.RecordBatch], held: int = SLICE_GRAMS) -> Iterator[pa.Table]:
    """Sorted grams in slices that end where a context of ``TOP`` + 1 bytes does."""
    waiting, size, enough = [], 0, held
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= enough:
            grams = pa.Table.from_batches(waiting)
            context = np.asarray(grams["code"]) >> 8 * (DEPTH - TOP)
            cut = int(np.searchsorted(context, context[-1]))
            if cut:
                yield grams.slice(0, cut)
            waiting, size = grams.slice(cut).to_batches(), size - cut
            enough = max(held, 2 * size)
    if size:
        yield pa.Table.from_batches(waiting)


def gram_counts(rows: DataFrame) -> DataFrame:
    """(code, n, seen): every distinct gram, how often it occurs in training texts and in all."""

    def count(held_out: bool) -> DataFrame:
        text = rows.where(F.coalesce("held_out", F.lit(True)) == held_out).select("text")
        found = map_counts(text, lambda batch: grams(Block(batch.column(0)))[0], "code")
        return found.select("code", (F.lit(0).cast("long") if held_out else F.col("n")).alias("n"),
                            F.col("n").alias("seen"))

    return count(False).union(count(True)).groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def gram_logs(counted: DataFrame) -> DataFrame:
    """(code, seen, log): the natural-log probability of each gram's byte after its context, from the whole tree."""
    spark = counted.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counted.count() // TASK_GRAMS))
    subtree = F.shiftrightunsigned("code", 8 * (DEPTH - TOP))
    dealt = counted.repartition(tasks, subtree).sortWithinPartitions("code")

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _subtrees(batches):
            code, n = np.asarray(part["code"]), np.asarray(part["n"])
            for level in range(8):
                nodes = _gram_nodes(code, n, level)[2][-1]
                key, up = np.unique(_above(nodes.key), return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *(pa.array(np.bincount(up, x, len(key)))
                                      for x in (nodes.total, nodes.one, nodes.weight))],
                    ["key", "total", "one", "below"])

    risen = map_arrow(dealt, climb, "key long, total double, one double, below double")
    top = risen.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("total", "one", "below")]).toArrow().sort_by("key")
    levels = _climb(*(np.asarray(top[c]) for c in ("key", "total", "one", "below")), TOP)
    sent = spark.sparkContext.broadcast((levels[0].key, *_mix(levels, 0.0, 1.0)))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, p, mass = sent.value
        for part in _subtrees(batches):
            code, n = np.asarray(part["code"]), np.asarray(part["n"])
            log = np.zeros(len(code))
            for level in range(8):
                node, bit, levels = _gram_nodes(code, n, level)
                at = np.searchsorted(keys, _above(levels[-1].key))
                one = np.clip(_mix(levels, p[at], mass[at])[0], 1e-12, 1 - 1e-12)
                log += np.where(bit == 1, np.log(one)[node], np.log1p(-one)[node])
            yield pa.RecordBatch.from_arrays([pa.array(code), part["seen"].combine_chunks(), pa.array(log)],
                                             ["code", "seen", "log"])

    return map_arrow(dealt, descend, "code long, seen long, log double")


# ------------------------------------------------------------------- scoring
def token_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, c): the count of every distinct token."""

    text = df.select(F.col(text_col).cast("string").alias("text"))
    tokens = map_counts(text, lambda batch: token_hashes(Block(batch.column(0)))[0], "h")
    return tokens.groupBy("h").agg(F.sum("n").alias("c"))


def _sorted(table: pa.Table, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(np.asarray(table[key]))
    return np.asarray(table[key])[order], np.asarray(table[value])[order]


def _exceeded(df: DataFrame, count: str, most: int) -> int:
    """A count that all rows exceed if there are at most ``most``, else about that many or fewer."""
    n = df.count()
    return 0 if n <= most else df.agg(F.percentile_approx(count, 1 - most / n)).first()[0]


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``known``, whether it stands there) of each key."""
    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    return at, known[at] == keys if len(known) else np.zeros(len(keys), bool)


def _lists(row: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    """The values of each row as a list."""
    ends = np.cumsum(np.bincount(row, minlength=rows))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                    pa.array(values[np.argsort(row, kind="stable")]))


def score(df: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
          frequent: int = FREQUENT) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    rows = df.select(F.col(id_col).alias("doc_id"), (~training).alias("held_out"),
                     F.col(text_col).cast("string").alias("text"))
    learn = rows.where(~F.col("held_out"))
    logs = stored(gram_logs(stored(gram_counts(rows), "grams")), "logs")
    counts = stored(token_counts(learn), "tokens")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    often = F.col("seen") > F.lit(_exceeded(logs, "seen", frequent))
    sent = df.sparkSession.sparkContext.broadcast(
        (_sorted(logs.where(often).select("code", "log").toArrow(), "code", "log"),
         _sorted(counts.where(F.col("c") * F.lit(frequent) >= F.lit(n)).toArrow(), "h", "c")))
    floor = math.log10(n + 0.5 * (v + 1))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        (codes, log_of), (known, c) = sent.value
        block = Block(batch.column(2))
        code, place = grams(block)
        once, which = np.unique(code, return_inverse=True)
        at, there = _find(codes, once)
        value = np.zeros(len(once))
        value[there] = log_of[at[there]]
        log = np.bincount(place, value[which], block.rows)
        missing = ~there[which]
        h, row = token_hashes(block)
        at, hit = _find(known, h)
        base = np.bincount(row[hit], np.log10(c[at[hit]] + 0.5) - floor, block.rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.bincount(row, minlength=block.rows)),
             pa.array(np.bincount(row[hit], minlength=block.rows)), pa.array(base, pa.float64()),
             pa.array(np.bincount(place, minlength=block.rows)), pa.array(log, pa.float64()),
             _lists(row[~hit], h[~hit], block.rows), _lists(place[missing], code[missing], block.rows)],
            ["doc_id", "held_out", "n_tokens", "common", "base", "size", "log", "rare", "rare_grams"])

    kind = rows.schema[0].dataType.simpleString()
    scored = map_batches(rows, run, f"doc_id {kind}, held_out boolean, n_tokens long, common long, base double, "
                                    "size long, log double, rare array<long>, rare_grams array<long>")
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode("rare").alias("h")).join(counts, "h", "left").groupBy("row").agg(
        F.count("c").alias("known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5) - F.lit(floor)).alias("base2"))
    rare_grams = scored.select("row", F.explode("rare_grams").alias("code")).join(
        logs.where(~often).select("code", F.col("log").alias("log2")), "code").groupBy("row").agg(
        F.sum("log2").alias("log2"))
    log = F.col("log") + F.coalesce("log2", F.lit(0.0))
    return scored.drop("rare", "rare_grams").join(rare, "row", "left").join(rare_grams, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("common") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"),
        (log / F.lit(math.log(10))).alias("score"), (-log / F.lit(math.log(2)) / F.col("size")).alias("bits_per_byte"))
