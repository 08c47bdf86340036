"""Audit of how far the sources of a language diverge in their words.

Terms are runs of letters (non-ASCII counts as a letter), A-Z lower-cased. A
language keeps the terms that at least ``LEAST_DOCS`` of its documents hold.
With V of them, a group (language and source) or a whole language that holds
``count`` of a term and N of all kept ones has the share
``p = 1 + floor(UNIT * (count + 2) / (N + 2 * V))``, and two shares differ by
``f = floor((p - q)**2 / (p + q))``. All of this is integer arithmetic: decimals
in Spark, long division by digits in numpy.

*Counting.* Tasks count terms per group in Arrow (exactly, on the strings) and
merge while a bounded number of rows is held; Spark adds them up by group and
term, then by language and term.

*Terms of a group (count-cell ranking).* f depends on a term only through
(count in the group, count in the language). So terms are grouped into such
cells, f is evaluated once a cell, cells of equal value are merged, and a cell's
first rank is one more than the terms in all better ones. Only the cells that
reach rank ``RANKS`` are expanded into terms, in UTF-8 order. The ranking
windows keep the best few of a group before they shuffle.

*Pairs of sources.* Every pair of a language's sources is compared over all its
kept terms. Terms are dealt by (language, pair of source tiles, salt); a task
turns a few hundred terms at a time into a terms x sources matrix of shares and
adds up f for the pairs of its tiles, so what it holds and emits is bounded by
the tile, not by terms, and no pair of a term's sources is ever a row. A
language with up to ``TILE`` sources has one tile.

Defined results: null text, language or source counts as empty; groups and
languages without kept terms still compare (value 0, V = 0); a language with one
source has no pairs; repeated rows count each; ties rank by the item's UTF-8
bytes; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.store import map_arrow, parts, stored
from scorelake.llm.textblock import LETTERS, LOWER, Block, row_of

LEAST_DOCS = 10
UNIT = 1_000_000_000
RANKS = 10
#: Sources of a tile, terms of a salt, terms of a matrix, and rows that a counting task holds.
TILE, SALT_TERMS, MATRIX_TERMS, HELD = 512, 256, 512, 1 << 19
_COUNTS = "lang string, source string, term string, n long, docs long"


# -------------------------------------------------------------------- counting
def words_of(block: Block) -> tuple[pa.Array, np.ndarray]:
    """(the lower-cased words of all rows as an Arrow array, the row of each)."""
    starts, ends, first = block.words(LETTERS)
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    data = LOWER[block.bytes[LETTERS[block.bytes]]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    return words, row_of(first)


def batch_counts(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of the rows (lang, source, text) of a batch."""
    words, row = words_of(Block(batch.column(2)))
    coded = words.dictionary_encode()
    width = max(len(coded.dictionary), 1)
    pair, n = np.unique(row * width + np.asarray(coded.indices), return_counts=True)
    keys = [batch.column(i).dictionary_encode() for i in (0, 1)]
    codes = [np.asarray(k.indices).astype(np.int64) for k in keys]
    group = codes[0] * max(len(keys[1].dictionary), 1) + codes[1]
    cell, at = np.unique(group[pair // width] * width + pair % width, return_inverse=True)
    group, term = cell // width, cell % width
    low = max(len(keys[1].dictionary), 1)
    return pa.table({"lang": keys[0].dictionary.take(pa.array(group // low)),
                     "source": keys[1].dictionary.take(pa.array(group % low)),
                     "term": coded.dictionary.take(pa.array(term)).cast(pa.string()),
                     "n": np.bincount(at, n, len(cell)).astype(np.int64),
                     "docs": np.bincount(at, minlength=len(cell)).astype(np.int64)})


def _merged(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate(
        [("n", "sum"), ("docs", "sum")])
    return both.rename_columns(["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for part in parts(batch, 4000):
            held.append(batch_counts(part))
            if sum(t.num_rows for t in held) > 2 * HELD:
                held = [_merged(held)]
                if held[0].num_rows > HELD:
                    yield from held.pop().to_batches(1 << 16)
    if held:
        yield from _merged(held).to_batches(1 << 16)


def _plain(df: DataFrame, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a)
                       for c, a in ((lang_col, "lang"), (source_col, "source"))), *more)


def kept_terms(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total (occurrences in the language) and held (source, n): one row a kept term."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    seen = map_arrow(_plain(df, lang_col, source_col, text), _count, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return seen.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held")
    ).where(F.col("docs") >= least_docs).drop("docs")


def group_sizes(df: DataFrame, kept: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, size (N of the group), lang_size (N of the language), terms (V): one row a group."""
    groups = _plain(df, lang_col, source_col).distinct()
    sizes = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(
        F.sum("h.n").alias("size"))
    langs = kept.groupBy("lang").agg(F.sum("total").alias("lang_size"), F.count(F.lit(1)).alias("terms"))
    return groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(
        0, ["size", "lang_size", "terms"])


def share(count: str, size: str) -> Column:
    """p of a count among ``size`` occurrences, exactly, as a long."""
    return F.expr(f"1 + (CAST({count} + 2 AS DECIMAL(20, 0)) * CAST({UNIT} AS DECIMAL(10, 0))) "
                  f"DIV CAST({size} + 2 * terms AS DECIMAL(20, 0))")


# ------------------------------------------------------------ terms of a group
def term_ranks(kept: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    """lang, source, item, value, rank: the terms with which a group stands out most from its language."""
    rows = kept.select("lang", "term", "total", F.explode("held").alias("h")).select(
        "lang", "term", "total", "h.source", "h.n")
    cells = rows.groupBy("lang", "source", "n", "total").agg(F.count(F.lit(1)).alias("terms_in"))
    cells = cells.join(groups, ["lang", "source"]).withColumn("p", share("n", "size")).withColumn(
        "q", share("total", "lang_size")).where("p > q").withColumn("value", F.expr("((p - q) * (p - q)) DIV (p + q)"))
    cells = stored(cells.select("lang", "source", "n", "total", "value", "terms_in"), "cells")
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    best = cells.groupBy("lang", "source", "value").agg(F.sum("terms_in").alias("terms_in")).withColumn(
        "place", F.dense_rank().over(by)).where(F.col("place") <= ranks)
    better = F.sum("terms_in").over(by.rowsBetween(Window.unboundedPreceding, -1))
    best = best.withColumn("before", F.coalesce(better, F.lit(0))).where(F.col("before") < ranks)
    open_cells = cells.join(best.select("lang", "source", "value", "before"), ["lang", "source", "value"])
    found = rows.join(open_cells, ["lang", "source", "n", "total"]).withColumn("place", F.row_number().over(
        Window.partitionBy("lang", "source", "value").orderBy("term"))).where(F.col("place") <= ranks)
    return found.withColumn("rank", (F.col("before") + F.col("place")).cast("int")).where(
        F.col("rank") <= ranks).select("lang", "source", F.col("term").alias("item"), "value", "rank")


# ------------------------------------------------------------- pairs of sources
def shares(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """p as in ``share`` (size: N + 2 V), by long division in three digits of 1,000: exact below 9e15."""
    rest, out = count + 2, np.zeros(np.broadcast(count, size).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // size
        rest = rest % size
    return out + 1


class _Sums:
    """f added up for the pairs of two tiles of one language."""

    def __init__(self, key: tuple, sources: pa.Array, sizes: np.ndarray, terms: int, tile: int):
        self.key, self.sources = key, sources
        self.size = sizes + 2 * terms
        self.left, self.right = (np.arange(k * tile, min((k + 1) * tile, len(sources))) for k in key[1:])
        self.total = np.zeros((len(self.left), len(self.right)), np.int64)

    def add(self, held: pa.ListArray) -> None:
        flat = held.flatten()
        row = np.repeat(np.arange(len(held)), np.diff(np.asarray(held.offsets)))
        at = np.asarray(pc.index_in(flat.field("source"), self.sources))
        count = np.asarray(flat.field("n"))
        sides = []
        for side in (self.left, self.right):
            mine = (at >= side[0]) & (at <= side[-1])
            matrix = np.zeros((len(held), len(side)), np.int64)
            matrix[row[mine], at[mine] - side[0]] = count[mine]
            sides.append(shares(matrix, self.size[side]))
        for i in range(len(self.left)):
            p, q = sides[0][:, i:i + 1], sides[1]
            self.total[i] += ((p - q) ** 2 // (p + q)).sum(0)

    def rows(self) -> Iterator[pa.RecordBatch]:
        a, b = (x.ravel() for x in np.meshgrid(self.left, self.right, indexing="ij"))
        value = self.total.ravel()
        other = a != b
        a, b, value = a[other], b[other], value[other]
        if self.key[1] != self.key[2]:
            a, b, value = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((value, value))
        if len(a):
            names = (self.sources.take(pa.array(x)) for x in (a, b))
            yield pa.RecordBatch.from_arrays([pa.array([self.key[0]] * len(a), pa.string()), *names, pa.array(value)],
                                             ["lang", "source", "item", "value"])


def _compare(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, i, j, salt, terms): a salt's first row names the sources, with their N in ``n`` and V
    in ``terms``; the others are terms (``terms`` is null)."""
    sums: _Sums | None = None
    for batch in batches:
        heads = np.flatnonzero(np.asarray(batch.column("terms").is_valid()))
        edges = [0, *heads.tolist(), batch.num_rows]
        for s, e in zip(edges[:-1], edges[1:]):
            if s in heads:
                key = tuple(batch.column(k)[s].as_py() for k in ("lang", "i", "j"))
                if sums is None or sums.key != key:
                    if sums is not None:
                        yield from sums.rows()
                    named = batch.column("held").slice(s, 1).flatten()
                    sums = _Sums(key, named.field("source"), np.asarray(named.field("n")),
                                 batch.column("terms")[s].as_py(), tile)
                s += 1
            for at in range(s, e, MATRIX_TERMS):
                sums.add(batch.column("held").slice(at, min(MATRIX_TERMS, e - at)))
    if sums is not None:
        yield from sums.rows()


def pair_ranks(kept: DataFrame, groups: DataFrame, tile: int = TILE) -> DataFrame:
    """lang, source, item (another source), value (f over all kept terms), rank."""
    n = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    langs = groups.groupBy("lang").agg(
        F.first("terms").alias("v"), F.array_sort(F.collect_list(F.struct("source", F.col("size").alias("n")))).alias("held"))
    last = F.floor((F.size("held") - 1) / tile).cast("int")
    langs = stored(langs.withColumn("last", last).withColumn(
        "salts", F.greatest(F.lit(1), F.ceil(F.col("v") / SALT_TERMS))), "languages")

    def dealt(df: DataFrame) -> DataFrame:
        tiles = df.withColumn("i", F.explode(F.sequence(F.lit(0), "last"))).withColumn(
            "j", F.explode(F.sequence("i", "last")))
        return tiles.select("lang", "i", "j", "salt", "terms", "held")

    heads = dealt(langs.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).withColumn(
        "terms", F.col("v")))
    salt = F.pmod(F.xxhash64("term"), F.col("salts"))
    terms = dealt(kept.select("lang", "term", "held").join(langs.drop("held"), "lang").withColumn("salt", salt).withColumn(
        "terms", F.lit(None).cast("long")))
    keys = ["lang", "i", "j", "salt"]
    rows = heads.union(terms).repartition(n, *keys).sortWithinPartitions(*keys, F.col("terms").desc_nulls_last())
    found = map_arrow(rows, partial(_compare, tile=tile), "lang string, source string, item string, value long")
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return found.withColumn("rank", rank)


def audit(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, tile: int = TILE) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    kept = stored(kept_terms(df, lang_col, source_col, text_col, least_docs), "kept")
    groups = stored(group_sizes(df, kept, lang_col, source_col), "groups")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair_ranks(kept, groups, tile).withColumn("part", F.lit("pair")).select(*columns).unionByName(
        term_ranks(kept, groups).withColumn("part", F.lit("term")).select(*columns))
