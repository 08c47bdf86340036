"""Toxicity scores from a factorization machine over hashed terms.

A document's terms are its distinct ASCII-lower-cased letter runs (non-ASCII
counts as a letter) and the first 4, 5 and 6 bytes of longer ones, so that
inflected forms share a term; each is a 64-bit hash. From a bounded sample of
labelled texts Spark counts, per term, the toxic and clean texts that hold it;
the terms whose log odds stand out most become the machine's inputs. Besides a
weight per term, each term has a short vector: the product of two vectors is
the weight of the pair, so an insult next to a mention of a group can count for
more (or a quoted one for less) than the sum of both. Full gradients with
adaptive steps fit it; weights shrink towards zero, so terms that merely come
along with toxic ones fade.

Scoring maps whole texts in Arrow batches against a broadcast table of at most
``TERMS`` hashes, weights and vectors: no shuffle, nothing of a text is skipped.

Bounds of the fit: ``SAMPLE`` texts (a third of them toxic where there are
enough; chosen by a hash of the id, then of the text) and ``TERMS`` terms.

Defined results: null and empty texts, and texts with none of the terms, get
the score of the bias alone; a label other than 0 and 1, or null, and a null id
teach nothing; a document with labels of both kinds counts as toxic; equal
texts in the sample count once (toxic if any of them is); without labels of both kinds
the score is the share of toxic labels (0 without any); an empty table gives an
empty result; repeated rows score equally; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_batches, stored
from scorelake.llm.textblock import BYTE_BASE, LETTERS, LOWER, U64, Block, mix64, row_of, slices

#: Bounds of the fit: labelled texts in the sample, and terms of the machine.
SAMPLE = 12_000
TERMS = 1_024
#: Length of a term's vector.
FACTORS = 6
#: Bytes of the leading parts that count as terms of their own.
STEMS = (4, 5, 6)
#: A term needs log odds so many standard errors from the corpus's to be an input.
STANDS_OUT = 2.0
SHRINK_WEIGHT, SHRINK_VECTOR = 2e-4, 2e-3
THRESHOLD = 0.5


def term_rows(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(row, term): the terms of each row, repeats included."""
    low = LOWER[block.bytes]
    starts, ends, first = block.words(LETTERS)
    row = row_of(first)
    rows, terms = [row], [slices(low, starts, ends, BYTE_BASE)]
    for k in STEMS:
        at = np.flatnonzero(ends - starts > k)
        stems = slices(low, starts[at], starts[at] + k, BYTE_BASE)
        terms.append(mix64(stems + U64(k)))
        rows.append(row[at])
    return np.concatenate(rows), np.concatenate(terms)


def distinct_pairs(row: np.ndarray, term: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, number below width) once, by row."""
    pair = np.unique(row.astype(np.int64) * width + term)
    return pair // width, pair % width


@dataclass
class Machine:
    """Inputs (sorted term hashes), bias, weight of each term, vector of each term."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def inputs(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(row, input) of the machine's terms that each row holds, each once."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, term = term_rows(block)
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        hit = self.terms[at] == term
        return distinct_pairs(row[hit], at[hit], len(self.terms))

    def raw(self, row: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
        """bias + sum of weights + sum over pairs of the products of their vectors."""
        out = self.bias + np.bincount(row, self.weights[at], rows)
        for v in self.vectors.T:
            out += 0.5 * (np.bincount(row, v[at], rows) ** 2 - np.bincount(row, v[at] ** 2, rows))
        return out

    def score(self, block: Block) -> np.ndarray:
        row, at = self.inputs(block)
        return _sigmoid(self.raw(row, at, block.rows))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300, factors: int = FACTORS,
        seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, weights, vectors) of the machine that best explains labels ``y`` of the 0/1 rows ``x``."""
    rnd = np.random.default_rng(seed)
    share = (weight / weight.sum()).astype(np.float32)
    base = float(np.clip((share * y).sum(), 1e-3, 1 - 1e-3))
    n = x.shape[1]
    params = [np.array([np.log(base / (1 - base))], np.float32), np.zeros(n, np.float32),
              rnd.normal(0, 0.05, (n, factors)).astype(np.float32)]
    shrink = (0.0, SHRINK_WEIGHT, SHRINK_VECTOR)
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    for step in range(1, rounds + 1):
        b, w, v = params
        total = x @ v
        raw = b + x @ w + 0.5 * ((total ** 2).sum(1) - x @ (v ** 2).sum(1))
        err = share * (_sigmoid(raw) - y).astype(np.float32)
        mass = x.T @ err
        grads = [err.sum(keepdims=True), mass, x.T @ (err[:, None] * total) - mass[:, None] * v]
        for p, g, m, s, c in zip(params, grads, first, second, shrink):
            g = g + c * p
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return float(params[0][0]), params[1].astype(np.float64), params[2].astype(np.float64)


def sample(docs: DataFrame, labels: DataFrame, teaches: Column | None = None, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "toxic", size: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """((h, toxic, text) of at most ``size`` labelled texts, stored; documents of each label).

    ``teaches`` is a condition on the labels' id column; only ids are joined before the choice, and the
    chosen ids (a bounded number) are broadcast."""
    named = labels.select(F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("toxic"),
                          *([teaches.alias("teaches")] if teaches is not None else []))
    if teaches is not None:
        named = named.where("teaches")
    named = named.where(F.col("toxic").isin(0, 1) & F.col("doc").isNotNull()).groupBy("doc").agg(
        F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in named.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    room = {1: min(counts.get(1, 0), size // 3)}
    room[0] = size - room[1]
    share = F.when(F.col("toxic") == 1, room[1] / max(counts.get(1, 0), 1)).otherwise(
        room[0] / max(counts.get(0, 0), 1))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc")), F.lit(1 << 30)) / float(1 << 30)
    chosen = named.where(draw < share)
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc").select(
        F.xxhash64(F.lit("text"), "text").alias("h"), "toxic", "text")
    once = found.groupBy("h").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    return stored(once.orderBy("h").limit(2 * size), "labelled"), counts


def chosen_terms(labelled: DataFrame, n: dict[int, int], most: int = TERMS) -> np.ndarray:
    """The terms whose log odds of toxic against clean texts stand out most."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic = np.asarray(batch.column(1))
        row, term = term_rows(Block(batch.column(2)))
        order = np.lexsort((row, term))
        row, term = row[order], term[order]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
        row, term = row[new], term[new]
        key, at = np.unique(term, return_inverse=True)
        bad = np.bincount(at, toxic[row] == 1, len(key)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(key)) - bad)],
            ["term", "bad", "good"])

    seen = map_batches(labelled, count, "term long, bad long, good long").groupBy("term").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad, good = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.log(bad / (n[1] + 1 - bad)) - F.log(good / (n[0] + 1 - good))
    stands = F.abs(odds) / F.sqrt(1 / bad + 1 / good)
    best = seen.where(stands >= STANDS_OUT).orderBy(stands.desc(), "term").limit(most).select("term").toArrow()
    return np.sort(np.asarray(best["term"].combine_chunks()).view(U64))


def train(docs: DataFrame, labels: DataFrame, teaches: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Machine:
    """A machine from the labelled documents (``teaches``: a condition on the labels' rows)."""
    labelled, counts = sample(docs, labels, teaches, id_col, text_col, label_col)
    n = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    none = np.zeros(0, U64)
    if not (n[0] and n[1]):
        return Machine(none, 30.0 if n[1] else -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    blank = Machine(chosen_terms(labelled, n), 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    sent = labelled.sparkSession.sparkContext.broadcast(blank)

    def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, at = sent.value.inputs(Block(batch.column(2)))
        edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
        held = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(at, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), held], ["h", "toxic", "at"])

    rows = map_batches(labelled, pick, "h long, toxic int, at array<int>").toArrow()
    rows = rows.take(np.argsort(np.asarray(rows["h"]), kind="stable")).combine_chunks()
    held = rows["at"].combine_chunks()
    x = np.zeros((len(rows), len(blank.terms)), np.float32)
    x[np.repeat(np.arange(len(rows)), np.diff(np.asarray(held.offsets))), np.asarray(held.flatten())] = 1
    y = np.asarray(rows["toxic"]).astype(np.float64)
    weight = np.where(y == 1, counts[1] / n[1], counts[0] / n[0])
    return Machine(blank.terms, *fit(x, y, weight))


def classify(df: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns of ``carry``, score, predicted (1 from ``THRESHOLD`` on), n_terms (inputs held)."""
    src = df.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"), *carry)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:])
    sent = df.sparkSession.sparkContext.broadcast(machine)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, at = sent.value.inputs(Block(batch.column(0)))
        score = _sigmoid(sent.value.raw(row, at, batch.num_rows))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)),
             pa.array(np.bincount(row, minlength=batch.num_rows))],
            [*batch.schema.names[1:], "score", "predicted", "n_terms"])

    return map_batches(src, run, f"{kinds}, score double, predicted int, n_terms long")
