"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document.
The counts of vote patterns over all documents (at most 3 ** labellers rows)
feed expectation-maximisation, which estimates the share of good documents and
each labeller's accuracies without any true label. The posterior of a pattern
is a soft label; a bounded, hash-chosen sample of documents with their soft
labels trains a linear scorer over hashed character-shape trigrams, which then
scores every whole document.

Defined results: null and empty texts have score 0 and are rejected (nothing
to keep); word length is in code points, over words in scripts that put spaces
between words, and not judged where those are the smaller part; texts of any length are scored whole; repeated rows score equally;
an empty table gives an empty result; a corpus that is all of one kind trains
a constant scorer and then the posterior alone decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_batches
from scorelake.llm.textblock import ASCII_SPACE, NOT_SPACE, U64, Block, row_of

#: The bound of the fit: documents in the training sample of the linear scorer.
SAMPLE = 6_000
DIMENSIONS = 1 << 12
KEEP_SCORE = 0.5
GOOD, BAD, ABSTAIN = 1, -1, 0

# Byte shapes: letters (and all non-ASCII bytes) by case, digits, spaces, else the byte itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")
_SHAPE[ASCII_SPACE] = ord(" ")
_LETTER = (_SHAPE == ord("a")) | (_SHAPE == ord("A"))
_PLAIN = _LETTER | (_SHAPE == ord("0")) | (_SHAPE == ord(" ")) | np.isin(
    np.arange(256), np.frombuffer(b".,;:'\"?()-", np.uint8))

# First two UTF-8 bytes of characters in scripts without spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer,
# Tai Le to Khmer symbols, kana, Han (also extensions and full width).
_SPACELESS = np.zeros(1 << 16, bool)
for _low, _high in ((0xE0B8, 0xE0BF), (0xE180, 0xE181), (0xE19E, 0xE19F), (0xE1A5, 0xE1A7), (0xE380, 0xE383),
                    (0xE387, 0xE387), (0xE390, 0xE9BF), (0xEFA4, 0xEFAB), (0xEFBC, 0xEFBE), (0xF0A0, 0xF0BF)):
    _SPACELESS[_low:_high + 1] = True

#: name, feature, good up to (or from), bad from (or up to): the votes, on fixed bounds.
LABELLERS = (
    ("symbols", "symbol_share", 0.02, 0.06),
    ("capitals", "capital_share", 0.15, 0.35),
    ("shouting", "shouts_per_word", 0.02, 0.15),
    ("odd_words", "odd_word_share", 0.05, 0.25),
    ("bars", "bars_per_word", 0.01, 0.15),
    ("letters", "non_letter_share", 0.12, 0.25),
    ("same_lines", "same_line_share", 0.15, 0.5),
    ("word_length", "word_length_off", 3.0, 6.0),
    ("same_words", "same_word_share", 0.05, 0.3),
    ("echoes", "echo_share", 0.15, 0.45),
)
#: Shares are taken of at least so many characters or words: in a short text, one odd thing is no pattern.
LEAST_CHARS, LEAST_WORDS = 200, 30
#: Labellers see one kind of junk each and seldom raise false alarms: what the model may at most believe of a
#: bad vote on a good document, and at least of a good vote on a bad one. Else rare kinds of junk count as good.
FALSE_BAD, FALSE_GOOD = 0.002, 0.7
#: How far back a word is compared with earlier ones.
LAGS = 4


def features(block: Block) -> dict[str, np.ndarray]:
    """Per row the numbers that the labellers look at (0 where a row has no words)."""
    data, off = block.bytes, block.offsets
    hashes, starts, ends, first = block.word_hashes(NOT_SPACE)
    words = np.maximum(np.diff(first), LEAST_WORDS)
    lag = word_lags(hashes, first)

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag)))
        return total[off[1:]] - total[off[:-1]]

    visible = count(~ASCII_SPACE[data])
    letters = count(_LETTER[data])
    others = visible - letters - count(_SHAPE[data] == ord("0"))
    odd = ~_PLAIN[data]
    odd_total = np.concatenate(([0], np.cumsum(odd)))
    odd_word = (odd_total[ends] - odd_total[starts]) > 0
    rows = row_of(first)
    length, spaced = _word_length(data, starts, ends, rows, block.rows)
    same = np.zeros(block.rows)
    line_end = data == 0x0A
    many = np.flatnonzero(count(line_end) >= 3)
    for r in many.tolist():
        lines = [x for x in data[off[r]:off[r + 1]].tobytes().split(b"\n") if x.strip()]
        same[r] = 1 - len(set(lines)) / max(len(lines), 1)
    return {
        "symbol_share": count(odd) / np.maximum(visible, LEAST_CHARS),
        "capital_share": count(_SHAPE[data] == ord("A")) / np.maximum(letters, LEAST_CHARS),
        "shouts_per_word": count(data == ord("!")) / words,
        "odd_word_share": np.bincount(rows[odd_word], minlength=block.rows) / words,
        "bars_per_word": count(data == ord("|")) / words,
        "non_letter_share": others / np.maximum(visible, LEAST_CHARS),
        "same_line_share": same,
        "word_length_off": np.abs(length - 5.5) * np.minimum(1, spaced / LEAST_WORDS),
        "same_word_share": np.bincount(rows[lag == 1], minlength=block.rows) / words,
        "echo_share": np.bincount(rows[lag > 0], minlength=block.rows) / words,
        "words": np.diff(first),
    }


def _word_length(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int):
    """Per row (mean code points, number) of the words without characters of scripts without spaces; the mean
    is NaN, which no labeller votes on, where these words hold less than half of the code points."""
    point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    pair = np.zeros(len(data), np.uint16)
    pair[:-1] = (data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]
    dense = np.concatenate(([0], np.cumsum(_SPACELESS[pair])))
    points, apart = point[ends] - point[starts], dense[ends] == dense[starts]
    spaced = np.bincount(rows[apart], minlength=n)
    total = np.bincount(rows[apart], points[apart], n)
    length = total / np.maximum(spaced, 1)
    length[2 * total < np.bincount(rows, points, n)] = np.nan
    return length, spaced


def word_lags(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many words back the same word last stood in its row (0: not among the last LAGS)."""
    out = np.zeros(len(hashes), np.int64)
    place = np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))
    for lag in range(LAGS, 0, -1):
        same = np.flatnonzero(hashes[lag:] == hashes[:-lag]) + lag
        out[same[place[same] >= lag]] = lag
    return out


def votes(block: Block) -> np.ndarray:
    """rows x labellers of GOOD, BAD or ABSTAIN; a row without words is BAD throughout."""
    have = features(block)
    out = np.zeros((block.rows, len(LABELLERS)), np.int8)
    for j, (_, name, good, bad) in enumerate(LABELLERS):
        out[:, j] = np.where(have[name] <= good, GOOD, np.where(have[name] >= bad, BAD, ABSTAIN))
    out[have["words"] == 0] = BAD
    return out


def pattern(vote: np.ndarray) -> np.ndarray:
    """Votes of a row as one number in base 3."""
    return (vote.astype(np.int64) + 1) @ (3 ** np.arange(vote.shape[1], dtype=np.int64))


def unpattern(number: np.ndarray, labellers: int) -> np.ndarray:
    return (number[:, None] // 3 ** np.arange(labellers) % 3 - 1).astype(np.int8)


@dataclass
class LabelModel:
    """Share of good documents, and P(vote | class) of each labeller; rows of ``table``: bad, good."""

    prior: float
    table: np.ndarray  # class x labeller x vote (-1, 0, 1)

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        index = vote.astype(np.int64) + 1
        log = np.stack([np.log(self.table[c][np.arange(vote.shape[1]), index]).sum(1) for c in (0, 1)])
        log += np.log([[1 - self.prior], [self.prior]])
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))


def _bound(table: np.ndarray, vote: int, share: np.ndarray) -> None:
    """Set the share of one vote of each labeller and scale its other votes, so a row stays a distribution."""
    rest = np.maximum(1 - table[:, vote], 1e-12)
    scaled = table * ((1 - share) / rest)[:, None]
    scaled[:, vote] = share
    table[:] = scaled


def fit_labels(vote: np.ndarray, weight: np.ndarray, rounds: int = 100,
               false_bad: float = FALSE_BAD, false_good: float = FALSE_GOOD) -> LabelModel:
    """Expectation-maximisation over vote patterns with their counts, from the number of bad votes."""
    p = np.array([0.97, 0.5, 0.05])[np.minimum((vote == BAD).sum(1), 2)]
    model = LabelModel(0.5, np.full((2, vote.shape[1], 3), 1 / 3))
    for _ in range(rounds):
        total = weight.sum()
        model.prior = float(np.clip((weight * p).sum() / max(total, 1), 1e-3, 1 - 1e-3))
        for c, mass in ((0, weight * (1 - p)), (1, weight * p)):
            for v in (-1, 0, 1):
                model.table[c, :, v + 1] = ((vote == v) * mass[:, None]).sum(0) + 1.0
            model.table[c] /= model.table[c].sum(1, keepdims=True)
        _bound(model.table[1], 0, np.minimum(model.table[1, :, 0], false_bad))
        _bound(model.table[0], 2, np.maximum(model.table[0, :, 2], false_good))
        new = model.posterior(vote)
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return model


def shape_dims(block: Block):
    """(dimension of each feature, its row): hashed shape trigrams and word lags of a batch."""
    shape = _SHAPE[block.bytes].astype(np.uint32)
    code = (shape[:-2] << np.uint32(16)) | (shape[1:-1] << np.uint32(8)) | shape[2:]
    hashes, _, _, first = block.word_hashes(NOT_SPACE)
    lag = word_lags(hashes, first).astype(np.uint32) + np.uint32(1 << 24)
    dim = _hashed(code)
    at = np.arange(len(dim))
    end = np.repeat(block.offsets[1:], np.diff(block.offsets))[:len(dim)]
    inside = at + 3 <= end
    row = np.repeat(np.arange(block.rows), np.diff(block.offsets))[:len(dim)]
    return np.concatenate((dim[inside], _hashed(lag))), np.concatenate((row[inside], row_of(first)))


def _shape_counts(block: Block):
    """(row * DIMENSIONS + dimension, its count) in order, and where each row begins and the last one ends."""
    dim, row = shape_dims(block)
    pairs, c = np.unique(row * DIMENSIONS + dim, return_counts=True)
    return pairs, c, np.searchsorted(pairs, np.arange(block.rows + 1) * DIMENSIONS)


def _hashed(code: np.ndarray) -> np.ndarray:
    return ((code.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(52)).astype(np.int64) % DIMENSIONS


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, block: Block) -> np.ndarray:
        dim, row = shape_dims(block)
        n = np.bincount(row, minlength=block.rows)
        raw = np.bincount(row, self.weights[dim], block.rows) / np.maximum(n, 1) + self.bias
        out = 1 / (1 + np.exp(-np.clip(raw, -50, 50)))
        out[np.diff(block.words(NOT_SPACE)[2]) == 0] = 0.0
        return out


def fit_scorer(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400) -> Scorer:
    """Weighted logistic regression on soft labels, by full gradients with momentum.

    Columns are scaled to unit spread for the fit (``x`` is overwritten) and the scale is folded into the weights."""
    share = (weight / weight.sum()).astype(np.float32)
    mean = share @ x
    z = np.subtract(x, mean, out=x)  # in place: the sample is held once
    spread = np.zeros_like(mean)
    for at in range(0, len(z), 256):
        spread += share[at:at + 256] @ z[at:at + 256] ** 2
    rate = 0.5 / max(1.0, float((spread / (np.sqrt(spread) + 1e-4) ** 2).sum()) / 50)
    spread = np.sqrt(spread) + np.float32(1e-4)
    z /= spread
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    vw, vb = np.zeros_like(w), 0.0
    for _ in range(rounds):
        err = share * (1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - y).astype(np.float32)
        vw = 0.9 * vw - rate * (z.T @ err + 1e-4 * w)
        vb = 0.9 * vb - rate * float(err.sum())
        w, b = w + vw, b + vb
    real = w / spread
    return Scorer(real.astype(np.float64), float(b - (mean.astype(np.float64) * real).sum()))


def train(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> tuple[LabelModel, Scorer]:
    """Both models. Pattern counts cover every document; the scorer's sample holds about half of each kind."""
    spark = df.sparkSession
    text = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        number, n = np.unique(pattern(votes(Block(batch.column(0)))), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(number), pa.array(n)], ["pattern", "n"])

    seen = map_batches(text, count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    numbers = np.array(sorted(r["pattern"] for r in seen), np.int64)
    n = np.array([r["n"] for r in sorted(seen, key=lambda r: r["pattern"])], np.float64)
    if not len(numbers):
        return LabelModel(0.5, np.full((2, len(LABELLERS), 3), 1 / 3)), Scorer(np.zeros(DIMENSIONS), 0.0)
    patterns = unpattern(numbers, len(LABELLERS))
    model = fit_labels(patterns, n)
    good = model.posterior(patterns) >= 0.5
    share = {c: min(1.0, sample / 2 / max(n[good == c].sum(), 1)) for c in (True, False)}
    sent = spark.sparkContext.broadcast(model)

    def pick(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        block = Block(batch.column(0))
        soft = sent.value.posterior(votes(block))
        part = np.where(soft >= 0.5, share[True], share[False])
        uniform = (np.asarray(batch.column(1)) % (1 << 30)) / float(1 << 30)
        keep = np.flatnonzero(uniform < part)
        pairs, c, edge = _shape_counts(Block(batch.column(0).take(pa.array(keep))))
        rows = [{"dims": (pairs[edge[i]:edge[i + 1]] - i * DIMENSIONS).tolist(),
                 "n": c[edge[i]:edge[i + 1]].tolist(), "soft": float(soft[r]), "weight": 1 / float(part[r]),
                 "h": batch.column(1)[r].as_py()} for i, r in enumerate(keep.tolist())]
        return pa.RecordBatch.from_pylist(rows, pa.schema([
            ("dims", pa.list_(pa.int32())), ("n", pa.list_(pa.int32())), ("soft", pa.float64()),
            ("weight", pa.float64()), ("h", pa.int64())]))

    hashed = text.withColumn("h", F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 30)))
    picked = map_batches(hashed, pick, "dims array<int>, n array<int>, soft double, weight double, h long").toArrow()
    picked = picked.take(np.argsort(np.asarray(picked["h"]), kind="stable")).combine_chunks()
    dims, c = (np.asarray(picked[k].combine_chunks().flatten()) for k in ("dims", "n"))
    row = np.repeat(np.arange(len(picked)), np.asarray(pa.compute.list_value_length(picked["dims"])))
    x = np.zeros((len(picked), DIMENSIONS), np.float32)
    x[row, dims] = c / np.maximum(np.bincount(row, c, len(picked)), 1)[row]
    return model, fit_scorer(x, np.asarray(picked["soft"]), np.asarray(picked["weight"]))


def classify(df: DataFrame, models: tuple[LabelModel, Scorer], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score (the scorer's chance of good), weak_label (posterior of the votes),
    votes (one character a labeller: g, b or -), keep."""
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sent = df.sparkSession.sparkContext.broadcast(models)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, scorer = sent.value
        block = Block(batch.column(1))
        vote, score = votes(block), scorer.score(block)
        marks = ["".join("b-g"[v + 1] for v in row) for row in vote.tolist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score), pa.array(model.posterior(vote)), pa.array(marks, pa.string()),
             pa.array(score >= KEEP_SCORE)], ["doc_id", "score", "weak_label", "votes", "keep"])

    kind = src.schema[0].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, score double, weak_label double, votes string, keep boolean")


def keep_good(df: DataFrame, models: tuple[LabelModel, Scorer], text_col: str = "text") -> DataFrame:
    """All columns of the rows that the scorer keeps."""
    sent = df.sparkSession.sparkContext.broadcast(models[1])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text_col))
        return batch.filter(pa.array(sent.value.score(Block(texts)) >= KEEP_SCORE))

    return map_batches(df, run, df.schema)
