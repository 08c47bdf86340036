"""Toxicity: the machine against explicit pairs, what it learns, and odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorelake.llm import toxicity as T
from scorelake.llm.textblock import U64, Block
from tests.conftest import SMALL
from tests.llm.conftest import frame


def labels(spark, rows):
    return spark.createDataFrame([(i, y, 1) for i, y in rows], "doc_id long, toxic int, quality int")


def test_raw_score_equals_the_sum_over_pairs():
    rnd = np.random.default_rng(1)
    m = T.Machine(np.sort(rnd.integers(0, 2 ** 62, 12).astype(U64)), -0.3, rnd.normal(size=12), rnd.normal(size=(12, 4)))
    held = [[0, 3, 5, 11], [], [7], [1, 2]]
    row = np.repeat(np.arange(4), [len(h) for h in held])
    got = m.raw(row, np.array([i for h in held for i in h]), 4)
    for h, x in zip(held, got):
        want = m.bias + sum(m.weights[i] for i in h) + sum(
            m.vectors[i] @ m.vectors[j] for k, i in enumerate(h) for j in h[k + 1:])
        assert x == pytest.approx(want)


def test_pairs_are_learnt_that_no_sum_of_weights_can_hold():
    """Toxic only when exactly one of two terms is there: a linear score cannot separate that."""
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 2, (600, 6)).astype(np.float32)
    y = (x[:, 0] != x[:, 1]).astype(float)
    b, w, v = T.fit(x, y, np.ones(600), rounds=400)
    total = x @ v
    score = b + x @ w + 0.5 * ((total ** 2).sum(1) - x @ (v ** 2).sum(1))
    assert ((score > 0) == (y == 1)).mean() > 0.97


def test_terms_of_a_row():
    """Words without case, and the first 4, 5 and 6 bytes of longer ones."""
    row, term = T.term_rows(Block(pa.array(["Abcdefg x9x", None, "ABCD abcde"])))
    by = {r: set(term[row == r].tolist()) for r in (0, 1, 2)}
    assert len(by[0]) == 5 and len(by[1]) == 0 and len(by[2]) == 3  # abcdefg, abcd-, abcde-, abcdef-, x; abcd, abcde, abcd-
    assert len(by[0] & by[2]) == 1  # the stem abcd- alone: as a word abcd is another term


def corpus(spark, n=600, seed=2):
    rnd = random.Random(seed)
    plain = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}rd" for i in range(300)]
    insults = ["grobianus", "laffe", "tropf"]
    rows, marks = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(1, 300))]
        bad = rnd.random() < 0.15
        for _ in range(rnd.randint(2, 5) if bad else 0):
            words.insert(rnd.randrange(len(words) + 1), rnd.choice(insults).title() + rnd.choice(["", "en", "ische"]))
        rows.append((i, " ".join(words), "de", "s"))
        marks.append((i, int(bad)))
    return rows, marks


def test_held_out_documents_are_told_apart(spark):
    rows, marks = corpus(spark)
    docs, marked = frame(spark, rows).repartition(4), labels(spark, marks)
    machine = T.train(docs, marked, F.col("doc_id") % 2 == 0)
    got = {r.doc_id: r.predicted for r in T.classify(docs, machine).collect()}
    right = [got[i] == y for i, y in marks if i % 2]
    assert sum(right) / len(right) > 0.97


def test_odd_rows_and_labels(spark, docs, empty):
    rows, marks = corpus(spark, 200)
    rows += [(None, "laffe laffen", None, None), (3, None, None, None), (4, "", None, None), (5, "12 !?", None, None),
             (5, rows[7][1], None, None), (6, "laffe " + "lange zeile " * 60_000 + "tropf", None, None)]
    marks += [(None, 1), (3, None), (4, 2), (7, 1), (7, 0), (9999, 1)]
    docs = frame(spark, rows)
    machine = T.train(docs, labels(spark, marks))
    got = T.classify(docs, machine)
    assert got.columns == ["doc_id", "score", "predicted", "n_terms"] and got.count() == len(rows)
    assert got.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)").count() == 0
    blank = {r.score for r in got.where("n_terms = 0").collect()}
    assert len(blank) == 1  # null, empty and neutral texts: the bias alone
    assert T.classify(empty, machine).count() == 0


@pytest.mark.parametrize("marks, score", [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([(77, 1), (78, 0)], 0.0)])
def test_labels_of_one_kind_or_none(spark, marks, score):
    docs = frame(spark, [(1, "a b", None, None), (2, "c", None, None)])
    got = T.classify(docs, T.train(docs, labels(spark, marks)))
    assert [r.score for r in got.collect()] == pytest.approx([score] * 2)


def test_the_sample_is_bounded_and_the_same_on_a_rerun(spark):
    rows, marks = corpus(spark, 300)
    rows += [(1, f"x {chr(97 + i % 26)}{chr(97 + i // 26)}", None, None) for i in range(400)]  # one id on many rows
    docs, marked = frame(spark, rows), labels(spark, marks)
    took = [sorted(r.h for r in T.sample(docs, marked, size=60)[0].collect()) for _ in range(2)]
    assert took[0] == took[1] and len(took[0]) <= 120


def test_registered_query_on_held_out_labels(spark):
    from scorelake.llm.queries import op11_toxicity
    got = op11_toxicity(spark, SMALL).where("held_out").join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((0, 1), 0) <= 2 and counts.get((1, 1), 0) >= 3  # 64 clean, 6 toxic
