import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scorelake.llm import contexttree as T
from scorelake.llm.textblock import Block

from .conftest import frame, words_of


def plain_ctw(train, text, depth):
    """Log-probability of a text by the textbook recursion over a full tree of byte contexts."""
    count = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    for t in train:
        data = b"\0" * depth + t
        for i in range(depth, len(data)):
            for bit in range(8):
                prefix = (bit, data[i] >> (8 - bit))
                one = data[i] >> (7 - bit) & 1
                for d in range(depth + 1):
                    count[data[i - d:i], prefix][one] += 1
                    if d:
                        children[data[i - d + 1:i], prefix].add(data[i - d:i])

    def kt(c):
        a, b = c
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    cache = {}

    def weight(ctx, prefix):
        if (ctx, prefix) not in cache:
            own = kt(count[ctx, prefix])
            if len(ctx) < depth:
                deep = sum(weight(c, prefix) for c in children[ctx, prefix])
                own = np.logaddexp(own, deep) + math.log(.5)
            cache[ctx, prefix] = own
        return cache[ctx, prefix]

    def one(history, prefix):
        mass, p = 1.0, 0.0
        for d in range(depth + 1):
            ctx = history[len(history) - d:]
            if (ctx, prefix) not in count:
                return p + mass * .5
            a, b = count[ctx, prefix]
            stop = 1.0 if d == depth else math.exp(kt((a, b)) + math.log(.5) - weight(ctx, prefix))
            p += mass * stop * (b + .5) / (a + b + 1)
            mass *= 1 - stop
        return p

    data, total = b"\0" * depth + text, 0.0
    for i in range(depth, len(data)):
        for bit in range(8):
            p = one(data[i - depth:i], (bit, data[i] >> (8 - bit)))
            total += math.log(p if data[i] >> (7 - bit) & 1 else 1 - p)
    return total


def normal(text):
    return " ".join(words_of(text)).encode() + b"\0"


def test_matches_the_textbook_recursion(spark):
    train = ["The cat sat on the mat.", "the CAT ate   the rat", "a mat, a rat", "", None]
    tests = ["the cat ate a mat", "the rat", "", None, "zebra ÿ", "The  cat sat\non the mat."]
    tree = T.train_tree(frame(spark, list(enumerate(train))), nodes=1 << 30)
    got, size = tree.score(Block(pa.array(tests)))
    assert size.tolist() == [len(normal(t)) for t in tests]
    want = [plain_ctw([normal(t) for t in train], normal(t), T.DEPTH) for t in tests]
    assert np.allclose(got, want, rtol=1e-5)


def test_pruned_tree_is_a_distribution(spark):
    tree = T.train_tree(frame(spark, [(1, "the cat sat on the mat and the rat " * 20)]), nodes=40)
    assert len(tree.child) > 10
    assert np.allclose(np.exp(tree.logs.astype(float)).sum(1), 1, atol=1e-5)


def test_base_counts_and_scores(spark, docs):
    training = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1
    for frequent in (T.FREQUENT, 5):  # all tokens broadcast, or nearly all joined
        got = {r.doc_id: r for r in T.score(docs, training, frequent=frequent).collect()}
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        count = Counter()
        for d, t in rows:
            if d % 3 != 1:
                count.update([*words_of(t), ("end",)])
        n, v = sum(count.values()), len(count)
        for d, t in rows:
            tokens = [*words_of(t), ("end",)]
            r = got[d]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
                d % 3 == 1, len(tokens), sum(1 for x in tokens if count[x]), n)
            want = sum(math.log10((count[x] + .5) / (n + .5 * (v + 1))) for x in tokens)
            assert math.isclose(r.base_score, want, rel_tol=1e-9)
            assert r.score < 0 and math.isclose(
                r.bits_per_byte, -r.score * math.log2(10) / len(normal(t)), rel_tol=1e-9)
    assert len(got) == len(rows)


def test_no_training_rows_and_empty_table(spark, empty):
    got = T.score(frame(spark, [(1, "ab")]), F.lit(False)).collect()[0]
    assert math.isclose(got.score, 3 * math.log10(1 / 256), rel_tol=1e-6) and got.train_tokens == 0
    assert T.score(empty, F.lit(True)).count() == 0


def test_scores_are_those_of_the_whole_tree(spark, monkeypatch):
    """At the registered parameters rare contexts count in full, whether their grams are broadcast or joined."""
    import random

    rnd = random.Random(5)
    common = [f"{rnd.choice('the cat sat on a mat'.split())} " * 40 for _ in range(30)]
    rare = [" ".join(f"{rnd.randrange(10 ** 9):x}" for _ in range(60)) for _ in range(12)]
    texts = [*common, *rare, rare[0], "", None, "Ünï çödé", f"{rare[1][:90]} zz"]
    docs = frame(spark, list(enumerate(texts))).repartition(3)
    learned = [normal(t) for i, t in enumerate(texts) if i % 4 != 1]
    want = {i: plain_ctw(learned, normal(texts[i]), T.DEPTH) for i in (1, 33, 42, 43, 45, 46)}
    for frequent, held in ((T.FREQUENT, T.SLICE_GRAMS), (50, 1)):
        monkeypatch.setattr(T._subtrees, "__defaults__", (held,))
        got = {r.doc_id: r for r in T.score(docs, F.col("doc_id") % 4 != 1, frequent=frequent).collect()}
        assert len(got) == len(texts)
        for i, w in want.items():
            assert math.isclose(got[i].score * math.log(10), w, rel_tol=1e-8), (frequent, i)


def test_a_context_seen_twice_in_a_large_corpus_is_learned(spark):
    """Less than 1 / 32,768 of the training bytes, as the second occurrence of a passage is."""
    passage = "qzx vjw kpq zzv"
    texts = ["aaaa bbbb " * 20_000, passage, passage, passage]
    got = {r.doc_id: r.bits_per_byte for r in T.score(
        frame(spark, list(enumerate(texts))), F.col("doc_id") != 3).collect()}
    assert got[3] < 3
