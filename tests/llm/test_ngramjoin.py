import random

import numpy as np
import pyarrow as pa
import pytest

from scorelake.llm import ngramjoin as J
from scorelake.llm.textblock import Block

from .conftest import frame, make_texts, words_of


def shingles(text):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    """[(doc_id, text)] -> {(doc_id, text): (n, component)}"""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))),
                  key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df).collect()), key=repr)


def test_components_match_brute_force(docs):
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_other_texts_repeated_rows_and_null_ids(spark):
    rows = [(i, t) for i, t in enumerate(make_texts(7, 24))]
    rows += rows[:5] + [(3, "other text under one id " * 3), (None, rows[10][1]), (None, None), (None, "alone here")]
    assert result(frame(spark, rows)) == brute(rows)


def test_empty_table(empty):
    assert result(empty) == []


@pytest.mark.parametrize("size", [1, 2, 3, 4, 7, 8, 16, 17, 33, 100, 257, 1000])
def test_linked_sets_share_a_signature(size):
    """Pairs at the very edge of the similarity, of equal and of different sizes."""
    rnd = np.random.default_rng(size)
    for _ in range(60):
        a = np.unique(rnd.integers(0, 1 << 63, size).astype(np.uint64))
        for b_size in {len(a), J.largest_partner(len(a)), (len(a) + J.largest_partner(len(a))) // 2}:
            diff = J.most_different(len(a), b_size)
            gone = max(0, (diff - (b_size - len(a))) // 2)
            b = np.unique(np.concatenate((rnd.permutation(a)[gone:], rnd.integers(
                0, 1 << 63, b_size - len(a) + gone).astype(np.uint64))))
            if J.linked(a, b):
                assert set(J.signatures(a).tolist()) & set(J.signatures(b).tolist())
                assert J.may_link(len(a), J.sketch(a), np.array([len(b)]), [J.sketch(b)])[0]


def test_sets_short_of_ranges_still_meet():
    """All elements in one range: the shared signature is the one for sets short of ranges."""
    a = np.arange(1000, 1100, dtype=np.uint64)
    b = np.arange(1005, 1105, dtype=np.uint64)
    assert J.linked(a, b)
    assert set(J.signatures(a).tolist()) & set(J.signatures(b).tolist())


def test_sketch_never_exceeds_the_difference():
    rnd = random.Random(3)
    for _ in range(50):
        a = np.unique(np.array([rnd.getrandbits(64) for _ in range(rnd.randint(1, 400))], np.uint64))
        b = np.unique(np.concatenate((a[rnd.randint(0, len(a)):], np.array(
            [rnd.getrandbits(64) for _ in range(rnd.randint(1, 200))], np.uint64))))
        true = len(a) + len(b) - 2 * len(np.intersect1d(a, b))
        assert J.least_difference(J.sketch(a), [J.sketch(b)])[0] <= true


def brute_kept(rows):
    """Texts that stay: one of each component (smallest id, null last), and every row without words."""
    groups = {}
    for (d, t), (_, n, _), root in zip(rows, *brute_roots(rows)):
        if n:
            groups.setdefault(root, []).append(d)
    first = sorted((min(ds, key=lambda d: (d is None, d or 0)) for ds in groups.values()), key=repr)
    return first, sum(1 for _, t in rows if not words_of(t))


def brute_roots(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                up[root(i)] = root(j)
    return [(None, len(s), None) for s in sets], [root(i) for i in range(len(rows))]


def test_deduplicated_keeps_one_of_each_group(spark):
    rows = [(i, t) for i, t in enumerate(make_texts(5, 24))]
    base = rows[10][1].split() + [f"x{i}" for i in range(60)]
    near = [" ".join(base[:k] + [f"edit{k}"] + base[k + 1:]) for k in (3, 30, 45)]
    rows += [rows[0], rows[0], (200, None), (200, None), (2, "other text under one id " * 3)]
    rows += [(7, near[0]), (7, near[1]), (7, near[1])]  # near copies under one id that other texts have too
    apart = " ".join(f"null{i}" for i in range(80)).split()
    rows += [(None, " ".join(apart[:k] + ["edit"] + apart[k + 1:])) for k in (2, 40, 70)]  # near copies without id
    rows += [(None, "alone without id"), (None, "alone without id"), (None, "")]
    kept = J.deduplicated(frame(spark, rows)).select("doc_id", "text", "size").collect()
    first, blank = brute_kept(rows)
    assert sorted((r.doc_id for r in kept if words_of(r.text)), key=repr) == first
    assert sum(1 for r in kept if not words_of(r.text)) == blank
    assert {r["size"] for r in kept} == {"x"}


@pytest.mark.parametrize("block", [3, 1024])
def test_every_link_between_texts_is_found_whatever_the_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rows = [(i, t) for i, t in enumerate(make_texts(9, 40))] + [(500, make_texts(9, 40)[3]), (None, "a b c d e f")]
    sets = [shingles(t) for _, t in rows]
    links, by_row = set(), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(len(rows)):
            inter = len(sets[i] & sets[j])
            if i != j and inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                by_row[i] += 1
                if sets[i] != sets[j]:
                    links.add(frozenset((sets[i], sets[j])))
    df = frame(spark, rows).repartition(5)
    pairs, per_row = J.class_links(df)
    got = pairs.collect()
    assert len(got) == len(set(got)) == len(links)
    assert sorted(((r.doc_id, r.n_links) for r in per_row.collect()), key=repr) == sorted(
        ((d, n) for (d, _), n in zip(rows, by_row)), key=repr)
    assert result(df) == brute(rows)


def test_a_candidate_is_offered_once_and_never_inside_a_component(spark):
    """Many near copies that share most buckets: the pairs offered are few and all different."""
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:k] + ["x", str(k)] + base[k:]) for k in range(60)]
    df = frame(spark, list(enumerate(texts)))
    _, classes, shared, _, _ = J._prepared(df, "doc_id", "text")
    every = J._apart(shared, None, classes, False).select("a", "b").collect()
    assert len(every) == len({frozenset(p) for p in every})
    few = J._apart(shared, None, classes, True).collect()
    assert len(few) <= sum(r["n"] - 1 for r in shared.groupBy("sig").agg(J.F.count("*").alias("n")).collect())
    one = classes.select("set", J.F.lit(1).cast("long").alias("comp"))
    assert J._apart(shared, one, classes, False).count() == 0


def test_shingles_of_a_batch_do_not_cross_rows():
    sets = J.shingle_sets(Block(pa.array(["a b c", "d e f", None, "", "a b c d e f g"])))
    assert [len(s) for s in sets] == [1, 1, 0, 0, 3]
