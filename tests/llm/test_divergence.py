"""Source divergence against exact integer arithmetic in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from scorelake.llm import divergence as V
from tests.llm.conftest import ascii_lower, frame


def brute(rows, least):
    """rows: (doc_id, text, lang, source) -> {(lang, source, part, rank): (item, value)}."""
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text)))
             for _, text, lang, source in rows]
    seen, counts, total = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in words:
        seen.update((lang, t) for t in set(w))
    groups = sorted({(a, b) for a, b, _ in words})
    for lang, source, w in words:
        w = [t for t in w if seen[lang, t] >= least]
        counts[lang, source].update(w)
        total[lang].update(w)
    out = {}

    def p(c, n, v):
        return 1 + 10 ** 9 * (c + 2) // (n + 2 * v)

    for lang, source in groups:
        kept = sorted(t for t in total[lang])
        v, mine = len(kept), counts[lang, source]
        n, whole = sum(mine.values()), sum(total[lang].values())

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        found = {"pair": [], "term": []}
        for other in (s for x, s in groups if x == lang and s != source):
            m = sum(counts[lang, other].values())
            found["pair"].append((other, sum(f(p(mine[t], n, v), p(counts[lang, other][t], m, v)) for t in kept)))
        for t in kept:
            a, b = p(mine[t], n, v), p(total[lang][t], whole, v)
            if mine[t] and a > b:
                found["term"].append((t, f(a, b)))
        for part, items in found.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            for rank, item in enumerate(items[:None if part == "pair" else 10], 1):
                out[lang, source, part, rank] = item
    return out


def result(df):
    got = df.collect()
    out = {(r.lang, r.source, r.part, r["rank"]): (r.item, r.value) for r in got}
    assert len(out) == len(got)
    return out


@pytest.fixture(scope="module")
def mixed():
    rnd = random.Random(5)
    vocabulary = [f"{'éa'[i % 2]}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = []
    for i in range(500):
        lang = rnd.choice(["en", "en", "en", "de", None, "xx"])
        # xx is too small to keep a term; one source holds a third of all rows
        source = "big" if i % 3 == 0 else rnd.choice([None, "", "s1", "s2", "ß", "S1", "s10"])
        if lang == "xx" and len([r for r in rows if r[2] == "xx"]) > 5:
            lang = "de"
        text = " ".join(rnd.choice(vocabulary[:30 if source == "s1" else 120]) for _ in range(rnd.randint(0, 40)))
        rows.append((i % 90, text if i % 50 else None, lang, source))
    rows += [(1, "Aa AA aA İ 12 a1b " * 400, "en", "s1")] * 12 + [(2, "", "zz", "only"), (3, "  12 !", "yy", "a"),
                                                                 (3, None, "yy", None)]
    return rows


@pytest.mark.parametrize("tile", [3, 512])
def test_audit_equals_plain_integers(spark, mixed, tile):
    df = frame(spark, mixed).repartition(7)
    assert result(V.audit(df, least_docs=10, tile=tile)) == brute(mixed, 10)


def test_many_equal_values_are_expanded_in_utf8_order(spark):
    """A cell of far more terms than ranks: the first ten by their bytes."""
    terms = [f"{'zéa'[i % 3]}{chr(97 + i // 3)}" for i in range(60)]
    rows = [(i, " ".join(terms), "en", "a") for i in range(10)] + [(99, "other words", "en", "b")] * 10
    assert result(V.audit(frame(spark, rows))) == brute(rows, 10)


def test_empty_table(spark, empty):
    assert V.audit(empty).count() == 0


def test_shares_are_exact_for_large_counts():
    count, size = np.array([0, 1, 10 ** 12, 8 * 10 ** 15 - 2]), np.array([3, 10 ** 15, 10 ** 13 + 1, 8 * 10 ** 15])
    want = [1 + 10 ** 9 * (int(c) + 2) // int(n) for c, n in zip(count, size)]
    assert V.shares(count, size).tolist() == want


def test_batch_counts_and_merge():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en", "en", "de"]), pa.array(["a", "a", "a"]), pa.array(["x X y", "x", "x"])], ["l", "s", "t"])
    rows = {(r["lang"], r["term"]): (r["n"], r["docs"]) for r in V._merged([V.batch_counts(batch)] * 2).to_pylist()}
    assert rows == {("en", "x"): (6, 4), ("en", "y"): (2, 2), ("de", "x"): (2, 2)}
