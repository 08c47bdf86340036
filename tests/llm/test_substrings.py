import hashlib

import pytest

from scorelake.llm import substrings as S

from .conftest import frame, make_texts


def brute(rows, length):
    low = -(1 << 63)
    first = {}
    data = [((low if d is None else d), (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, (d, i)), (d, i))
    out = []
    cut_of = {}
    for d, b in data:  # rows with one id are one place: what repeats in one of them goes in all
        gone = cut_of.setdefault(d, set())
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (d, i):
                gone.update(range(i, i + length))
    for (d, b), (raw, _) in zip(data, rows):
        gone = {i for i in cut_of[d] if i < len(b)}
        kept = bytes(c for i, c in enumerate(b) if i not in gone)
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((raw, len(b), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                   for r in S.remove_repeats(df, **kw).collect()), key=repr)


def test_matches_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == brute(rows, 100)


@pytest.mark.parametrize("length,gram,hot", [(20, 10, 2000), (20, 10, 2), (20, 20, 1), (12, 1, 3)])
def test_other_lengths_and_hot_grams(spark, length, gram, hot):
    rows = [(i * 7 % 101, t) for i, t in enumerate(make_texts(9, 24)) if t is None or len(t) < 3000]
    assert result(frame(spark, rows).repartition(4), length=length, gram=gram, hot_blocks=hot) == brute(rows, length)


def test_one_letter_text_twins_and_null_ids(spark):
    rows = [(1, "a" * 250), (2, "a" * 99), (3, "ba" * 120), (4, "x" + "a" * 120), (None, "a" * 130), (5, None)]
    assert result(frame(spark, rows)) == brute(rows, 100)
    twin = [(1, "some text of its own " * 9), (1, "some text of its own " * 9)]
    assert result(frame(spark, twin)) == brute(twin, 100)


def test_empty_table(empty):
    assert result(empty) == []


def brute_by_row(rows, length):
    """Each row by its own repeats. ``rows``: id, text, hash of the text; equal rows are one place."""
    low = -(1 << 63)
    data = [((low if d is None else d, key), (t or "").encode()) for d, t, key in rows]
    first = {}
    for place, b in data:
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, (place, i)), (place, i))
    out = []
    for (place, b), (raw, _, _) in zip(data, rows):
        gone = set()
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (place, i):
                gone.update(range(i, i + length))
        kept = bytes(c for i, c in enumerate(b) if i not in gone)
        out.append((raw, len(b), len(gone), sum(1 for i in gone if i - 1 not in gone),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [2000, 1])
def test_rows_with_one_id_are_cut_by_their_own_repeats(spark, hot):
    shared, own = "a passage that two rows share " * 2, [f"row {i} has bytes of its own {i * 977} " for i in range(9)]
    rows = [(None, own[0] + shared), (None, own[1] + shared + own[2]), (None, shared + own[3]), (None, own[4] * 3),
            (7, own[5] + shared), (7, own[6] + shared), (7, own[7] * 2 + own[8]), (7, own[5] + shared), (7, None)]
    rows += [(None if i % 3 else i % 4, t) for i, t in enumerate(make_texts(5, 18)) if t is None or len(t) < 2000]
    df = frame(spark, rows).repartition(4).cache()
    hashed = [tuple(r) for r in df.selectExpr("doc_id", "text", "xxhash64(coalesce(text, ''))").collect()]
    assert result(df, length=20, gram=10, hot_blocks=hot) == brute_by_row(hashed, 20)
