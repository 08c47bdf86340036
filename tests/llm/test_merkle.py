"""Merkle manifest and climb against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from scorelake.llm import merkle as M
from tests.llm.conftest import ascii_lower, frame, make_texts


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source = row
    n = None if row[1] is None else len(row[1])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for rs in groups.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {k: levels([leaf(r, r[1]) for r in rs]) for k, rs in groups.items()}
    top = levels([trees[k][-1][0] for k in langs])
    out = []
    for rank, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            folded, proof = leaf(r, ascii_lower(r[1]) if tampered else r[1]), ""
            for tree, at in ((trees[lang], i), (top, rank)):
                for nodes in tree[:-1]:
                    run, own = nodes[at // 8 * 8:at // 8 * 8 + 8], at % 8
                    proof += "".join(run[:own] + run[own + 1:])
                    folded = sha("".join(run[:own] + [folded] + run[own + 1:]))
                    at //= 8
            out.append((r[0], trees[lang][0][i], trees[lang][-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def climbed(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    built = M.build(df, altered={"text": M.lowered(F.col("text"), tampered)})
    return sorted((tuple(r) for r in M.verify(built).collect()), key=repr)


def rows_of(n, langs, seed=3):
    rnd = random.Random(seed)
    texts = make_texts()
    rows = [(rnd.choice([None, rnd.randrange(-50, n), 7]), rnd.choice(texts), rnd.choice(langs),
             rnd.choice([None, "s:1", "é"])) for _ in range(n)]
    return rows + rows[:3] + [rows[0]] * 12


@pytest.mark.parametrize("n, langs", [
    (700, ["en", "en", "en", "", None, "de", "é"]),  # four levels, several blocks; a null and an empty language
    (40, [f"l{i}" for i in range(30)]),               # more than eight languages, some of one row
    (20, ["en"]),                                     # one language: its subroot is the root
])
def test_climb_equals_plain_tree(spark, n, langs):
    rows = rows_of(n, langs)
    assert climbed(frame(spark, rows).repartition(5)) == brute(rows)


def test_single_rows(spark):
    rows = [(1, "A", "en", None)]
    assert climbed(frame(spark, rows)) == brute(rows)
    rows += [(2, None, "de", None), (None, "", None, "x")]
    assert climbed(frame(spark, rows)) == brute(rows)


def test_tampering_shows_and_untouched_rows_verify(spark):
    rows = [(i, "Text" if i % 2 else "text", "en", "s") for i in range(100)]
    for doc_id, *_, verified in climbed(frame(spark, rows)):
        assert verified == (doc_id % 2 == 0 or zlib.crc32(str(doc_id).encode()) % 3 != 0)


def test_no_altered_rows_all_verify_and_empty_table(spark, empty):
    df = frame(spark, rows_of(60, ["en", "de"]))
    assert M.verify(M.build(df)).where("not verified").count() == 0
    assert M.verify(M.build(empty)).count() == 0


def test_leaves_tell_like_rows_apart(spark):
    """Lengths in front: moving a character from one column to the next changes the leaf."""
    rows = [(1, "ab", "en", "c"), (1, "b", "en", "ca"), (1, None, "en", "-"), (1, "-", "en", None)]
    assert len({r[1] for r in climbed(frame(spark, rows))}) == 4


def test_a_node_row_is_joined_by_at_most_a_block_of_leaves(spark):
    built = M.build(frame(spark, [(i, "t", "en", None) for i in range(1500)]))
    held = built.runs.groupBy("home", F.floor(F.col("run") / (M.BLOCK // M.FAN)).alias("block")).agg(
        F.sum(F.size("leaves")).alias("n"))
    assert held.agg(F.max("n")).first()[0] <= M.BLOCK
    roots = built.nodes.where(F.col("p_tree").isNull())
    assert roots.count() == 3 and roots.select("digest").distinct().count() == 1
