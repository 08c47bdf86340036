import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorelake.llm import chat as C
from scorelake.llm import decontaminate, mixing, ngramjoin, quality, secrets
from scorelake.llm import queries
from scorelake.llm.store import stored, table

from .conftest import frame

SMALL = "/root/testdata/sf0.01"
NASTY = ["", "plain", "\\", "\\\\n", "<s>", "</s>[INST] x [/INST]", "<|im_start|>user<|im_sep|>", "<<SYS>>a<</SYS>>",
         "\\<s>", "<\\s>", "<|im_end|>\\", "<<s>>", "[[INST]]", "<|", "|>", "é漢\n\t", "<|im_cont|>" * 3, None]


def test_chat_round_trip(spark):
    rnd = np.random.default_rng(2)
    rows, want = [], {}
    for conv in range(80):
        turns = [(str(rnd.choice(["user", "assistant", "system", "<s>", ""])),
                  NASTY[rnd.integers(len(NASTY))]) for _ in range(rnd.integers(1, 9))]
        want[conv] = [(r, t or "") for r, t in turns]
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    chats = C.format_chats(df)
    back = {r.conv_id: r for r in C.read_back(chats).collect()}
    masks = {r.conv_id: r for r in chats.collect()}
    assert sorted(back) == sorted(want)
    for conv, turns in want.items():
        r = back[conv]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert list(r.loss_texts) == [t for role, t in turns if role == "assistant"]
        runs = masks[conv].loss_mask
        assert sum(x.chars for x in runs) == len(masks[conv].formatted)
        pos, under = 0, []
        for x in runs:
            if x.loss:
                under.append(masks[conv].formatted[pos:pos + x.chars])
            pos += x.chars
        merged = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert masks[conv].formatted.count(C.START) == merged == masks[conv].formatted.count(C.END)
        assert len(under) == len(r.loss_texts)


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, turns string"
    rows = [(None, 1, "user", "a"), (1, None, None, None), (1, 2, "assistant", "b"), (1, 2, "assistant", "b"),
            (1, 2, "assistant", "a"), (2, 5, "assistant", "only " * 9000)]
    got = {r.conv_id: r for r in C.read_back(C.format_chats(spark.createDataFrame(
        [(*r, "x", "y") for r in rows], schema))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert got[None].loss_texts == [] and got[2].loss_texts == ["only " * 9000]
    assert C.read_back(C.format_chats(spark.createDataFrame([], schema))).count() == 0


# --------------------------------------------------------------------- mixing
def filled(sizes, weights, most=3):
    """Targets by sharing the excess again until none is above its cap."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        target = [most * s if i in capped else left * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in capped and target[i] > most * s}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100, 100], [5, 1000, 1000, 10], [1, 1, 5000, 1, 1], [0, 50, 0, 70], [7]])
def test_targets(spark, sizes):
    rows = [(f"s{i}" if i < len(sizes) - 1 else None, s) for i, s in enumerate(sizes)]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(rows, "source string, size long")).collect()}
    want = filled(sizes, [1 + i % 3 for i in range(len(sizes))])
    assert np.allclose([got[s] for s, _ in rows], want)


def test_mix_takes_near_the_target_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)  # many buckets a source
    rows = queries.op6_source_mixing(spark, SMALL).collect()
    source = dict(duckdb.sql(f"SELECT doc_id, source FROM '{SMALL}/documents.parquet'").fetchall())
    taken, target, largest = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        largest[s] = max(largest.get(s, 0), r.size)
        assert r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= 3 * largest[s] for s in taken)
    assert sorted(rows) == sorted(queries.op6_source_mixing(spark, SMALL).collect())


def test_mix_rows_and_odd_rows(spark, empty):
    rows = [(1, "a b", None, "x"), (1, "a b", None, "x"), (2, None, None, "x"), (3, "", None, None), (None, "c", None, None),
            (4, "d e f " * 5000, None, "y")]
    df = frame(spark, rows)
    counts = mixing.copies(df).collect()
    mixed = mixing.mix(df)
    assert mixed.columns == [*df.columns, "copy"] and mixed.count() == sum(r.copies for r in counts)
    assert len(counts) == len(rows) and mixing.mix(empty).count() == 0
    assert mixing.copies(empty).count() == 0


def test_equal_ids_and_sizes_take_the_same_texts(spark):
    rows = [(7, "a", f"word{i} tail") for i in range(60)] + [(8, "b", " ".join(["x"] * 9)) for _ in range(20)]
    schema = "doc_id long, source string, text string"
    seen = [sorted((r.text, r.copy) for r in mixing.mix(spark.createDataFrame(order, schema).repartition(parts)).collect())
            for order, parts in ((rows, 1), (rows[::-1], 5), (rows, 3))]
    assert seen[0] == seen[1] == seen[2] and 0 < len(seen[0])


def test_mix_is_native(spark):
    plan = mixing.mix(table(spark, SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------- pipeline
def test_stages_keep_the_columns_and_do_their_work(spark):
    docs = table(spark, SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan",
                     "source_mixing"]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SMALL), name))
    for df in seen[1:-1]:
        assert df.schema == docs.schema
    rows = [{r.doc_id: r for r in df.collect()} for df in seen[:-1]]
    models = quality.train(seen[0])
    assert set(rows[1]) == {r.doc_id for r in quality.classify(seen[0], models).where("keep").collect()}
    found = ngramjoin.near_duplicates(seen[1]).collect()
    assert set(rows[2]) == {r.doc_id for r in found if r.doc_id == r.component_id}
    hit = {r.doc_id for r in decontaminate.scan(seen[2], table(spark, SMALL, "benchmark")).where("n_hit > 0").collect()}
    assert set(rows[3]) == set(rows[2]) - hit and hit
    assert set(rows[4]) == set(rows[3])
    for d, r in rows[4].items():
        before = rows[3][d]
        spans = [s for rule in secrets.RULES for s in rule.spans(before.text or "")]
        assert (r.text != before.text) == bool(spans) and r.n_chars == len(r.text)
    copies = {r.doc_id: r.copies for r in mixing.copies(seen[4]).collect()}
    mixed = {r.doc_id: r.n for r in seen[5].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert mixed == {d: n for d, n in copies.items() if n}
    assert corpus_pipeline.run(spark, SMALL).count() == sum(mixed.values())


def test_stages_on_odd_rows(spark, empty):
    odd = frame(spark, [(1, None), (None, "a b c"), (2, ""), (2, ""), (3, "x " * 30000, None, "s")]).select(
        "doc_id", "text", "lang", "source", "n_chars")
    none = empty.select(odd.columns)
    for df in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            df = stored(stage(spark, df, SMALL), name)
        df.count()


def test_slices_of_the_scorer_take_little_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from scorelake.llm import quality
    from scorelake.llm.store import parts
    from scorelake.llm.textblock import Block

    batch = pa.RecordBatch.from_arrays([pa.array([f"Some words of row {i}, and 12 more. " * 60 for i in range(3000)])], ["text"])
    scorer = quality.Scorer(np.linspace(-1, 1, quality.DIMENSIONS), 0.1)
    whole = np.concatenate([scorer.score(Block(p.column(0))) for p in parts(batch.slice(0, 40), 1)])
    tracemalloc.start()
    try:
        scores = np.concatenate([scorer.score(Block(p.column(0))) for p in parts(batch, 1000)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 64 << 20
    assert len(scores) == 3000 and np.allclose(scores[:40], whole)
