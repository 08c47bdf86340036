"""N-gram Jaccard self-join with PartEnum signatures.

A document's set is its distinct word shingles, as 64-bit hashes. Sizes fall
into bands (u/2, u]; within a band the hash domain is cut into the same m
ranges, in pairs of second-level partitions: two sets that differ in at most k
elements have at least m - k equal ranges, so some subset (one of the two
second-level partitions of a first-level one) is the same on both sides and its
hash is a shared signature. A set also signs in the next band if a partner
there can be similar enough. Only non-empty ranges sign, and of these only the
first k + 1 in hash order: whichever of two linked sets stops earlier has more
non-empty ranges than there are differences, so one of its ranges is equal in
both, and the other set, which goes on for longer, signs it too. A set with too
few non-empty ranges also gives the signature "short of ranges", which all such
sets of a band share. So no link is lost.

Texts with equal sets are one class from the start. Signatures held by two or
more classes are buckets; signatures with the same members are one bucket, named
by the hash of its members. Members of a bucket are first compared with one
centre (the class in most buckets); links merge classes into components. What is
left are buckets whose members lie in different components. Those are cut into
blocks of about ``BLOCK`` members, dealt as pairs of blocks, so a task holds two
blocks however large the bucket. Of the pairs of members that sizes and a parity
sketch allow (a lower bound of the symmetric difference, so no true link fails
it), a block pair first offers only a spanning forest over components. Where all
of these turn out to be links, whatever else the block pair allows is joined
too; only buckets with a refuted pair are gone through again, and in them only
the components that some offered pair touched (the others have no candidate
there), for every pair still apart. Of the buckets that such a pair shares (it is
a candidate in each) the smallest offers it alone, as members carry their smaller
buckets, so no candidate is repeated and a group of copies is never expanded into
all pairs. Candidates pass the exact comparison of the sets.
``class_links`` skips the components and returns every link between classes.

Defined results: a text with fewer words than a shingle is one shingle; null
and empty texts have no set and stand alone; repeated rows are copies; null
ids never name a component.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_arrow, map_batches, stored
from scorelake.llm.textblock import NOT_SPACE, U64, WORD_BASE, Block, mix64, slices, window_hashes

WIDTH = 5
#: Similarity of a link: intersection * PER >= union * PART.
PART, PER = 75, 100
#: Ranges of a band per element of its largest set.
RANGES = 0.34
#: Members of a bucket that a task compares with as many others at once.
BLOCK = 1024
_edges: dict[int, np.ndarray] = {}


def shingle_sets(block: Block, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    hashes, _, _, first = block.word_hashes(NOT_SPACE)
    windows, pos = window_hashes(hashes, first, width)
    edge = np.searchsorted(pos, first)
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < width))
    whole = dict(zip(short.tolist(), slices(hashes, first[short], first[short + 1], WORD_BASE)))
    out = []
    for r in range(block.rows):
        a = np.sort(windows[edge[r]:edge[r + 1]])
        if len(a) > 1:
            a = a[np.concatenate(([True], a[1:] != a[:-1]))]
        elif r in whole:
            a = np.array([whole[r]], U64)
        out.append(a)
    return out


def set_hash(a: np.ndarray) -> int:
    """One hash for the whole set (signed)."""
    return int(mix64(np.array([mix64(a).sum(dtype=U64) + U64(len(a))], U64)).view(np.int64)[0])


def most_different(size: int, other: int) -> int:
    """The largest symmetric difference of two linked sets of these sizes."""
    return (size + other) * (PER - PART) // (PER + PART)


def largest_partner(size: int) -> int:
    return size * PER // PART


# ------------------------------------------------------------------ signatures
def signatures(a: np.ndarray) -> np.ndarray:
    """The signatures of one non-empty sorted set (signed)."""
    size = len(a)
    band = max(0, (size - 1).bit_length())  # sizes in (2 ** (band - 1), 2 ** band]
    out = [_sign(a, band, min(1 << band, largest_partner(size)))]
    if largest_partner(size) > 1 << band:
        out.append(_sign(a, band + 1, largest_partner(size)))
    return np.concatenate(out).view(np.int64)


def _sign(a: np.ndarray, band: int, partner: int) -> np.ndarray:
    ranges = int(RANGES * (1 << band)) + 2
    ranges += ranges % 2
    if ranges not in _edges:
        _edges[ranges] = np.array([(j << 64) // ranges for j in range(ranges)], U64)
    cut = np.append(np.searchsorted(a, _edges[ranges]), len(a))
    full = np.flatnonzero(cut[1:] > cut[:-1])
    need = most_different(len(a), partner) + 1
    enough = len(full) >= need
    full = full[:need]
    total = np.concatenate((np.zeros(1, U64), np.cumsum(mix64(a ^ U64(0x51ED270B)))))
    part = total[cut[full + 1]] - total[cut[full]]
    out = mix64(part + mix64((full.astype(U64) << U64(8)) + U64(band + 1)))
    return out if enough else np.append(out, mix64(np.array([band + 1], U64)))


# ---------------------------------------------------------------------- sketch
def sketch(a: np.ndarray) -> bytes:
    """Parity of the elements per slot, in at least four slots per element."""
    slots = max(64, 1 << (4 * max(len(a), 1) - 1).bit_length())
    odd = np.bincount((a & U64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _fold(rows: np.ndarray, width: int) -> np.ndarray:
    """Sketches with fewer slots: the parity of slot i is that of all slots equal to i modulo the width."""
    while rows.shape[-1] > width:
        half = rows.shape[-1] // 2
        rows = rows[..., :half] ^ rows[..., half:]
    return rows


def least_difference(one: bytes, others: list[bytes]) -> np.ndarray:
    """A lower bound of the symmetric difference to each other set."""
    a = np.frombuffer(one, np.uint8)
    out = np.zeros(len(others), np.int64)
    sizes = np.array([len(o) for o in others])
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        rows = np.frombuffer(b"".join(others[i] for i in at.tolist()), np.uint8).reshape(len(at), n)
        width = min(n, len(a))
        out[at] = np.bitwise_count(_fold(rows, width) ^ _fold(a, width)).sum(1)
    return out


def may_link(n: int, one: bytes, sizes: np.ndarray, others: list[bytes]) -> np.ndarray:
    """Which of the others the sizes and sketches do not rule out."""
    near = (np.minimum(n, sizes) * PER >= np.maximum(n, sizes) * PART)
    if near.any():
        at = np.flatnonzero(near)
        diff = least_difference(one, [others[i] for i in at.tolist()])
        near[at] = diff * (PER + PART) <= (n + sizes[at]) * (PER - PART)
    return near


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(a) + len(b)
    union = len(np.union1d(a, b))
    return (both - union) * PER >= union * PART


# ----------------------------------------------------------------- Spark steps
def _sets_table(src: DataFrame, kind: str) -> DataFrame:
    """doc_id, text_hash, n, set (class hash, null if empty), sketch."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(Block(batch.column(1)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([len(a) for a in sets], pa.int64()),
             pa.array([set_hash(a) if len(a) else None for a in sets], pa.int64()),
             pa.array([sketch(a) if len(a) else None for a in sets], pa.binary())],
            ["doc_id", "text_hash", "n", "set", "sketch"])

    return map_batches(src, run, f"doc_id {kind}, text_hash long, n long, set long, sketch binary")


def _signature_rows(src: DataFrame) -> DataFrame:
    """(sig, set): each class once per task, however many copies the task reads."""

    def run(batch: pa.RecordBatch, seen: set) -> pa.RecordBatch | None:
        sigs, ids = [], []
        for a in shingle_sets(Block(batch.column(1))):
            h = set_hash(a) if len(a) else None
            if h is not None and h not in seen:
                seen.add(h)
                sigs.append(signatures(a))
                ids.append(np.full(len(sigs[-1]), h))
        if not sigs:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(ids))],
                                          ["sig", "set"])

    return map_batches(src, run, "sig long, set long", state=set)


def _runs(frame: DataFrame, fn, keys: int, schema: str) -> DataFrame:
    """Apply ``fn`` to whole runs of equal values in the first ``keys`` columns of a frame sorted by them.

    A batch is cut at the last change; what follows is kept aside until the run ends."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(k)) for k in range(keys)])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            if held:
                before = [held[-1].column(k)[-1].as_py() for k in range(keys)]
                if before != key[:, 0].tolist():
                    change = np.append(0, change)
            if len(change):
                done = [*held, batch.slice(0, int(change[-1]))]
                held = []
                yield from fn(pa.Table.from_batches(done).combine_chunks().to_batches()[0])
                batch = batch.slice(int(change[-1]))
            held.append(batch)
        if held:
            yield from fn(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return map_arrow(frame, run, schema)


def _by_signature(frame: DataFrame, *order) -> DataFrame:
    n = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(n, "sig").sortWithinPartitions("sig", *order)


def _starts(sig: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(sig[1:] != sig[:-1]) + 1)) if len(sig) else np.zeros(0, np.int64)


def _shared(batch: pa.RecordBatch):
    """(bucket, class) of signatures with two or more classes, repeats dropped (sorted by signature and class).

    Signatures with the same members give the same rows."""
    sig, ids = (np.asarray(c) for c in batch.columns)
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
    sig, ids = sig[new], ids[new]
    start = _starts(sig)
    size = np.diff(np.append(start, len(sig)))
    keep = np.repeat(size > 1, size)
    if keep.any():
        members = np.add.reduceat(mix64(ids.view(U64)), start) + size.astype(U64)
        bucket = np.repeat(mix64(members).view(np.int64), size)
        yield pa.RecordBatch.from_arrays([pa.array(bucket[keep]), pa.array(ids[keep])], ["sig", "set"])


def _centres(batches):
    """(a, b): the centre (first) of each signature and each member of another component; rows stream by."""
    centre = (None, None, None)
    for batch in batches:
        sig, ids, comp = (np.asarray(batch.column(i)) for i in (0, 1, 2))
        start = _starts(sig)
        if len(start) and centre[0] == sig[0]:
            start = start[1:]
        edge = np.append(np.append(0, start), len(sig)) if len(sig) else np.zeros(1, np.int64)
        for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if s == e:
                continue
            if centre[0] != sig[s]:
                centre = (sig[s], ids[s], comp[s])
            other = ids[s:e][comp[s:e] != centre[2]]
            if len(other):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(other), centre[1])), pa.array(other)], ["a", "b"])


def _mixed(rows: DataFrame) -> DataFrame:
    """(sig, set, comp, members) of the signatures whose members are in two or more components."""
    held = rows.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                   F.count(F.lit(1)).alias("members"))
    return rows.join(held.where("low <> high").select("sig", "members"), "sig")


def _block_pairs(rows: DataFrame, classes: DataFrame, once: bool) -> DataFrame:
    """The members of mixed buckets with size, sketch and (with ``once``) their smaller buckets, dealt to every
    pair of blocks they are in."""
    owned = rows.groupBy("set", "comp").agg(F.array_sort(F.collect_list(F.struct("sig", "members"))).alias("own"))
    owned = owned.join(classes.select("set", "n", "sketch"), "set").select(
        "set", "comp", "n", "sketch", "own", F.posexplode("own").alias("smaller", "o"))
    blocks = F.ceil(F.col("o.members") / BLOCK).cast("int")
    dealt = owned.select("*", blocks.alias("blocks"), F.pmod(F.xxhash64(F.lit("block"), "set"), blocks).cast("int").alias(
        "block")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.select(
        F.col("o.sig").alias("sig"), F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block",
        "set", "comp", "n", "sketch", F.slice("own.sig", F.lit(1), F.col("smaller") if once else F.lit(0)).alias("smaller")).repartition(n, "sig", "i", "j").sortWithinPartitions("sig", "i", "j", "set")


def _cross(batch: pa.RecordBatch, spanning: bool):
    """(a, b, sig, their components): pairs of one block pair in different components that sizes and sketches allow, offered in their
    first common bucket; with ``spanning``, only such as join components that earlier pairs here have not joined."""
    sig, i, j, block, ids, comp, n = (np.asarray(batch.column(k)) for k in range(7))
    key = np.stack((sig, i, j))
    edge = np.concatenate(([0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, [len(sig)]))
    left, right, where, comps = [], [], [], ([], [])
    for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
        sketches = batch.column(7).slice(s, e - s).to_pylist()
        offsets, flat = _lists(batch.column(8).slice(s, e - s))
        label, size, mine = np.unique(comp[s:e], return_inverse=True)[1], n[s:e], block[s:e]
        for x in range(e - s):
            other = np.flatnonzero((label != label[x]) & ((mine > mine[x]) if i[s] != j[s] else (np.arange(e - s) > x)))
            if not len(other):
                continue
            fit = other[may_link(int(size[x]), sketches[x], size[other], [sketches[y] for y in other.tolist()])]
            for y in fit.tolist():
                if label[x] == label[y] or len(np.intersect1d(
                        flat[offsets[x]:offsets[x + 1]], flat[offsets[y]:offsets[y + 1]], True)):
                    continue
                left.append(int(ids[s + x]))
                right.append(int(ids[s + y]))
                where.append(int(sig[s]))
                for at, k in zip((x, y), comps):
                    k.append(int(comp[s + at]))
                if spanning:
                    label[label == label[y]] = label[x]
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (left, right, where, *comps)],
                                         ["a", "b", "sig", "ca", "cb"])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.asarray(column.offsets)
    return offsets - offsets[0], np.asarray(column.flatten())


def _apart(shared: DataFrame, labels: DataFrame | None, classes: DataFrame, spanning: bool) -> DataFrame:
    """Candidates (a, b, sig, ca, cb) among the members of buckets that are in different components."""
    rows = _block_pairs(_mixed(_labelled(shared, labels)), classes, not spanning)
    return _runs(rows, partial(_cross, spanning=spanning), 3,
                 "a long, b long, sig long, ca long, cb long")


def _sketch_filter(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    side = classes.select("set", "n", "sketch")
    joined = pairs.join(side.toDF("a", "na", "ska"), "a").join(side.toDF("b", "nb", "skb"), "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b, na, nb, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "ska", "skb"))
        ok = [bool(may_link(na[i], x[i], np.array([nb[i]]), [y[i]])[0]) for i in range(len(a))]
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))

    return map_batches(joined.select("a", "b", "na", "nb", "ska", "skb"), run, "a long, b long")


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame, kind: str) -> DataFrame:
    """(set, packed): one compressed text of each of the classes."""

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = zstandard.ZstdCompressor(level=3)
        texts = [codec.compress((t or "").encode()) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(texts, pa.binary())],
                                          ["doc_id", "text_hash", "packed"])

    named = nodes.join(classes, "set").select("set", F.col("member.doc_id").alias("m"),
                                              F.col("member.text_hash").alias("h"))
    packed = map_batches(docs, pack, f"doc_id {kind}, text_hash long, packed binary")
    found = packed.join(named, (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("m")))
    return stored(found.dropDuplicates(["set"]).select("set", "packed"), "texts")


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets are linked."""
    pairs = stored(pairs, "candidates")
    joined = pairs.join(texts.toDF("a", "pa"), "a").join(texts.toDF("b", "pb"), "b")
    return map_batches(joined.select("a", "b", "pa", "pb"), _check_pairs, "a long, b long", 500)


def _check_pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
    a, b, x, y = (c.to_pylist() for c in batch.columns)
    texts = dict(zip(a, x)) | dict(zip(b, y))
    codec = zstandard.ZstdDecompressor()
    plain = pa.array([codec.decompress(t).decode() for t in texts.values()],
                     pa.large_string())
    sets = dict(zip(texts, shingle_sets(Block(plain))))
    ok = [linked(sets[i], sets[j]) for i, j in zip(a, b)]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))


def components(edges: DataFrame) -> DataFrame:
    """(set, comp): the smallest class reachable from each class that has an edge.

    Each round every class takes the smallest label around it, then the label of its label;
    labels are written to the shared folder between rounds."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("set")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), "labels")
    while True:
        around = both.join(labels.toDF("b", "comp"), "b").groupBy(F.col("a").alias("set")).agg(F.min("comp").alias("m"))
        new = labels.join(around, "set").select("set", F.least("comp", "m").alias("new"), "comp")
        jump = new.select(F.col("set").alias("new"), F.col("new").alias("next"))
        new = stored(new.join(jump, "new", "left").select(
            "set", F.least("new", F.coalesce("next", "new")).alias("new"), "comp"), "labels")
        changed = new.where(F.col("new") != F.col("comp")).limit(1).count()
        labels = new.select("set", F.col("new").alias("comp"))
        if not changed:
            return labels


def _prepared(df: DataFrame, id_col: str, text_col: str):
    """(rows with their sets, classes, buckets, in how many buckets each class is, texts of the classes in buckets)."""
    text = F.col(f"`{text_col}`").cast("string")
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = docs.schema[0].dataType.simpleString()
    base = stored(_sets_table(docs, kind), "sets")
    classes = stored(base.where(F.col("set").isNotNull()).groupBy("set").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("member"), F.min("doc_id").alias("name"),
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    shared = stored(_runs(_by_signature(_signature_rows(docs), "set"), _shared, 1, "sig long, set long").distinct(),
                    "buckets")
    degree = stored(shared.groupBy("set").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    return base, classes, shared, degree, _texts(degree.select("set"), classes, docs, kind)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links), class_id (of its set),
    component (names the component also where no id does; null without a set) and text_hash."""
    base, classes, shared, degree, texts = _prepared(df, id_col, text_col)
    rows = shared.join(degree, "set").select("sig", "set", F.col("set").alias("comp"), "degree")
    pairs = map_arrow(_by_signature(rows, F.col("degree").desc(), "set"), _centres, "a long, b long").distinct()
    pairs = _sketch_filter(pairs, classes)
    # one centre a class, that of most buckets: each text travels once
    best = pairs.join(degree.toDF("a", "degree"), "a").groupBy("b").agg(
        F.max_by("a", F.struct("degree", "a")).alias("a")).select("a", "b")
    edges, labels = _grown(None, _verify(best, texts))
    before = labels
    offered = stored(_apart(shared, before, classes, True), "offered")
    edges, labels = _grown(edges, _verify(offered.select("a", "b").distinct(), texts))
    refuted = offered.join(edges, ["a", "b"], "left_anti").select("sig").distinct()
    touched = offered.select("sig", F.explode(F.array("ca", "cb")).alias("comp")).distinct().join(
        refuted, "sig", "left_semi")
    again = stored(_labelled(shared, before).join(stored(touched, "touched"), ["sig", "comp"], "left_semi").select(
        "sig", "set"), "again")
    edges, labels = _grown(edges, _verify(_apart(again, labels, classes, False).select("a", "b"), texts))
    # names: the smallest document id of the classes of a component
    named = classes.select("set", "name").join(labels, "set", "left").select(
        "set", "name", F.coalesce("comp", "set").alias("comp"))
    least = named.groupBy("comp").agg(F.min("name").alias("component_id"))
    named = named.join(least, "comp").select("set", "component_id", F.col("comp").alias("component"))
    return base.drop("sketch").join(named, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("set").alias("class_id"), "component", "text_hash")


def class_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The whole join: (class pairs (a, b), a < b, of every link between different sets; and per row: doc_id,
    class_id and n_links, the other rows it is linked to, copies of its own set included)."""
    base, classes, shared, _, texts = _prepared(df, id_col, text_col)
    pairs = _verify(_apart(shared, None, classes, False).select("a", "b"), texts)
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "pairs")
    size = classes.select(F.col("set").alias("b"), "copies")
    both = pairs.union(pairs.select("b", "a")).join(size, "b").groupBy(F.col("a").alias("set")).agg(
        F.sum("copies").alias("others"))
    links = classes.select("set", "copies").join(both, "set", "left").select(
        "set", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return pairs, base.join(links, "set", "left").select(
        "doc_id", F.col("set").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def _labelled(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return shared.select("sig", "set", F.col("set").alias("comp"))
    return shared.join(labels, "set", "left").select("sig", "set", F.coalesce("comp", "set").alias("comp"))


def _grown(edges: DataFrame | None, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    edges = stored(more if edges is None else edges.union(more), "links")
    return edges, components(edges)


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the rows that stay: one of each component, with the smallest id (null after all others), then
    the smallest text hash; of rows equal in both, one.

    Rows without any word are linked with nothing and all stay."""
    found = near_duplicates(df, id_col, text_col)
    grouped = found.where(F.col("component").isNotNull()).groupBy("component", "doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("rows"))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    linked = grouped.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_hash", "rows"), first).alias("k")).select(
        "k.*", F.lit(False).alias("blank"))
    blank = found.where(F.col("component").isNull()).groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(True).alias("blank"))
    keep = stored(linked.unionByName(blank), "kept").toDF("__i", "__h", "__rows", "__blank")
    text = F.col(f"`{text_col}`").cast("string")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__i")) & (F.xxhash64(text) == F.col("__h"))
    copies = (F.col("__rows") > 1) & ~F.col("__blank")
    once = df.join(keep.where(~copies), same, "left_semi")
    if keep.where(copies).isEmpty():
        return once
    return once.unionByName(df.join(keep.where(copies), same, "left_semi").dropDuplicates([id_col, text_col]))
