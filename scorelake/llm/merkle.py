"""Merkle manifest of a table, and the climb that checks rows against its root.

A row's leaf is the SHA-256 of its columns in order, each ``-`` if null, else
its UTF-8 length in bytes, ``:`` and its value, so that no two rows read alike.
Within each group (language) leaves stand in id order; every ``FAN`` consecutive
nodes become the hash of their digests as hex text until one, the subroot, is
left, and the subroots, in group order, make the root by the same rule.

*Building.* Leaves are numbered without a global window: they are dealt by
range, sorted and written; a row's number is its place in its file part plus
the rows of its group in earlier parts, from one small table of counts. Each
level is an aggregation by (group, place div FAN), that is of at most FAN rows,
and is written as node rows: the joined digests of its children, its own
digest, and the link (tree, level, place) to its parent, which leads from a
subroot into the tree of roots.

*Climbing.* A recursive SQL query starts at every leaf with its (perhaps
tampered) digest and follows the parent links: it puts the digest in its place
among the children, folds them to the parent's digest and appends the siblings
to the proof. Leaves of one run share the path above them, so a climbing row
holds the digests of up to FAN leaves and their common proof once: with a row a
leaf, proofs alone would move over 6 times the input. Near the root all leaves
meet in a few nodes; nodes are therefore repeated per block of ``BLOCK``
leaves below them (few rows) and joined by block, so no join key holds more
than a block, however large a group is.

Defined results: null ids come first; rows equal in group and id stand in the
order of their leaves; wholly equal rows are leaves of their own with the same
digest; a group of one row has that leaf as subroot; a single group's subroot
is the root; a null condition of ``lowered`` tampers with nothing; empty and
very long texts are hashed whole; an empty table has no rows and no root.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.store import stored

FAN = 8
#: Leaves below one key of the climb's join (a power of FAN).
BLOCK = FAN ** 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Name of the tree over the groups' roots; groups are named '' (null) or '=' and their value.
TOP = "^"
#: monotonically_increasing_id holds the place in the part in its low bits.
_LOW_BITS = (1 << 33) - 1


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (binary) of the columns with their lengths."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(part, columns)).cast("binary"), 256))


def _hash(digests: Column) -> Column:
    """SHA-256 (binary) of binary digests written as lower-case hex."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)).cast("binary"), 256))


def _joined(digests: Column) -> Column:
    return F.unhex(F.array_join(F.transform(digests, lambda d: F.hex(d)), ""))


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with pos (place within the group, from 0, in the given order) and n (rows of the group).

    ``group`` is not null. Rows are dealt by range and written sorted; ties are told apart by their place
    in the input, so that equal rows do not meet in one part."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order, "_tie"]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    dealt = stored(dealt.sortWithinPartitions(*keys).drop("_tie").withColumn(
        "_at", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(_LOW_BITS))
    counts = stored(dealt.groupBy("_part", group).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_at").alias("_first")), f"{name}-counts")
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", group, "_first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_before"),
                           F.sum("rows").over(Window.partitionBy(group)).alias("n"))
    return dealt.join(before, ["_part", group]).withColumn(
        "pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


@dataclass
class Manifest:
    """``runs``: home (the group), run, size (its leaves), rank among the groups, groups, and the run's leaves
    (pos, id, leaf, altered), in order; ``nodes``: home, block, tree, level, idx, n (nodes of its level),
    children, digest, and the parent's p_tree, p_level, p_idx with this node's p_place there (null at the root)."""

    runs: DataFrame
    nodes: DataFrame


def build(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS,
          altered: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table. ``altered`` gives, per column, what a tamperer puts in its place."""
    spark = df.sparkSession
    altered = altered or {}
    group = F.col(f"`{group_col}`").cast("string")
    plain = leaf_digest([F.col(f"`{c}`") for c in columns])
    other = leaf_digest([altered.get(c, F.col(f"`{c}`")) for c in columns]) if altered else plain
    leaves = stored(df.select(F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("home"),
                              F.col(f"`{id_col}`").alias("id"), plain.alias("leaf"), other.alias("altered")), "leaves")
    leaves = numbered(leaves, "home", ["id", "leaf"], "ordered")
    homes = numbered(leaves.groupBy("home").agg(F.first("n").alias("size")).withColumn("tree", F.lit(TOP)),
                     "tree", ["home"], "homes")
    homes = stored(homes.select("home", "size", F.col("pos").alias("rank"), F.col("n").alias("groups")), "ranks")
    runs = leaves.groupBy("home", F.floor(F.col("pos") / FAN).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "id", "leaf", "altered"))).alias("leaves"))
    runs = stored(runs.join(homes, "home"), "runs")
    most = homes.agg(F.max("size").alias("size"), F.max("groups").alias("groups")).first()
    trees = _levels(runs.select("home", F.col("home").alias("tree"), F.col("run").alias("idx"), "size", "rank", "groups",
                                F.col("size").alias("n"), _joined(F.col("leaves.leaf")).alias("children")), most["size"])
    subroots = runs.where(F.col("size") == 1).select("rank", "groups", F.col("leaves")[0]["leaf"].alias("digest"))
    for _, level in trees:
        subroots = subroots.unionByName(level.where(F.col("n") == 1).select("rank", "groups", "digest"))
    crown = subroots.groupBy(F.floor(F.col("rank") / FAN).alias("idx")).agg(
        F.first("groups").alias("n"), F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("d"))
    crown = _levels(crown.select(
        F.lit(TOP).alias("home"), F.lit(TOP).alias("tree"), "idx", F.lit(0).cast("long").alias("size"),
        F.lit(0).cast("long").alias("rank"), F.lit(0).cast("long").alias("groups"), "n",
        _joined(F.col("d.digest")).alias("children")), most["groups"])
    return Manifest(runs, stored(_linked(trees, crown, homes), "nodes"))


def _levels(first: DataFrame, most: int | None) -> list[tuple[int, DataFrame]]:
    """(level, its nodes), from the joined digests of each run of level 0; n becomes the nodes of the level."""
    out, level = [], 0
    rows = first.where(F.col("n") > 1)
    while (most or 0) > 1:
        level, most = level + 1, math.ceil(most / FAN)
        nodes = stored(rows.select(
            "home", "tree", "idx", "size", "rank", "groups", F.ceil(F.col("n") / FAN).alias("n"), "children",
            _hash(F.col("children")).alias("digest")), f"level{level}")
        out.append((level, nodes))
        up = nodes.where(F.col("n") > 1).groupBy("home", "tree", F.floor(F.col("idx") / FAN).alias("up")).agg(
            *(F.first(c).alias(c) for c in ("size", "rank", "groups", "n")),
            F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("d"))
        rows = up.select("home", "tree", F.col("up").alias("idx"), "size", "rank", "groups", "n",
                         _joined(F.col("d.digest")).alias("children"))
    return out


def _linked(trees: list, crown: list, homes: DataFrame) -> DataFrame:
    """Node rows with their parent links, one per block of leaves below them."""
    spark = homes.sparkSession
    out = spark.createDataFrame([], "home string, block long, tree string, level int, idx long, n long, children binary, "
                                "digest binary, p_tree string, p_level int, p_idx long, p_place int")
    more, into = F.col("n") > 1, F.col("groups") > 1
    for k, level in trees:
        span = FAN ** k
        last = F.least((F.col("idx") + 1) * span, F.col("size")) - 1
        out = out.unionByName(level.select(
            "home", F.explode(F.sequence(F.floor(F.col("idx") * span / BLOCK), F.floor(last / BLOCK))).alias("block"),
            "tree", F.lit(k).alias("level"), "idx", "n", "children", "digest",
            F.when(more, F.col("tree")).when(into, F.lit(TOP)).alias("p_tree"),
            F.when(more, k + 1).when(into, 1).alias("p_level"),
            F.when(more, F.floor(F.col("idx") / FAN)).when(into, F.floor(F.col("rank") / FAN)).alias("p_idx"),
            F.when(more, F.col("idx") % FAN).when(into, F.col("rank") % FAN).cast("int").alias("p_place")))
    blocks = homes.select("home", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("size") - 1) / BLOCK))).alias("block"), "rank")
    for k, level in crown:
        below = blocks.select("home", "block", F.floor(F.col("rank") / FAN ** k).alias("idx"))
        out = out.unionByName(level.drop("home").join(below, "idx").select(
            "home", "block", "tree", F.lit(k).alias("level"), "idx", "n", "children", "digest",
            F.when(more, F.col("tree")).alias("p_tree"), F.when(more, k + 1).alias("p_level"),
            F.when(more, F.floor(F.col("idx") / FAN)).alias("p_idx"),
            F.when(more, F.col("idx") % FAN).cast("int").alias("p_place")))
    return out


#: The climb. A leaf's own place among the children is its place in its run (place is null until the first step);
#: later steps share the place. ``reached`` is the true digest of the node climbed to, so in the end the root.
CLIMB = f"""
WITH RECURSIVE climb (home, block, run, tree, level, idx, place, folded, proof, subroot, reached) AS (
  SELECT home, CAST(floor(run / {BLOCK // FAN}) AS BIGINT), run,
    CASE WHEN size > 1 THEN home WHEN groups > 1 THEN '{TOP}' END,
    CASE WHEN size > 1 OR groups > 1 THEN 1 END,
    CASE WHEN size > 1 THEN run WHEN groups > 1 THEN CAST(floor(rank / {FAN}) AS BIGINT) END,
    CASE WHEN size = 1 AND groups > 1 THEN CAST(rank % {FAN} AS INT) END,
    leaves.altered, X'', CASE WHEN size = 1 THEN leaves[0].leaf END, leaves[0].leaf
  FROM {{runs}}
  UNION ALL
  SELECT c.home, c.block, c.run, n.p_tree, n.p_level, n.p_idx, n.p_place,
    transform(c.folded, (h, i) -> unhex(sha2(CAST(lower(hex(concat(
      substring(n.children, 1, 32 * coalesce(c.place, i)), h,
      substring(n.children, 32 * coalesce(c.place, i) + 33)))) AS BINARY), 256))),
    CASE WHEN c.place IS NULL THEN c.proof ELSE concat(
      c.proof, substring(n.children, 1, 32 * c.place), substring(n.children, 32 * c.place + 33)) END,
    CASE WHEN n.tree <> '{TOP}' AND n.n = 1 THEN n.digest ELSE c.subroot END, n.digest
  FROM climb c JOIN {{nodes}} n
    ON c.home = n.home AND c.block = n.block AND c.tree = n.tree AND c.level = n.level AND c.idx = n.idx)
SELECT home, run, folded, proof, subroot, reached FROM climb WHERE tree IS NULL LIMIT ALL"""


def climb(manifest: Manifest) -> DataFrame:
    """Per row of the table: id, leaf, subroot, root, proof (digests of the siblings, joined, binary), and
    folded_root (from the altered leaf). Digests are binary."""
    spark = manifest.runs.sparkSession
    up = stored(spark.sql(CLIMB, runs=manifest.runs, nodes=manifest.nodes), "climbed")
    rows = manifest.runs.select("home", "run", "leaves").join(up, ["home", "run"])
    rows = rows.withColumn("near", _joined(F.col("leaves.leaf"))).select(
        F.posexplode(F.arrays_zip(F.col("leaves.id").alias("id"), F.col("leaves.leaf").alias("leaf"), "folded")).alias(
            "at", "own"), "near", "proof", "subroot", "reached")
    return rows.select(
        "own.id", "own.leaf", "subroot", F.col("reached").alias("root"),
        F.concat(F.expr("substring(near, 1, at * 32)"), F.expr("substring(near, at * 32 + 33)"), "proof").alias("proof"),
        F.col("own.folded").alias("folded_root"))


def verify(manifest: Manifest) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (lower-case hex), verified."""
    def text(c: str) -> Column:
        return F.lower(F.hex(c))

    return climb(manifest).select(
        F.col("id").alias("doc_id"), *(text(c).alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(text("proof").cast("binary"), 256).alias("proof_sha256"), text("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"))


def lowered(text: Column, rows: Column) -> Column:
    """``text`` with A-Z lower-cased in ``rows``, as a tamperer would."""
    return F.when(F.coalesce(rows, F.lit(False)), F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(text)
