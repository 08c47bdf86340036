"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Sizes are words. Sources in code-point order (null last) weigh 1, 2, 3,
repeating, and share all words by weight; a target stops at three times its
source's size and the excess is shared again by weight. Every document of a
source has the same expected number of copies, target / size of its source;
copies are the integer boundaries crossed by the running sum of expected
copies plus one random offset of the source.

The running sum is taken without gathering a source in one task: documents
fall into hash buckets of a source (about ``BUCKET_ROWS`` each, in number as
the source grows), the sums of earlier buckets come from a small table, and a
window counts inside the bucket, by size, so that sizes are spread evenly over
the sample. Offsets and order depend on ids, ``seed`` and, where sizes and ids are
equal, a hash of the text only: reruns take the same texts.

Defined results: a null text has size 0; a source without words has target 0
and its documents are not taken; null ids and repeated rows are ordered like
any others; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.store import stored

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BUCKET_ROWS = 20_000
#: The small tables (a row per source, a row per bucket) are broadcast up to so many rows, else joined.
BROADCAST_ROWS = 100_000
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("double") / float(1 << 32)


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Per source: docs, source_size, weight and target (one row per source throughout).

    With targets level * weight below the caps, sources reach their cap in the
    order of cap / weight; a source is capped if its cap is at most its share
    of what the capped ones before it leave.
    """
    by_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    by_source = by_source.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    capped = F.col("cap") * weight_left <= left * F.col("weight")
    by_source = by_source.withColumn("capped", capped).withColumn("total", total)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    rest_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        rest.cast("double") * F.col("weight") / rest_weight)
    return by_source.select("source", "docs", "source_size", "weight", target.alias("target"))


def _small(df: DataFrame, name: str) -> DataFrame:
    kept = stored(df, name)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def copies(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
           seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, and the ``carry`` columns."""
    sizes = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                      size_of(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("tie"), *carry)
    targets = _small(source_targets(sizes.select("source", "size")).select(
        F.col("source").alias("s"), "docs", "source_size", "target"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    buckets = F.ceil(F.col("docs") / F.lit(BUCKET_ROWS))
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("s"))).drop("s").select(
        "*", rate.alias("rate"), F.floor(unit_hash(F.lit(seed), key) * buckets).alias("bucket"))
    counts = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = _small(counts.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(
        F.sum("n").over(earlier), F.lit(0)).alias("before")), "buckets")
    place = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("size", "doc_id", "tie"))
    rows = rows.withColumn("place", place).join(
        counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    offset = unit_hash(F.lit(seed), F.lit("offset"), F.coalesce(F.col("source"), F.lit("")))
    rank = F.col("before") + F.col("place")
    taken = F.floor(rank * F.col("rate") + offset) - F.floor((rank - 1) * F.col("rate") + offset)
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       F.least(taken, F.lit(MOST_COPIES)).cast("int").alias("copies"), *carry)


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        seed: str = SEED) -> DataFrame:
    """The mix itself: every column of ``df`` and ``copy`` (from 1), a row per copy."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    src = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{source_col}`").alias("__source"),
                    F.col(f"`{text_col}`").alias("__text"), row)
    taken = copies(src, "__id", "__source", "__text", seed, ("__row",)).where("copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), "copies")).alias("__copy")).select(
        "__row.*", F.col("__copy").alias("copy"))
