"""Rank positions of a whole table without a global window or a sort on read.

Rows are dealt by range of their order, sorted in their parts and written; a
row's position is its place in its part plus the rows of its group in earlier
parts, which come from one row per part and group. The numbered table is stored
in blocks of ``BLOCK_ROWS`` positions (a folder each, sorted files), so any page
is a filter on the folder and on the column bounds inside its files.

Rows that tie in the whole order get positions in an arbitrary but fixed order;
callers order by enough columns. Nulls go where the order puts them. An empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Positions per stored folder.
BLOCK_ROWS = 100_000
_LOW_BITS = (1 << 33) - 1


def numbered(df: DataFrame, order: list[Column], staging: str, group: tuple[str, ...] = (),
             total: str | None = None) -> DataFrame:
    """``df`` with position (from 1, within the group), block and, if named, the group's number of rows.

    ``staging`` is a folder that the numbered rows pass through, so that parts and counts belong together;
    group columns are not null."""
    spark = df.sparkSession
    keys = [*map(F.col, group), *order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # the id's high bits are the part, its low bits the place in it
    dealt.withColumn("__at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staging)
    schema = T.StructType([*df.schema.fields, T.StructField("__at", T.LongType())])
    rows = spark.read.schema(schema).parquet(staging).withColumn("__part", F.shiftright("__at", 33)).withColumn(
        "__at", F.col("__at").bitwiseAND(_LOW_BITS))
    counts = rows.groupBy("__part", *group).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    # at most one row per part in each window: their number is that of the parts, not of the rows
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__part", *group, (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1)
                           .alias("__before"), F.sum("__n").over(Window.partitionBy(*group)).alias(total or "__total"))
    out = rows.join(before, ["__part", *group]).withColumn("position", F.col("__at") + F.col("__before"))
    return out.select(*df.columns, *([total] if total else []), "position",
                      F.floor((F.col("position") - 1) / BLOCK_ROWS).alias("block"))


def write_numbered(df: DataFrame, path: str, group: tuple[str, ...] = (), lookup: str | None = None) -> None:
    """Store a numbered table: a folder per group and block, files sorted by position, and a Bloom filter per
    file part for equality filters on ``lookup``."""
    folders = [*group, "block"]
    w = df.sortWithinPartitions(*folders, "position").write.mode("overwrite").partitionBy(*folders)
    if lookup:
        w = w.option(f"parquet.bloom.filter.enabled#{lookup}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{lookup}", str(BLOCK_ROWS))
    w.parquet(path)


def page(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` (from 1, both included) of a stored numbered table, by position.

    Only the folders and file parts that hold them are read; a page of up to a block of rows is put in order
    by one task, without a shuffle."""
    if not 1 <= first <= last:
        raise ValueError(f"a page runs from 1 on upwards, not from {first} to {last}")
    blocks = F.col("block").between((first - 1) // BLOCK_ROWS, (last - 1) // BLOCK_ROWS)
    rows = df.where(blocks & F.col("position").between(first, last))
    if last - first < BLOCK_ROWS:
        return rows.coalesce(1).sortWithinPartitions("position")
    return rows.orderBy("position")
