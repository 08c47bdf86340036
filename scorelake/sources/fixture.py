"""Raw scorecard frames derived from the driver's tables.

The driver ships TPC-H-style tables, not scorecards, so raw frames are made
from them: a player is a customer, the format comes from ``l_returnflag``
(A -> ODI, N -> T20, R -> Test), and one row is one (customer, format)
career built from that customer's line items.  Every cell is text, like a
CSV read without inference, and the text plants the cases cleaning has to
handle: ``-`` markers, not-out ``*``, ``ICC/`` prefixes, unknown codes,
missing brackets, overs without a dot, and whole-row duplicates.

The same derivation exists as DuckDB SQL in ``oracle.sql`` (the correctness
oracle); the arithmetic is on integers so both engines print equal text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.specs import FORMATS, spec

_BASE_AGGS = [
    "count(DISTINCT l_orderkey) AS mat",
    "count(*) AS inns",
    "CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS runs",
    "max(CAST(l_quantity AS INT)) AS hs",
    "min(year(l_shipdate)) AS y0",
    "max(year(l_shipdate)) AS y1",
    "count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS n_o",
    "count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n_w",
    "count(CASE WHEN l_tax < 0.03 THEN 1 END) AS n_t",
    "count(CASE WHEN l_quantity > 40 THEN 1 END) AS q40",
    "count(CASE WHEN l_quantity > 25 THEN 1 END) AS q25",
    "count(CASE WHEN l_quantity < 5 THEN 1 END) AS q5",
    "count(CASE WHEN l_linenumber = 1 THEN 1 END) AS l1",
    "count(CASE WHEN l_linenumber = 2 THEN 1 END) AS l2",
    "count(CASE WHEN l_linenumber > 2 THEN 1 END) AS l3",
]

# exact integers: hundredths, truncated
_HUNDREDTHS = [
    "CAST((runs*100 - (runs*100) % inns) / inns AS BIGINT) AS h_ave",
    "CAST((runs*10000 - (runs*10000) % (runs+inns)) / (runs+inns) AS BIGINT) AS h_sr",
    "CAST((inns*600 - (inns*600) % (mat+1)) / (mat+1) AS BIGINT) AS h_eco",
    "CAST((runs*100 - (runs*100) % nullif(n_w,0)) / nullif(n_w,0) AS BIGINT) AS h_bave",
    "CAST((runs*70 - (runs*70) % nullif(n_w,0)) / nullif(n_w,0) AS BIGINT) AS h_bsr",
]


def _two_dp(h: str) -> str:
    return (f"concat(CAST(CAST(floor({h} / 100) AS BIGINT) AS STRING), '.', "
            f"lpad(CAST({h} % 100 AS STRING), 2, '0'))")


_CELLS = [
    "concat(c_name, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat(' (', "
    "CASE WHEN c_custkey % 5 = 0 THEN 'ICC/' ELSE '' END, "
    "CASE c_nationkey % 6 WHEN 0 THEN 'INDIA' WHEN 1 THEN 'AUS' WHEN 2 THEN 'USA' "
    "WHEN 3 THEN 'SL' WHEN 4 THEN 'XYZ' ELSE 'PAK' END, ')') END) AS Player",
    "CASE rf WHEN 'A' THEN 'ODI' WHEN 'N' THEN 'T20' ELSE 'Test' END AS format",
    "concat(CAST(y0 AS STRING), '-', CAST(y1 AS STRING)) AS Span",
    "CAST(mat AS STRING) AS Mat",
    "CAST(inns AS STRING) AS Inns",
    "CAST(runs AS STRING) AS Runs",
    # batting
    "CAST(n_o AS STRING) AS NO",
    "CASE WHEN inns % 7 = 0 THEN '-' ELSE concat(CAST(hs AS STRING), "
    "CASE WHEN inns % 2 = 0 THEN '*' ELSE '' END) END AS HS",
    f"CASE WHEN inns % 5 = 0 THEN '-' ELSE {_two_dp('h_ave')} END AS Ave",
    "CASE WHEN inns % 9 = 0 THEN '-' ELSE CAST(runs + inns AS STRING) END AS BF",
    f"CASE WHEN inns % 9 = 0 THEN '-' ELSE {_two_dp('h_sr')} END AS SR",
    "CAST(q40 AS STRING) AS `100`",
    "CAST(q25 AS STRING) AS `50`",
    "CAST(q5 AS STRING) AS `0`",
    "CAST(l1 AS STRING) AS `4s`",
    "CAST(l2 AS STRING) AS `6s`",
    # bowling: Runs as above; b_ave and b_sr are its Ave and SR
    "CAST(runs AS STRING) AS Balls",
    "CASE WHEN inns % 8 = 0 THEN CAST(CAST(floor(runs / 6) AS BIGINT) AS STRING) "
    "ELSE concat(CAST(CAST(floor(runs / 6) AS BIGINT) AS STRING), '.', "
    "CAST(runs % 6 AS STRING)) END AS Overs",
    "CAST(n_t AS STRING) AS Mdns",
    "CAST(n_w AS STRING) AS Wkts",
    "concat(CAST(n_w AS STRING), '/', CAST(hs AS STRING)) AS BBI",
    "concat(CAST(n_w + 1 AS STRING), '/', CAST(runs AS STRING)) AS BBM",
    f"CASE WHEN n_w = 0 THEN '-' ELSE {_two_dp('h_bave')} END AS b_ave",
    f"CASE WHEN inns % 9 = 0 THEN '-' ELSE {_two_dp('h_eco')} END AS Econ",
    f"CASE WHEN n_w = 0 THEN '-' ELSE {_two_dp('h_bsr')} END AS b_sr",
    "CAST(q25 AS STRING) AS `4`",
    "CAST(q40 AS STRING) AS `5`",
    "CAST(q5 AS STRING) AS `10`",
    # fielding
    "CASE WHEN inns % 7 = 0 THEN '-' ELSE CAST(l1 + l2 AS STRING) END AS Dis",
    "CAST(l1 AS STRING) AS Ct",
    "CAST(l2 AS STRING) AS St",
    "CAST(l3 AS STRING) AS `Ct Wk`",
    "CAST(l1 AS STRING) AS `Ct Fi`",
    "CAST(hs AS STRING) AS MD",
    "'0.5' AS `D/I`",
]

#: Line items that a task joins and aggregates: what it keeps in memory does not grow with the tables.
TASK_ROWS = 500_000

# Role-specific renames of the shared raw cells (bowling's own Ave and SR).
_ROLE_ALIASES = {"bowler": {"Ave": "b_ave", "SR": "b_sr"}}


def _in_tasks(li: DataFrame, li_key: str, orders: DataFrame, orders_key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt by the order key into tasks of about ``TASK_ROWS`` line items; few rows stay as they are.

    Left to itself, adaptive execution merges shuffled parts up to a size in bytes, and as these compress well a
    task would sort and aggregate millions of rows in memory."""
    spark = li.sparkSession
    rows = li.count()  # from the file footers
    if rows <= TASK_ROWS * spark.sparkContext.defaultParallelism:
        return li, orders
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    return li.repartition(n, li_key), orders.repartition(n, orders_key)


def scorecards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw cells of all roles, one row per (customer, format) + duplicates.

    Plan: line items join orders on the order key (sort-merge at scale; both
    sides are large), a hash aggregate per (customer, return flag) whose
    partial step runs before the shuffle, then a join with the customers.
    ``count(DISTINCT l_orderkey)`` needs no extra shuffle: the join output
    is already clustered by the order key.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey")
    li, orders = _in_tasks(li, "l_orderkey", orders, "o_orderkey")
    base = (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .groupBy(F.col("o_custkey").alias("k"), F.col("l_returnflag").alias("rf"))
            .agg(*[F.expr(e) for e in _BASE_AGGS]))
    h = base.selectExpr("*", *_HUNDREDTHS)
    once = h.join(customer, h.k == customer.c_custkey).selectExpr(*_CELLS)
    # planted whole-row duplicates: a second copy of some rows, generated in
    # place instead of a self-union (which would run the join twice)
    twice = F.expr("length(Player) % 2 = 0 AND Runs LIKE '%3'")
    return (once.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(twice, 2).otherwise(1))))
            .drop("__copy"))


def role_raw(cards: DataFrame, role: str) -> DataFrame:
    """Role frame: the role's raw headers (NULL where a format lacks one) + format."""
    s = spec(role)
    aliases = _ROLE_ALIASES.get(role, {})
    cols = []
    for c in s.raw_columns:
        src = F.col(f"`{aliases.get(c, c)}`")
        having = [f for f in FORMATS if c in s.raw_by_format[f]]
        if len(having) < len(FORMATS):
            src = F.when(F.col("format").isin(*having), src)
        cols.append(src.alias(c))
    return cards.select(*cols, "format")


def format_raw(cards: DataFrame, role: str, fmt: str) -> DataFrame:
    """One (role, format) raw frame with exactly that file's columns (§1)."""
    s = spec(role)
    aliases = _ROLE_ALIASES.get(role, {})
    return cards.where(F.col("format") == fmt).select(
        *[F.col(f"`{aliases.get(c, c)}`").alias(c) for c in s.raw_by_format[fmt]])
