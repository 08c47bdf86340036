"""The Parquet lake: raw CSV scans (S1), bronze/silver/gold IO.

Layout under a lake root (any Hadoop file system path shared by the
cluster)::

    bronze/<role>/format=<fmt>/   raw text columns, as read
    silver/<role>/format=<fmt>/   cleaned, typed, de-duplicated
    gold/country_wise_<role>/format=<fmt>/
    gold/player_stats_all_formats_<role>/

``refresh`` writes a tree of this layout per version, under
``versions/<version>/``, and ``_published`` says which version serves a role or
a dataset.
Role datasets are partitioned by format, so a per-format read prunes to one
directory (``PartitionFilters``) and a role-wide read is one scan.  A write
can replace only the partitions present in the frame
(``partitionOverwriteMode=dynamic``), so re-landing one format keeps the
others.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.operators.clean import role_frame, tag_format
from scorelake.specs import FORMATS, check_format, spec

# --- fixed values: file of each (role, format) in the raw dump -------------
RAW_FILES = {
    ("batsmen", "ODI"): "Batting/ODI data.csv",
    ("batsmen", "T20"): "Batting/t20.csv",
    ("batsmen", "Test"): "Batting/test.csv",
    ("bowler", "ODI"): "Bowling/Bowling_ODI.csv",
    ("bowler", "T20"): "Bowling/Bowling_t20.csv",
    ("bowler", "Test"): "Bowling/Bowling_test.csv",
    ("fielder", "ODI"): "Fielding/Fielding_ODI.csv",
    ("fielder", "T20"): "Fielding/Fielding_t20.csv",
    ("fielder", "Test"): "Fielding/Fielding_test.csv",
}
# --- end of fixed values ----------------------------------------------------


def headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(header line, its files) of the CSV files under ``path``, by their first file.

    One aggregation over the lines, however many files there are: the header is the first line that is not blank in
    the split that begins a file. Files without a line have no header and are left out."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begins"),
        F.monotonically_increasing_id().alias("place"))  # grows with the line inside a split
    first = lines.where((F.col("begins") == 0) & (F.trim("value") != "")).groupBy("file").agg(
        F.min_by("value", "place").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return sorted(((r.header, [unquote(f) for f in r.files]) for r in found), key=lambda g: g[1])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A raw CSV file or folder with headers, every column as text (no inference pass).

    Columns bind by name: files of a folder whose headers differ are read apart and united by name.
    Schema inference would cost a full extra job per file and can type a column differently from
    batch to batch (``12.3`` overs as double); the silver step casts leniently instead.
    """
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]  # listed as URIs
    groups = [files] if len(files) == 1 else [g for _, g in headers(spark, path)]
    frames = [spark.read.option("header", True).csv(group) for group in groups if group]
    if not frames:
        raise ValueError(f"no CSV file under {path}")
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_raw_role(spark: SparkSession, src: str, role: str) -> DataFrame:
    """The three CSV files of a role as one role frame (missing columns NULL)."""
    frames = {}
    for fmt in FORMATS:
        df = read_csv(spark, f"{src}/{RAW_FILES[(role, fmt)]}")
        frames[fmt] = tag_format(df, fmt)
    return role_frame(frames)


def write_dataset(df: DataFrame, path: str, partition_by: str | None = "format",
                  only_present_partitions: bool = False) -> None:
    """Overwrite a lake dataset.

    ``only_present_partitions`` replaces just the format partitions present
    in ``df`` (dynamic partition overwrite, e.g. re-landing one format);
    otherwise the whole dataset is replaced.  The write goes through
    Spark's commit protocol: a failed or retried task leaves no output.
    """
    split = bool(partition_by) and partition_by in df.columns
    # one set of files per partition value, large ones split: not a file per task and value
    w = (df.hint("rebalance", partition_by) if split else df).write.mode("overwrite")
    if only_present_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if split:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_table(df: DataFrame, target: str, table: str | None = None,
                options: dict[str, str] | None = None) -> None:
    """Overwrite a table at ``target``.

    A ``jdbc:`` URL writes through Spark's JDBC source into ``table``
    (truncating, so the table's definition and dependants survive);
    ``catalog:<database>`` replaces a name of the session's catalog
    (``write_catalog_table``); any other target is a lake path written as Parquet.
    """
    if target.startswith("catalog:"):
        if not table:
            raise ValueError("a catalog target needs a table name")
        write_catalog_table(df, target.removeprefix("catalog:"), table)
    elif target.startswith("jdbc:"):
        if not table:
            raise ValueError("a JDBC target needs a table name")
        w = (df.write.format("jdbc").mode("overwrite").option("url", target)
             .option("dbtable", table).option("truncate", "true")
             .option("cascadeTruncate", "true"))
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        write_dataset(df, f"{target}/{table}" if table else target)


def write_catalog_table(df: DataFrame, database: str, table: str, keep: int = 2) -> str:
    """Replace a name of the catalog by a staged write; returns the table that holds the rows.

    The rows go into a managed table of their own, and the name is a view that is pointed at it once it is complete:
    a failed write leaves the name with its old rows, and readers of the table before go on (``keep`` tables stay)."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    stored = f"{table}__{new_version().replace('-', '_')}"
    try:
        df.write.format("parquet").saveAsTable(f"`{database}`.`{stored}`")
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS SELECT * FROM `{database}`.`{stored}`")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{stored}`")
        raise
    held = sorted(t.name for t in spark.catalog.listTables(database, f"{table}__*") if t.tableType == "MANAGED")
    for name in held[:-max(1, keep)]:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    return stored


def write_bronze(df: DataFrame, lake_root: str, role: str) -> None:
    """Land a raw role frame (text columns + format) as bronze."""
    write_dataset(df, f"{lake_root}/bronze/{spec(role).name}")


def read_bronze(spark: SparkSession, lake_root: str, role: str, fmt: str | None = None):
    """S3: bronze scan of a role, optionally one format (partition pruning)."""
    df = spark.read.parquet(f"{lake_root}/bronze/{spec(role).name}")
    if fmt is not None:
        df = df.where(F.col("format") == check_format(fmt, allow_all=False))
    return df


def write_silver(df: DataFrame, lake_root: str, role: str) -> None:
    write_dataset(df, f"{lake_root}/silver/{spec(role).name}")


def silver_schema(role: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in spec(role).silver))


def read_silver(spark: SparkSession, lake_root: str, role: str) -> DataFrame:
    s = spec(role)
    df = spark.read.schema(silver_schema(role)).parquet(f"{lake_root}/silver/{s.name}")
    return df.select(*[F.col(f"`{c}`") for c in s.silver_names])


def write_gold(df: DataFrame, lake_root: str, name: str) -> None:
    write_dataset(df, f"{lake_root}/gold/{name}")


def read_gold(spark: SparkSession, lake_root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A gold table; with its schema given, opening it runs no job."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(f"{lake_root}/gold/{name}")
    return df if schema is None else df.select(*schema.names)


# ------------------------------------------------------------------- versions
#: A ledger row: from this version on, a role (all its datasets) or one dataset is there, or is dropped.
_VERSIONS = "name string, version string, live boolean"


def new_version() -> str:
    """A name that sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def version_root(lake_root: str, version: str) -> str:
    return f"{lake_root}/versions/{version}"


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, path object): Spark has no public way to list or delete folders; its own client has."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def publish(spark: SparkSession, lake_root: str, version: str, names, live: bool = True) -> None:
    """Make a written version the current one of these roles or datasets, or drop them from it on.

    One file in a ledger folder of its own, so all or none; folders of dropped versions go with them."""
    rows = spark.createDataFrame([(n, version, live) for n in names], _VERSIONS)
    rows.coalesce(1).write.json(f"{lake_root}/_published/{version}")


class Ledger:
    """Which versions of a lake hold a dataset, newest first; as of when it was opened."""

    def __init__(self, spark: SparkSession, lake_root: str):
        self.root = lake_root
        found = folders(spark, f"{lake_root}/_published")
        rows = spark.read.schema(_VERSIONS).json([f"{lake_root}/_published/{v}" for v in found]).collect() if found else []
        self.rows = sorted(((r.version, r.name, r.live) for r in rows), reverse=True)

    def versions(self, role: str, dataset: str) -> list[tuple[str, bool]]:
        return [(v, live) for v, name, live in self.rows if name in (role, dataset)]

    def roles(self) -> set[str]:
        return {name for _, name, _ in self.rows if "/" not in name}

    def root_of(self, role: str, dataset: str) -> str | None:
        """The root that holds the dataset now (None: it is dropped or was never there)."""
        have = self.versions(role, dataset)
        return version_root(self.root, have[0][0]) if have and have[0][1] else None


def drop_versions(spark: SparkSession, lake_root: str, keep: int = 2, min_age: float = 3600.0,
                  orphan_age: float = 86400.0) -> list[str]:
    """Remove stale versions, with their ledger entries.

    A version stays while it is among the newest ``keep`` of any dataset, or was replaced less than
    ``min_age`` seconds ago: readers that opened it go on reading. Folders that were never published
    (failed runs) go after ``orphan_age`` seconds."""
    from scorelake.plans.registry import parents  # the datasets of a role
    ledger = Ledger(spark, lake_root)
    now = time.time_ns()
    old = {v for v, _, _ in ledger.rows}
    for role in ledger.roles():
        for dataset in parents(role):
            have = [v for v, _ in ledger.versions(role, dataset)]
            for at, v in enumerate(have):
                replaced = int(have[at - 1].split("-")[0]) if at else now
                if at < max(1, keep) or now - replaced < min_age * 1e9:
                    old.discard(v)
    dropped = []
    for v in sorted(old):
        delete(spark, f"{lake_root}/_published/{v}")  # first: nothing points at a folder that is going
        if delete(spark, version_root(lake_root, v)):
            dropped.append(v)
    known = {v for v, _, _ in ledger.rows}
    for v in folders(spark, f"{lake_root}/versions"):
        if v not in known and now - int(v.split("-")[0]) > orphan_age * 1e9:
            delete(spark, version_root(lake_root, v))
    return dropped


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    """The first rows of a frame (a sample print in the source)."""
    return df.limit(n)


def schema_report(df: DataFrame, role: str, fmt: str | None = None) -> list[str]:
    """The column list, checked against the role's silver contract by name and type."""
    from scorelake.operators.clean import format_columns
    expected = format_columns(role, fmt) if fmt else list(spec(role).silver_names)
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"{role}: missing silver columns {missing}")
    want = {f.name: f.dataType for f in silver_schema(role)}
    wrong = [f"{c}: {df.schema[c].dataType.simpleString()}" for c in expected if df.schema[c].dataType != want[c]]
    if wrong:
        raise ValueError(f"{role}: silver columns of another type: {wrong}")
    return df.columns
