"""Writers of the stored gold datasets: each reads its one parent from ``source`` and writes under ``root``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.operators import board, gold, positions, serve
from scorelake.sources import lake
from scorelake.specs import FORMATS


def _staged(spark: SparkSession, df: DataFrame, order: list, root: str, name: str, group: tuple[str, ...] = (),
            total: str | None = None, lookup: str | None = None) -> None:
    """Number a table and store it; the staging folder goes afterwards."""
    staging = f"{root}/staging/{name}"
    positions.write_numbered(positions.numbered(df, order, staging, group, total), f"{root}/gold/{name}", group, lookup)
    lake.delete(spark, staging)


def country_wise(spark: SparkSession, source: str, root: str, role: str) -> None:
    lake.write_gold(gold.country_wise(lake.read_silver(spark, source, role), role), root, f"country_wise_{role}")


def country_all(spark: SparkSession, source: str, root: str, role: str) -> None:
    """G13-G15 from the stored country table."""
    table = lake.read_gold(spark, source, f"country_wise_{role}", schema(spark, role, "country_wise"))
    lake.write_gold(serve.country_stats(table, role), root, f"country_all_{role}")


def player_stats_all_formats(spark: SparkSession, source: str, root: str, role: str) -> None:
    silver = lake.read_silver(spark, source, role)
    lake.write_gold(gold.player_all_formats(gold.union_stats(silver, role), role), root, f"player_stats_all_formats_{role}")


def ranking(spark: SparkSession, source: str, root: str, role: str) -> None:
    """The player table in ranking order, with positions."""
    table = lake.read_gold(spark, source, f"player_stats_all_formats_{role}")
    _staged(spark, table, serve.ranking_order(role), root, f"ranking_{role}", lookup="full_name")


def cards(spark: SparkSession, source: str, root: str, role: str) -> None:
    """T9 and the values of B3-B9: a card per format and player, best first."""
    rows = board.board_rows(lake.read_silver(spark, source, role), role)
    _staged(spark, board.cards(rows, role), board.card_order(), root, f"cards_{role}", ("format",), "players", "full_name")


def name_index(spark: SparkSession, source: str, root: str, role: str) -> None:
    """Postings sorted by trigram in their files, so that a search reads the file parts of its trigrams.

    The cards are dealt, ``INDEX_CARDS`` neighbours by position together, and not their postings, of which
    there are many to a card. Each run of neighbours is a task of its own, so that what a task sorts does not
    grow with the cards."""
    held = lake.read_gold(spark, source, f"cards_{role}").select("format", "position", "full_name", "value", "country")
    formats = F.array(*[F.lit(f) for f in FORMATS])
    at = F.floor(F.col("position") / INDEX_CARDS) * (len(FORMATS) + 1) + F.array_position(formats, F.col("format"))
    last = held.agg(F.max(at)).first()[0]
    parts = 1 if last is None else last + 1
    index = board.postings(held.repartitionById(parts, at.cast("int"))).sortWithinPartitions("format", "gram", "position")
    index.write.mode("overwrite").partitionBy("format").parquet(f"{root}/gold/name_index_{role}")


def format_ranking(spark: SparkSession, source: str, root: str, role: str) -> None:
    """T5: each format's player rows in ranking order, with positions."""
    rows = board.board_rows(lake.read_silver(spark, source, role), role)
    shown = board.format_ranking_rows(rows, role)
    _staged(spark, shown, board.format_ranking_order(role), root, f"format_ranking_{role}", ("format",))


def availability(spark: SparkSession, source: str, root: str, role: str) -> None:
    """B2: one row of flags."""
    rows = board.board_rows(lake.read_silver(spark, source, role), role)
    board.availability_flags(rows, role).coalesce(1).write.mode("overwrite").parquet(f"{root}/gold/availability_{role}")


#: Cards of a format that stand in one sorted file of the name index.
INDEX_CARDS = 50_000

_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def schema(spark: SparkSession, role: str, dataset: str) -> T.StructType:
    """The columns of a stored dataset, without a job and without a look at its files (worked out once)."""
    kind = dataset.removeprefix("gold/").removesuffix(f"_{role}")
    if (role, kind) not in _SCHEMAS:
        silver = spark.createDataFrame([], lake.silver_schema(role))
        rows = board.board_rows(silver, role)
        place = [F.lit(None).cast("long").alias(c) for c in ("position", "block")]

        def numbered_cards() -> DataFrame:
            return board.cards(rows, role).select("*", F.lit(None).cast("long").alias("players"), *place)

        frame = {
            "country_wise": lambda: gold.country_wise(silver, role),
            "country_all": lambda: serve.country_stats(gold.country_wise(silver, role), role),
            "player_stats_all_formats": lambda: gold.player_all_formats(gold.union_stats(silver, role), role),
            "ranking": lambda: gold.player_all_formats(gold.union_stats(silver, role), role).select("*", *place),
            "cards": numbered_cards,
            "name_index": lambda: board.postings(numbered_cards()),
            "format_ranking": lambda: board.format_ranking_rows(rows, role).select("*", *place),
            "availability": lambda: board.availability_flags(rows, role),
        }[kind]()
        _SCHEMAS[role, kind] = frame.schema
    return _SCHEMAS[role, kind]


BUILD = {f.__name__: f for f in (country_wise, country_all, player_stats_all_formats, ranking, cards, name_index,
                                 format_ranking, availability)}
