"""The medallion pipeline as lazy DataFrames.

``Scorecards`` resolves every layer by name for one source of raw role
frames: silver (cleaned), the gold tables, the serving and board rows.  It
builds plans only; nothing runs until the caller acts on a frame.  The same
object is built either from raw frames (``from_raw``/``from_fixture``) or
from a refreshed lake (``from_lake``), where silver and gold are read back
from Parquet instead of being recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.operators import board, gold, positions, serve
from scorelake.operators.clean import clean, format_columns
from scorelake.plans import builders, registry
from scorelake.sources import fixture, lake
from scorelake.specs import ALL, FORMATS, ROLES, spec


class Scorecards:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame] | None = None,
                 lake_root: str | None = None):
        self.spark = spark
        self._raw = raw or {}
        # the versions are looked up once: a reader keeps to them while newer ones are published
        self._ledger = lake.Ledger(spark, lake_root) if lake_root else None
        self._silver: dict[str, DataFrame] = {}

    # ---------------------------------------------------------------- builders
    @classmethod
    def from_raw(cls, spark: SparkSession, raw: dict[str, DataFrame]) -> "Scorecards":
        return cls(spark, raw=raw)

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str) -> "Scorecards":
        cards = fixture.scorecards(spark, sf_dir)
        return cls(spark, raw={r: fixture.role_raw(cards, r) for r in ROLES})

    @classmethod
    def from_lake(cls, spark: SparkSession, lake_root: str) -> "Scorecards":
        return cls(spark, lake_root=lake_root)

    # ------------------------------------------------------------------ layers
    def raw(self, role: str) -> DataFrame:
        return self._raw[spec(role).name]

    def silver(self, role: str) -> DataFrame:
        role = spec(role).name
        if role not in self._silver:
            if self.stored(role):
                self._silver[role] = lake.read_silver(self.spark, self._root(role, f"silver/{role}"), role)
            else:
                self._silver[role] = clean(self.raw(role), role)
        return self._silver[role]

    def union(self, role: str) -> DataFrame:
        return gold.union_stats(self.silver(role), role)

    def country_table(self, role: str) -> DataFrame:
        """G1-G9 of a role as one frame (all formats)."""
        if self.stored(role):
            return self._gold(role, f"country_wise_{role}")
        return gold.country_wise(self.silver(role), role)

    def player_table(self, role: str) -> DataFrame:
        """G10-G12."""
        if self.stored(role):
            return self._gold(role, f"player_stats_all_formats_{role}")
        return gold.player_all_formats(self.union(role), role)

    def stored(self, role: str) -> bool:
        """Whether a refresh has stored this role."""
        return self._ledger is not None and role in self._ledger.roles()

    def _root(self, role: str, dataset: str) -> str:
        root = self._ledger.root_of(role, dataset)
        if root is None:
            raise ValueError(f"{dataset} was dropped from the lake: refresh it first")
        return root

    def _gold(self, role: str, name: str) -> DataFrame:
        """A stored gold table, opened with the schema that its builder gives."""
        if not self.stored(role):
            raise ValueError(f"{name} is stored by a refresh and read from its lake")
        schema = builders.schema(self.spark, role, f"gold/{name}")
        return lake.read_gold(self.spark, self._root(role, f"gold/{name}"), name, schema)

    def table(self, name: str) -> DataFrame:
        """Full read of a derived table by its name."""
        d = registry.BY_NAME[name]
        if d.kind == "union":
            return self.union(d.role)
        if d.kind == "country":
            return gold.country_wise_format(self.country_table(d.role), d.fmt)
        return self.player_table(d.role)

    def register_views(self, prefix: str = "") -> list[str]:
        """S7 for SQL: temp views named like the source tables.

        The 15 derived names and the nine per-format silver tables
        (``batsmen_odi`` ...), each a lazy frame; a format's silver view
        keeps that format's columns only (the DDL shape).
        """
        names = []
        for name, df in self.named_tables():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def named_tables(self, roles=ROLES):
        """(name, frame) of the derived and the per-format silver tables of these roles."""
        for d in registry.DERIVED:
            if d.role in roles:
                yield d.name, self.table(d.name)
        for role in roles:
            for fmt in FORMATS:
                cols = [F.col(f"`{c}`") for c in format_columns(role, fmt)]
                yield f"{role}_{fmt.lower()}", self.silver(role).where(F.col("format") == fmt).select(*cols)

    # ----------------------------------------------------------------- serving
    def players(self, role: str, fmt: str = "All") -> DataFrame:
        return serve.players(self.silver(role), role, fmt)

    def country_stats(self, role: str, fmt: str = "All", country: str | None = None):
        role = spec(role).name
        if fmt == ALL and self.stored(role):  # G13-G15 as stored by the refresh
            out = self._gold(role, f"country_all_{role}")
            return out.where(F.col("country") == F.lit(country)) if country else out
        return serve.country_stats(self.country_table(role), role, fmt, country)

    def rankings(self, role: str) -> DataFrame:
        """T1-T3; of a lake by the stored position."""
        role = spec(role).name
        if self.stored(role):
            return self._gold(role, f"ranking_{role}").drop("block").orderBy("position").drop("position")
        return serve.rankings(self.player_table(role), role)

    def stored_ranking(self, role: str) -> DataFrame:
        """The stored ranking with its positions, in no order."""
        role = spec(role).name
        return self._gold(role, f"ranking_{role}").drop("block")

    def ranking_page(self, role: str, first: int = 1, last: int = 25) -> DataFrame:
        """Rows ``first`` to ``last`` of a stored ranking, with their position."""
        role = spec(role).name
        return positions.page(self._gold(role, f"ranking_{role}"), first, last).drop("block")

    def format_ranking_page(self, role: str, fmt: str, first: int = 1, last: int = 25) -> DataFrame:
        """T5: rows ``first`` to ``last`` of a format's stored ranking, with their position."""
        role = spec(role).name
        rows = board.relevant(self._gold(role, f"format_ranking_{role}"), fmt)
        return positions.page(rows, first, last).select("position", *spec(role).ranking_columns)

    def ranked_page(self, role: str, fmt: str, first: int = 1, last: int = 25) -> DataFrame:
        """Players ``first`` to ``last`` by the primary metric, with their position."""
        cards = board.relevant(self.board(role), fmt)
        return positions.page(cards, first, last).select("position", "full_name", "value", "country")

    def rows(self, role: str) -> DataFrame:
        """Board rows of a role (all formats)."""
        return board.board_rows(self.silver(role), role)

    def board(self, role: str) -> board.Board:
        """The stored board of a role, which every board function takes in place of its rows."""
        role = spec(role).name
        return board.Board(self._gold(role, f"cards_{role}"), self._gold(role, f"availability_{role}"),
                           self._gold(role, f"name_index_{role}"))
