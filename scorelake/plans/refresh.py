"""Batch refresh: raw -> bronze -> silver -> gold in one Spark application.

``refresh(spark, lake_root, raw=... | src=...)`` lands raw role frames (or
the nine CSV files under ``src``) as bronze, cleans them into silver and
rebuilds the gold tables in dependency order (S5, S6).  Each layer is
written once and the next one reads the written Parquet back, so lineage
is cut at every layer and a lost executor only re-runs the current stage.

A refresh writes a new version beside the one that serves and publishes it
last, after every role has been written: inputs are analysed before anything
is written, a failed run leaves the lake as it was, and roles that are not
refreshed keep their version. Replaced versions stay for open readers (the last
two, and any replaced within the hour, by default) and are then dropped (S5).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from scorelake.operators.clean import clean
from scorelake.plans import builders, registry
from scorelake.sources import lake
from scorelake.specs import ROLES

#: Named tables that are written side by side: a few small ones do not fill the cluster.
TABLES_AT_ONCE = 6


@dataclass
class RefreshReport:
    lake_root: str
    version: str = ""
    written: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)


def _role_chain(spark: SparkSession, root: str, role: str, frame: DataFrame) -> list[str]:
    """bronze -> silver -> gold of one role, each layer read back from Parquet."""
    lake.write_bronze(frame, root, role)  # S2
    lake.write_silver(clean(lake.read_bronze(spark, root, role), role), root, role)  # S3, C*, S4
    done = [f"bronze/{role}", f"silver/{role}"]
    rest = registry.closure(role, f"silver/{role}")[1:]
    _build(spark, role, rest, root, lambda _: root)
    return done + rest


def _build(spark: SparkSession, role: str, datasets: list[str], root: str, where: Callable[[str], str]) -> None:
    """Write these gold datasets under ``root``: chains of parent and child side by side.

    ``where`` gives the root of a parent that is not among them."""
    up = registry.parents(role)
    heads = [d for d in datasets if up[d] not in datasets]

    def chain(head: str) -> None:
        builders.BUILD[head.removeprefix("gold/").removesuffix(f"_{role}")](
            spark, where(up[head]) if up[head] not in datasets else root, root, role)
        for child in datasets:
            if up[child] == head:
                chain(child)

    _all_of(spark, [lambda d=d: chain(d) for d in heads])


def _all_of(spark: SparkSession, jobs: list, at_once: int | None = None) -> list:
    """Run jobs side by side (their job properties follow them), at most ``at_once`` of them; the first failure drops
    those not begun."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(jobs), at_once or len(jobs)))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        try:
            return [f.result() for f in futures]
        except BaseException:
            for f in futures:
                f.cancel()
            raise


def refresh(spark: SparkSession, lake_root: str, raw: dict[str, DataFrame] | None = None,
            src: str | None = None, roles=ROLES, parallel: bool = True, keep: int = 2, min_age: float = 3600.0,
            table_target: str | None = None, table_options: dict[str, str] | None = None) -> RefreshReport:
    """S1-S6 for the given roles; returns what was written and dropped.

    The dependency order of the derived tables only links tables of the same
    role, so the role chains are independent Spark jobs; they are submitted
    concurrently (one driver thread each) and share the cluster.  ``keep``
    versions of a role stay, and any that was replaced less than ``min_age``
    seconds ago, so open readers go on; ``table_target`` (a ``jdbc:`` URL or a path)
    also gets every silver and derived table under its own name (S4).
    """
    if (raw is None) == (src is None):
        raise ValueError("give exactly one of raw= or src=")
    frames = {r: (raw[r] if raw is not None else lake.read_raw_role(spark, src, r)) for r in roles}
    for r, frame in frames.items():
        clean(frame, r).schema  # all inputs are opened and analysed before anything is written
    version = lake.new_version()
    report = RefreshReport(lake_root, version)
    root = lake.version_root(lake_root, version)
    chains = [lambda r=r: _role_chain(spark, root, r, frames[r]) for r in roles]
    for names in (_all_of(spark, chains) if parallel else [c() for c in chains]):
        report.written.extend(names)
    lake.publish(spark, lake_root, version, roles)
    if table_target is not None:
        from scorelake.plans.layers import Scorecards
        write_tables(spark, Scorecards.from_lake(spark, lake_root).named_tables(roles), table_target, table_options)
    report.dropped = lake.drop_versions(spark, lake_root, keep, min_age)
    return report


def write_tables(spark: SparkSession, named: Iterable[tuple[str, DataFrame]], target: str,
                 options: dict[str, str] | None = None) -> list[str]:
    """Overwrite each (name, frame) at ``target``, ``TABLES_AT_ONCE`` of them side by side; returns the names."""
    frames = list(named)
    _all_of(spark, [lambda n=n, df=df: lake.write_table(df, target, n, options) for n, df in frames], TABLES_AT_ONCE)
    return [n for n, _ in frames]


def refresh_derived(spark: SparkSession, lake_root: str, name: str, keep: int = 2,
                    min_age: float = 3600.0) -> RefreshReport:
    """S6 for one derived name: rebuild it and what is built from it; all else keeps its version.

    The inputs are the stored ones that serve now."""
    role, datasets = _derived(name)
    ledger = lake.Ledger(spark, lake_root)

    def where(dataset: str) -> str:
        root = ledger.root_of(role, dataset)
        if root is None:
            raise ValueError(f"{dataset} is not in the lake: refresh it first")
        return root

    where(registry.parents(role)[datasets[0]])
    version = lake.new_version()
    _build(spark, role, datasets, lake.version_root(lake_root, version), where)
    lake.publish(spark, lake_root, version, datasets)
    return RefreshReport(lake_root, version, datasets, lake.drop_versions(spark, lake_root, keep, min_age))


def drop_derived(spark: SparkSession, lake_root: str, name: str) -> list[str]:
    """S5 for one derived name: it and what is built from it are gone until refreshed; readers that are open
    keep theirs."""
    _, datasets = _derived(name)
    lake.publish(spark, lake_root, lake.new_version(), datasets, live=False)
    return datasets


def _derived(name: str) -> tuple[str, list[str]]:
    """(role, the stored dataset behind a derived name and those built from it)."""
    dataset = registry.BY_NAME[name].physical if name in registry.BY_NAME else f"gold/{name}"
    try:
        role = registry.role_of(dataset)
    except StopIteration:
        raise ValueError(f"unknown derived name {name!r}") from None
    if not dataset.startswith("gold/"):
        raise ValueError(f"{name} is a view over silver: refresh its role instead")
    return role, registry.closure(role, dataset)


def land_fixture(spark: SparkSession, sf_dir: str, lake_root: str) -> dict[str, DataFrame]:
    """Derive the raw scorecards from the driver tables once and land them.

    The landed Parquet plays the part of the downloaded CSV dump: every role
    frame is read from it, so the join and aggregation behind the cards run
    once, not once per role.
    """
    from scorelake.sources import fixture
    path = f"{lake_root}/landing/scorecards"
    # every role reads all formats from here: no partitioning needed
    lake.write_dataset(fixture.scorecards(spark, sf_dir), path, partition_by=None)
    cards = spark.read.parquet(path)
    return {r: fixture.role_raw(cards, r) for r in ROLES}
