"""Derived-table registry: the 15 gold names, their builders and order.

Names follow the source tables.  Physically, the nine per-format country
tables are three role tables partitioned by ``format`` (one aggregation per
role instead of three), and the three all-format unions are projections of
the silver role datasets (no copy); the registry maps each name onto that.
Beside them a refresh stores what serving reads: rankings and board cards with
positions, the "All" rollup, metric flags and the index of names.
"""

from __future__ import annotations

from dataclasses import dataclass

from scorelake.specs import FORMATS, ROLES


@dataclass(frozen=True)
class Derived:
    name: str
    level: int  # 1: unions and country tables, 2: player tables (over level 1)
    role: str
    kind: str  # "union" | "country" | "player"
    fmt: str | None = None

    @property
    def physical(self) -> str:
        """Stored dataset behind the name (``None`` for views)."""
        if self.kind == "union":
            return f"silver/{self.role}"
        if self.kind == "country":
            return f"gold/country_wise_{self.role}"
        return f"gold/{self.name}"


def _names() -> list[Derived]:
    out = [Derived(f"{r}_stats", 1, r, "union") for r in ROLES]
    out += [Derived(f"{f.lower()}_{r}_stats_country_wise", 1, r, "country", f)
            for r in ROLES for f in FORMATS]
    out += [Derived(f"player_stats_all_formats_{r}", 2, r, "player") for r in ROLES]
    return out


DERIVED: tuple[Derived, ...] = tuple(_names())
BY_NAME = {d.name: d for d in DERIVED}


def refresh_order() -> list[Derived]:
    """Dependency order (level 1 before the level-2 tables built on it)."""
    return sorted(DERIVED, key=lambda d: d.level)


def parents(role: str) -> dict[str, str | None]:
    """The stored datasets of a role, each with the one it is built from, in building order."""
    return {
        f"bronze/{role}": None,
        f"silver/{role}": f"bronze/{role}",
        f"gold/country_wise_{role}": f"silver/{role}",
        f"gold/player_stats_all_formats_{role}": f"silver/{role}",
        f"gold/cards_{role}": f"silver/{role}",
        f"gold/format_ranking_{role}": f"silver/{role}",
        f"gold/availability_{role}": f"silver/{role}",
        f"gold/country_all_{role}": f"gold/country_wise_{role}",
        f"gold/ranking_{role}": f"gold/player_stats_all_formats_{role}",
        f"gold/name_index_{role}": f"gold/cards_{role}",
    }


def closure(role: str, dataset: str) -> list[str]:
    """A dataset and everything built from it, in building order."""
    up = parents(role)
    if dataset not in up:
        raise ValueError(f"{role} has no dataset {dataset!r}; expected one of {list(up)}")
    out = [dataset]
    for name, parent in up.items():
        if parent in out and name not in out:
            out.append(name)
    return out


def role_of(dataset: str) -> str:
    return next(r for r in ROLES if dataset.endswith(f"_{r}") or dataset.endswith(f"/{r}"))
