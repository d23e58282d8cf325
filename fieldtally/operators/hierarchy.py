"""Flatten path-style hierarchies ('/a/b/c/d') to one column per level."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.constants import HIERARCHY_LEVELS
from fieldtally.operators.lookup import Resolution, attach, lookup_table, resolve


def path_levels(units: DataFrame, levels: list[str] = HIERARCHY_LEVELS,
                path: str = "path", key: str = "id") -> DataFrame:
    """Add ``<level>_uid`` per path step; the lowest level falls back to the
    unit itself, so a unit reporting from higher up is its own lowest level."""
    steps = F.split(F.col(path), "/")
    uids = {f"{level}_uid": F.get(steps, F.lit(depth))
            for depth, level in enumerate(levels, start=1)}
    lowest = f"{levels[-1]}_uid"
    uids[lowest] = F.coalesce(uids[lowest], F.col(key))
    return units.withColumns(uids)


def level_names(hierarchy: DataFrame, levels: list[str] = HIERARCHY_LEVELS,
                key: str = "id", name: str = "name") -> DataFrame:
    """Add ``<level>_name`` for every ``<level>_uid``, from one shared lookup."""
    names = lookup_table(hierarchy, key, {"unit_name": name})
    for level in levels:
        hierarchy = attach(hierarchy, f"{level}_uid", names).withColumnRenamed(
            "unit_name", f"{level}_name")
    return hierarchy


def enrich_with_hierarchy(df: DataFrame, hierarchy: DataFrame, on: str = "orgunit",
                          levels: list[str] = HIERARCHY_LEVELS,
                          matched: str | None = None) -> Resolution:
    """Attach the level names of a unit; rows without a lowest-level name are
    unresolved."""
    names = {f"{level}_name": f"{level}_name" for level in levels}
    return resolve(df, hierarchy, on, names, f"{levels[-1]}_name", matched=matched)
