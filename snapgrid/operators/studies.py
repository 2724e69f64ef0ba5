"""Studies of how attributes vary between and within entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.operators.rows import lookup_join


def distinct_per_group(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Distinct values per group and column; null groups and null values do not count."""
    rows = df.filter(F.col(group).isNotNull())
    return rows.groupBy(group).agg(*[F.countDistinct(c).alias(f"{c}_unique") for c in columns])


def varying_groups(summary: DataFrame, columns: list[str]) -> DataFrame:
    """The groups with more than one value in any of the columns."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | (F.col(f"{c}_unique") > 1)
    return summary.filter(hit)


def varying_totals(summary: DataFrame, columns: list[str]) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("groups"), *[F.count_if(F.col(f"{c}_unique") > 1).alias(f"{c}_vary") for c in columns]
    )


def combo_frequencies(df: DataFrame, columns: list[str], entity: str, group: str | None = None) -> DataFrame:
    """Distinct entities per attribute combination, optionally per group; null keys are left out."""
    keys = ([group] if group else []) + columns
    for c in keys:
        df = df.filter(F.col(c).isNotNull())
    return df.groupBy(*keys).agg(F.countDistinct(entity).alias("count"))


def multi_combo_groups(df: DataFrame, columns: list[str], entity: str, group: str) -> DataFrame:
    """The combinations of groups that have several, with the group's number of entities.

    Combinations are already counted here, so what is joined is small next to the rows. They are read
    twice with the same columns, so that they are counted once.
    """
    combos = combo_frequencies(df, columns, entity, group)
    sizes = combos.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    several = sizes.filter("_n > 1").select(group)
    entities = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.countDistinct(entity).alias("entities"))
    lookup = several.join(entities, group, "left").withColumn("entities", F.coalesce("entities", F.lit(0)))
    return lookup_join(combos, lookup, [group], "inner").select(group, *columns, "count", "entities")


def change_history(df: DataFrame, entity: str, columns: list[str], shown: list[str]) -> DataFrame:
    """All entries of the entities whose combination changed (null counts as a value).

    The timeline stays long, one row per distinct entry with its number of ``copies``, instead of one
    list per entity: a third of all rows may belong to one entity, or be copies of one entry. Sort by
    entity and time to read it.
    """
    known = df.filter(F.col(entity).isNotNull())
    combos = known.select(entity, *columns).distinct()
    changed = combos.groupBy(entity).agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select(entity)
    entries = known.groupBy(entity, *columns, *shown).agg(F.count(F.lit(1)).alias("copies"))
    return lookup_join(entries, changed, [entity], "left_semi")
