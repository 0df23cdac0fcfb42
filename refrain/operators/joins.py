"""Joins of member-grain labels with fact tables of any size and skew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def join_facts(labels: DataFrame, facts: DataFrame, key: str = "msno") -> DataFrame:
    """Inner join of labels and facts; null keys match nothing."""
    return labels.join(facts, key, "inner")


def left_join_facts(labels: DataFrame, facts: DataFrame, key: str = "msno") -> DataFrame:
    """``labels`` left join ``facts``, laid out for a fact side with hot keys.

    An outer join can neither broadcast its preserved side nor split a hot key of the other.
    The matched part is therefore an inner join, where Catalyst may broadcast a small label
    table and AQE may split a hot key on either side. The unmatched labels are added by an
    anti join against the distinct fact keys, which are combined before they are shuffled.
    """
    matched = join_facts(labels, facts, key)
    unmatched = labels.join(facts.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def left_join_profiles(labels: DataFrame, *profiles: DataFrame, key: str = "msno") -> DataFrame:
    """Left join of tables with at most one row per key each."""
    for profile in profiles:
        labels = labels.join(profile, key, "left")
    return labels


def over_members(
    facts: DataFrame,
    labels: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    key: str = "msno",
) -> DataFrame:
    """``build(facts)`` for labelled members only.

    The semi join carries no hint: Spark broadcasts the keys if their measured bytes allow it, and otherwise
    adaptive execution may split a hot member, since the fact side of a semi join can be split.
    """
    return build(facts.join(labels.select(key), key, "left_semi"))


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, matched by column name; absent columns are null."""
    merged, *rest = tables
    for table in rest:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged
