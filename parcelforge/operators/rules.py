"""Rule views: intent, permitted and prohibited filters, conflicts, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelforge.functions.text import blank


def intent(rule_type: Column, permitted: list[str], prohibited: list[str]) -> Column:
    return F.when(rule_type.isin(permitted), "permitted").when(rule_type.isin(prohibited), "prohibited")


def with_subject(rules: DataFrame, subject: str) -> DataFrame:
    """Rows whose subject is neither null nor blank."""
    return rules.where(~blank(F.col(subject)))


def conflicts(rules: DataFrame, keys: list[str], pk: str, kind: str, one: list[str], other: list[str]) -> DataFrame:
    """Pairs of rules of opposite kinds that agree on all keys; both sides are filtered before the join."""
    left = rules.where(F.col(kind).isin(one)).select(*keys, F.col(pk).alias(f"{pk}_a"))
    right = rules.where(F.col(kind).isin(other)).select(*keys, F.col(pk).alias(f"{pk}_b"))
    return left.join(right, keys).where(F.col(f"{pk}_a") != F.col(f"{pk}_b"))


def counts(zones: DataFrame, rules: DataFrame, zone_key: str, rule_key: str, kind: str, use: str, groups: dict[str, list[str]], distinct_of: list[str]) -> DataFrame:
    """Rule counts per zone by kind, zones without rules included, and distinct uses of some kinds."""
    kinds = ", ".join(f"'{k}'" for k in distinct_of)
    joined = zones.select(zone_key).join(rules.select(F.col(rule_key).alias(zone_key), kind, use), zone_key, "left")
    return joined.groupBy(zone_key).agg(
        F.count(kind).alias("rules"),
        *[F.count_if(F.col(kind).isin(v)).alias(name) for name, v in groups.items()],
        F.expr(f"count(DISTINCT lower(trim({use}))) FILTER (WHERE {kind} IN ({kinds}))").alias("uses"),
    )


def crosswalk(rows: DataFrame, seeds: DataFrame, code: str) -> DataFrame:
    """Codes mapped by a seed table (source_code, target_code; broadcast: tens of rows), unmapped ones kept."""
    return rows.join(F.broadcast(seeds), rows[code] == seeds["source_code"], "left").withColumn("normalised", F.coalesce("target_code", code)).drop("source_code", "target_code")
