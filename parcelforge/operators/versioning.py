"""Versioned, content-hashed import: diff, supersede, events, upserts that keep reviewed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(records: DataFrame, key: str, order: str) -> DataFrame:
    """One row per natural key: the last by ``order``."""
    last = Window.partitionBy(key).orderBy(F.desc(order))
    return records.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")


def diff(active: DataFrame, incoming: DataFrame, key: str = "natural_key", digest: str = "content_hash") -> DataFrame:
    """(key, prior hash, hash, change_status) by one full outer join: added, removed, changed or unchanged."""
    old = active.select(F.col(key), F.col(digest).alias("prior_content_hash"), F.lit(True).alias("_old"))
    new = incoming.select(F.col(key), F.col(digest).alias("content_hash"), F.lit(True).alias("_new"))
    status = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
        .when(F.col("prior_content_hash").eqNullSafe(F.col("content_hash")), "unchanged").otherwise("changed")
    )
    return old.join(new, key, "full_outer").select(key, "prior_content_hash", "content_hash", status.alias("change_status"))


def apply_diff(active: DataFrame, incoming: DataFrame, events: DataFrame, key: str = "natural_key") -> DataFrame:
    """The table after import: old versions flagged inactive, new versions of added and changed keys appended."""
    gone = events.where(F.col("change_status").isin("removed", "changed")).select(key, F.lit(True).alias("_gone"))
    kept = active.join(gone, key, "left").withColumn("is_active", F.col("is_active") & F.col("_gone").isNull()).drop("_gone")
    fresh = incoming.join(events.where(F.col("change_status").isin("added", "changed")).select(key), key, "left_semi")
    return kept.unionByName(fresh.withColumn("is_active", F.lit(True)))


def upsert_preserving(current: DataFrame, incoming: DataFrame, keys: list[str], status: str = "review_status", open_status: str = "candidate") -> DataFrame:
    """Incoming rows replace those still open; reviewed rows stay; open rows that no longer come are pruned."""
    reviewed = current.where(F.col(status) != open_status)
    return reviewed.unionByName(incoming.join(reviewed.select(*keys), keys, "left_anti").select(*current.columns))


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is new are appended."""
    return current.unionByName(incoming.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti").select(*current.columns))


def review(rows: DataFrame, decision: str, note: str | None = None) -> DataFrame:
    """Apply a review decision; a rejection forces ``not_equivalent`` and notes append on a new line."""
    kind = F.lit("not_equivalent") if decision == "rejected" else F.col("equivalence_type")
    return rows.withColumns({
        "review_status": F.lit(decision),
        "equivalence_type": kind,
        "reviewer_notes": F.concat_ws("\n", F.nullif(F.col("reviewer_notes"), F.lit("")), F.lit(note)),
    })


def replay_corrections(corrections: DataFrame, active: DataFrame, key: str = "natural_key", digest: str = "content_hash") -> DataFrame:
    """Corrections made against a hash that still holds are reapplied, others need another look."""
    now = active.select(key, F.col(digest).alias("_now"))
    same = F.col("_now").eqNullSafe(F.col(digest))
    return corrections.join(now, key, "left").withColumn("correction_status", F.when(same, "reapplied").otherwise("needs_re_evaluation")).drop("_now")
