"""The versioned import around the diff: canonical hashes, revisions, batches, ids, events, supersession within a family, coverage gaps, migrations, staged writes."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parcelforge.operators.versioning import diff

#: Keys that say nothing of a record's content; all keys that end in ``_id`` are dropped beside them.
VOLATILE = ("review_flags", "confidence", "loaded_at", "created_at", "updated_at")
#: Keys of a manifest that name its revision, in order.
REVISION_KEYS = ("source_sha256", "source_document_sha256", "generated_at", "updated_at")
#: The record tables of an import.
TABLES = ("source_file", "bylaw_part", "section", "clause", "definition", "source_unit", "raw_page", "raw_table", "raw_table_cell", "raw_map_reference", "structured_fact")


def _stable(text: str | None, drop: bool) -> str | None:
    if text is None:
        return None

    def clean(value):
        if isinstance(value, dict):
            return {k: clean(v) for k, v in value.items() if k not in VOLATILE and not k.endswith("_id")}
        return [clean(v) for v in value] if isinstance(value, list) else value

    value = json.loads(text)
    return json.dumps(clean(value) if drop else value, ensure_ascii=True, sort_keys=True, separators=(",", ":"))


def stable_json(payload: Column, drop_volatile: bool = False) -> Column:
    """JSON text in its one canonical form: keys sorted at every level, ASCII only, no blanks; without volatile keys if asked.  Null stays null."""

    @F.pandas_udf(StringType())
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _stable(t, drop_volatile))

    return form(payload)


def content_hash(payload: Column) -> Column:
    """SHA-256 of a record's JSON in canonical form without volatile keys: the same for any order of keys and any ids."""
    return F.sha2(stable_json(payload, True), 256)


def needs_review(payload: Column) -> Column:
    """How many values in a JSON text, at any depth, have the confidence ``needs_review``."""
    return F.size(F.regexp_extract_all(payload, F.lit(r'"confidence"\s*:\s*"needs_review"'), F.lit(0)))


def revision_label(manifest: Column | None, family: Column, root: Column) -> Column:
    """What a manifest (JSON) says of its revision; without that the family and twelve digits of the root's hash."""
    fallback = F.concat_ws(":", family, F.left(F.sha2(root, 256), F.lit(12)))
    if manifest is None:
        return fallback
    return F.coalesce(*[F.nullif(F.get_json_object(manifest, f"$.{k}"), F.lit("")) for k in REVISION_KEYS], fallback)


def document_metadata(payload: Column, family: Column, jurisdiction: str, names: dict[str, str]) -> Column:
    """struct(jurisdiction, bylaw_name, source_document_path, document_type, zone_code, title_raw) of a document's metadata with its fallbacks."""
    at = lambda *keys: F.coalesce(*[F.nullif(F.get_json_object(payload, f"$.document_metadata.{k}"), F.lit("")) for k in keys])
    named = F.lit(None).cast("string")
    for key, name in names.items():
        named = F.when(family == key, name).otherwise(named)
    return F.struct(
        F.coalesce(at("jurisdiction"), F.lit(jurisdiction)).alias("jurisdiction"), F.coalesce(at("bylaw_name"), named).alias("bylaw_name"),
        F.coalesce(at("source_document_path"), F.lit("")).alias("source_document_path"), at("document_type").alias("document_type"), at("zone_code").alias("zone_code"),
        at("zone_title_raw", "document_title_raw", "title_raw").alias("title_raw"),
    )


def bylaw_metadata(payload: Column, slug: Column) -> Column:
    """struct(bylaw_slug, jurisdiction, bylaw_name, source_document_path): from the first metadata block that a document has."""
    blocks = ("document_metadata", "section_metadata", "schedule_metadata")
    block = F.coalesce(*[F.nullif(F.get_json_object(payload, f"$.{b}"), F.lit("{}")) for b in blocks], F.lit("{}"))
    at = lambda k: F.nullif(F.get_json_object(block, f"$.{k}"), F.lit(""))
    top = lambda k: F.nullif(F.get_json_object(payload, f"$.{k}"), F.lit(""))
    name = F.coalesce(at("bylaw_name"), at("document_name"), top("document_name"), F.initcap(F.replace(slug, F.lit("-"), F.lit(" "))))
    return F.struct(slug.alias("bylaw_slug"), F.coalesce(at("jurisdiction"), F.lit("Unknown")).alias("jurisdiction"), name.alias("bylaw_name"), F.coalesce(at("source_document_path"), top("source_document_path")).alias("source_document_path"))


def clause_path(section: Column, clause: Column) -> Column:
    """The labels that are set, as an array; null where neither is."""
    path = F.array_compact(F.array(F.nullif(section, F.lit("")), F.nullif(clause, F.lit(""))))
    return F.when(F.size(path) > 0, path)


def record_id(key: Column, batch: Column) -> Column:
    """Id of a record version: a hash of its natural key and batch, so that a task that runs again gives the same."""
    return F.xxhash64(key, batch)


def ensure_revision(revisions: DataFrame, incoming: DataFrame) -> DataFrame:
    """Revisions after an import: a known natural key keeps its id and takes the new manifest hash, others are added with an id of their key."""
    keys = ["natural_key"]
    known = revisions.select("natural_key", F.col("document_revision_id").alias("_id"))
    fresh = incoming.join(known, keys, "left").withColumn("document_revision_id", F.coalesce("_id", F.xxhash64("natural_key"))).drop("_id")
    return revisions.join(incoming.select("natural_key"), keys, "left_anti").unionByName(fresh.select(*revisions.columns))


def batch_row(spark: SparkSession, batch: int, family: str, root: str, status: str = "running", diagnostics: dict | None = None) -> DataFrame:
    """The record of one import run."""
    said = json.dumps(diagnostics or {}, sort_keys=True)
    return spark.createDataFrame([(batch, family, root, status, said)], "import_batch_id bigint, document_family string, source_root string, status string, diagnostics string")


def finish_batch(batches: DataFrame, batch: int, status: str, diagnostics: dict) -> DataFrame:
    """Batches with the outcome of one."""
    own = F.col("import_batch_id") == batch
    return batches.withColumns({"status": F.when(own, status).otherwise(F.col("status")), "diagnostics": F.when(own, json.dumps(diagnostics, sort_keys=True)).otherwise(F.col("diagnostics"))})


def record_counts(records: DataFrame) -> DataFrame:
    """(record_table, n): what a dry run reports."""
    return records.groupBy("record_table").agg(F.count(F.lit(1)).alias("n"))


def import_records(active: DataFrame, incoming: DataFrame, family: str, batch: int) -> tuple[DataFrame, DataFrame]:
    """(records after the import, events).

    Both hold record_table, natural_key, content_hash and payload; ``active`` also record_id, is_active and superseded_by_id.  Only active
    rows whose key starts with ``family|`` can be changed or removed, so that the other family stays as it is.  A changed record's old version is
    flagged and names the id of the new one, a removed one is flagged only, unchanged ones keep their id.  Of incoming rows with one key the last by
    payload counts.
    """
    keys = ["record_table", "natural_key"]
    once = incoming.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("payload"), F.desc("content_hash")))).where("_n = 1").drop("_n")
    scope = active.where(F.col("is_active") & F.startswith(F.col("natural_key"), F.lit(f"{family}|")))
    old = scope.select(*keys, F.col("content_hash").alias("prior_content_hash"), F.col("record_id").alias("_old_id"))
    new = once.select(*keys, "content_hash")
    joined = old.join(new, keys, "full_outer")
    status = (
        F.when(F.col("_old_id").isNull(), "added").when(F.col("content_hash").isNull(), "removed").when(F.col("content_hash") == F.col("prior_content_hash"), "unchanged").otherwise("changed")
    )
    fresh = record_id(F.concat_ws("|", *keys), F.lit(batch))
    events = joined.withColumn("change_status", status).withColumn("active_record_id", F.when(F.col("change_status").isin("added", "changed"), fresh).otherwise(F.col("_old_id")))
    moved = events.where(F.col("change_status").isin("changed", "removed")).select(*keys, F.col("change_status").alias("_s"), F.col("active_record_id").alias("_by"), F.lit(True).alias("_hit"))
    gone = F.coalesce("_hit", F.lit(False)) & F.col("is_active")
    kept = active.join(moved, keys, "left").withColumns({
        "superseded_by_id": F.when(gone & (F.col("_s") == "changed"), F.col("_by")).otherwise(F.col("superseded_by_id")), "is_active": F.col("is_active") & ~gone,
    }).drop("_s", "_by", "_hit")
    born = once.join(events.where(F.col("change_status").isin("added", "changed")).select(*keys, F.col("active_record_id").alias("record_id")), keys)
    born = born.withColumns({"is_active": F.lit(True), "superseded_by_id": F.lit(None).cast("bigint")})
    log = events.select(F.lit(batch).cast("bigint").alias("import_batch_id"), *keys, "prior_content_hash", "content_hash", "change_status", "active_record_id")
    return kept.unionByName(born.select(*active.columns)), log


def comparison_changes(current: DataFrame, draft: DataFrame, gaps: DataFrame, key: str = "natural_key", digest: str = "content_hash") -> DataFrame:
    """Differences of two families; what only the draft has is left out where an open gap says that the current side was not covered."""
    found = diff(current, draft, key, digest).where("change_status <> 'unchanged'")
    open_gaps = gaps.where((F.col("gap_status") == "open") & (F.col("comparison_effect") == "suppress_missing_current_difference")).select(key).distinct().withColumn("_gap", F.lit(True))
    return found.join(open_gaps, key, "left").where(~(F.coalesce("_gap", F.lit(False)) & (F.col("change_status") == "added"))).drop("_gap")


def pending_migrations(steps: list[tuple[str, Callable[[], None]]], applied: DataFrame | None) -> list[str]:
    """Names of the steps that the ledger (name) does not hold, in order; the ledger has one short row a step."""
    done = set() if applied is None else {r["name"] for r in applied.select("name").collect()}
    return [name for name, _ in steps if name not in done]


def migrate(spark: SparkSession, ledger: str, steps: list[tuple[str, Callable[[], None]]]) -> list[str]:
    """Run the steps that the ledger, a Parquet folder, does not hold yet, each noted once it has succeeded; returns their names."""
    try:
        applied = spark.read.schema("name string").parquet(ledger)
        applied.limit(1).collect()
    except Exception as error:  # no ledger yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        applied = None
    todo = pending_migrations(steps, applied)
    for name, step in steps:
        if name in todo:
            step()
            spark.createDataFrame([(name,)], "name string").coalesce(1).write.mode("append").parquet(ledger)
    return todo


def replace_table(rows: DataFrame, path: str) -> None:
    """Write a table beside its place and swap it in: readers see the old or the new rows, a failed write leaves the old ones."""
    spark = rows.sparkSession
    hadoop = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    staged, old = f"{path}.staged", f"{path}.old"
    system.delete(hadoop(staged), True)
    rows.write.parquet(staged)
    system.delete(hadoop(old), True)
    if system.exists(hadoop(path)):
        system.rename(hadoop(path), hadoop(old))
    if not system.rename(hadoop(staged), hadoop(path)):
        system.rename(hadoop(old), hadoop(path))
        raise OSError(f"{path} could not be replaced")
    system.delete(hadoop(old), True)


def settled(write: Callable[[int | None], int], most: int = 5) -> int:
    """Write a manifest that states its own size until the size it states is the size it has, at most ``most`` times; returns the size."""
    size = None
    for _ in range(most):
        now = write(size)
        if now == size:
            break
        size = now
    return size
