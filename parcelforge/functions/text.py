"""Key normalisers, labels and token sets as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_key(c: Column, joiner: str = "_") -> Column:
    """Lower case, runs of other characters to one joiner, none at the ends; '' for null."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", joiner), f"^{joiner}+|{joiner}+$", "")


def slugify(c: Column, default: str = "unknown") -> Column:
    """Dash-joined key with & read as and; ``default`` where nothing is left."""
    slug = norm_key(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit(" and ")), "-")
    return F.when(slug == "", default).otherwise(slug)


def canonical_label(c: Column) -> Column:
    """The key of a label; null where nothing is left."""
    return F.nullif(norm_key(c), F.lit(""))


def norm_text(c: Column) -> Column:
    return norm_key(c, " ")


def tokens(c: Column, longer_than: int = 2) -> Column:
    """Distinct words of the normalised text that are longer than so many characters."""
    return F.array_distinct(F.filter(F.split(norm_text(c), " "), lambda w: F.length(w) > longer_than))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two token arrays; 0 when either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def clause_path(label: Column) -> Column:
    """``21(ea)(1)`` -> [21, ea, 1]; null when the label has no such form."""
    form = r"^([A-Za-z0-9.]+)((?:\([A-Za-z0-9.]+\))*)$"
    parts = F.concat(F.array(F.regexp_extract(label, form, 1)), F.regexp_extract_all(label, F.lit(r"\(([A-Za-z0-9.]+)\)"), F.lit(1)))
    return F.when(label.rlike(form), parts)


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def first_match(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first rule whose needle is a substring; rule order matters."""
    out = None
    for needle, label in rules:
        hit = F.contains(F.lower(c), F.lit(needle))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(default))


def source_key(*parts: Column) -> Column:
    """Non-empty parts joined by ::"""
    return F.concat_ws("::", *[F.nullif(p, F.lit("")) for p in parts])


def content_hash(*columns: Column) -> Column:
    """SHA-256 of the columns as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def zone_name(title: Column, code: Column) -> Column:
    """Title without a trailing ``(CODE)``."""
    tail = F.concat(F.lit("("), code, F.lit(")"))
    ends = F.endswith(F.upper(title), F.upper(tail))
    return F.when(ends, F.rtrim(F.left(title, F.length(title) - F.length(tail)))).otherwise(title)


def zone_change(current: Column, draft: Column) -> Column:
    return (
        F.when(current.isNull() & draft.isNull(), "pending").when(current.isNull(), "added").when(draft.isNull(), "removed")
        .when(current == draft, "same").otherwise("changed")
    )
