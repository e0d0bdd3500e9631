"""Comparison of two document families: title and text similarity, blocking, top candidates."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from parcelforge.functions.text import jaccard, norm_text, tokens

#: Families of section titles, by phrases of the normalised title; the first that fits counts.
TITLE_FAMILIES = {
    "permitted_uses": ("permitted uses", "regulations for permitted uses", "permitted with conditions", "conditional uses"),
    "built_form": (
        "built form requirements", "development standards", "bonus height development standards", "lot requirements", "yard requirements", "setback requirements", "building height",
    ),
    "landscaping": ("landscape requirements", "landscaping", "land use buffers"),
    "signage": ("sign", "signs", "signage"),
}


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp similarity of the normalised texts, 0 if either is blank (no native form exists)."""
    return _ratio(norm_text(a), norm_text(b))


def score(title: Column, title_tokens: Column, text: Column, same_topic: Column, same_zone: Column) -> Column:
    """Weighted best of three similarities with bonuses, at most 1."""
    best = F.greatest(title, 0.95 * title_tokens, 0.75 * text)
    return F.least(best + F.when(same_topic, 0.08).otherwise(0.0) + F.when(same_zone, 0.12).otherwise(0.0), F.lit(1.0))


def equivalence(total: Column, title: Column, text: Column) -> Column:
    same = (title >= 0.92) | (total >= 0.92)
    return F.when(same, "same_topic").when((text >= 0.45) | (total >= 0.72), "renamed_or_restructured").otherwise("partial_overlap")


def title_family(title: Column) -> Column:
    """First family one of whose phrases is in the normalised title; null without one."""
    found = None
    for family, phrases in TITLE_FAMILIES.items():
        hit = F.lit(False)
        for phrase in phrases:
            hit |= F.contains(norm_text(title), F.lit(phrase))
        found = F.when(hit, family) if found is None else found.when(hit, family)
    return found


def candidates(current: DataFrame, draft: DataFrame, key: str = "key", order: list[str] | None = None, k: int = 3) -> DataFrame:
    """(current_key, draft_key, score, title_similarity, text_similarity, equivalence_type, rank): the top k draft sections of each current one.

    Both frames hold the key, document_type, zone_code, title, topic and text.  Sections without words are not compared.  Eligible are pairs whose document types do not differ
    and that agree on the zone and on title or title family, or have no zone and agree on title or family, or on the topic with titles of ratio 0.62 or more.  Of these stay
    equal titles, titles of ratio 0.68 or more, texts of similarity 0.32 or more, and equal families with a score of 0.50 or more.  Ties go by ``order`` of the draft, then key.
    """
    order = order or []

    def side(rows: DataFrame, mark: str) -> DataFrame:
        title, zone, topic, family = norm_text(F.col("title")), F.nullif(F.col("zone_code"), F.lit("")), F.nullif(F.col("topic"), F.lit("")), title_family(F.col("title"))
        block = lambda kind, *parts: F.to_json(F.array(F.lit(kind), *parts))
        zoned = F.array(block("title", zone, title), F.when(family.isNotNull(), block("family", zone, family)))
        bare = F.array(block("title", title), F.when(family.isNotNull(), block("family", family)), F.when(topic.isNotNull(), block("topic", topic)))
        made = rows.where(norm_text(F.col("text")) != "").select(
            F.col(key).alias("key"), F.nullif(F.col("document_type"), F.lit("")).alias("type"), zone.alias("zone"), topic.alias("topic"), F.coalesce("title", F.lit("")).alias("title"),
            title.alias("norm"), family.alias("family"), tokens(F.col("title")).alias("title_tokens"), tokens(F.col("text")).alias("text_tokens"),
            F.array_compact(F.when(zone.isNotNull(), zoned).otherwise(bare)).alias("blocks"), F.struct(*order, key).alias("order"),
        )
        made = made.withColumn("block", F.explode("blocks"))
        return made.select(F.col("block").alias("_block"), *[F.col(c).alias(f"{mark}_{c}") for c in made.columns if c != "block"])

    pairs = side(current, "a").join(side(draft, "b"), "_block")
    # a pair meets once: in the first block that it shares
    pairs = pairs.where(F.col("_block") == F.array_intersect("a_blocks", "b_blocks")[0])
    pairs = pairs.where(F.col("a_type").isNull() | F.col("b_type").isNull() | (F.col("a_type") == F.col("b_type")))
    scored = pairs.withColumn("title_similarity", ratio(F.col("a_title"), F.col("b_title")))
    scored = scored.withColumn("text_similarity", jaccard(F.col("a_text_tokens"), F.col("b_text_tokens")))
    same_topic, same_zone = [F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False)) for c in ("topic", "zone")]
    total = score(F.col("title_similarity"), jaccard(F.col("a_title_tokens"), F.col("b_title_tokens")), F.col("text_similarity"), same_topic, same_zone)
    scored = scored.withColumn("score", total)
    exact, family = F.col("a_norm") == F.col("b_norm"), F.coalesce(F.col("a_family") == F.col("b_family"), F.lit(False))
    eligible = exact | family | (F.col("title_similarity") >= 0.62)
    strong = exact | (F.col("title_similarity") >= 0.68) | (F.col("text_similarity") >= 0.32) | (family & (F.col("score") >= 0.50))
    kind = equivalence(F.col("score"), F.col("title_similarity"), F.col("text_similarity"))
    best = Window.partitionBy("a_key").orderBy(F.desc("score"), F.desc("title_similarity"), F.desc("text_similarity"), "b_order")
    ranked = scored.where(eligible & strong).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(
        F.col("a_key").alias("current_key"), F.col("b_key").alias("draft_key"), "score", "title_similarity", "text_similarity", kind.alias("equivalence_type"), "rank"
    )


def token_candidates(current: DataFrame, draft: DataFrame, block: list[str], key: str, words: str, k: int = 3) -> DataFrame:
    """No comparison of sections (that is ``candidates``): top k draft rows of each current row by token similarity alone, among rows that agree on the blocking columns.

    Rows with one token set are compared as one: distinct sets meet within a block, each draft set with its k smallest keys, and the best k are handed out to all rows of a current set.
    """
    left = current.select(*block, F.col(key).alias("current_key"), F.array_sort(words).alias("_a"))
    right = draft.select(*block, F.col(key).alias("draft_key"), F.array_sort(words).alias("_b"))
    first = Window.partitionBy(*block, "_b").orderBy("draft_key")
    few = right.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).groupBy(*block, "_b").agg(F.collect_list("draft_key").alias("_keys"))
    scored = left.select(*block, "_a").distinct().join(few, block).withColumn("similarity", jaccard(F.col("_a"), F.col("_b"))).where("similarity > 0")
    scored = scored.select(*block, "_a", "similarity", F.explode("_keys").alias("draft_key"))
    order = Window.partitionBy(*block, "_a").orderBy(F.desc("similarity"), "draft_key")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return left.join(best, [*block, "_a"]).select("current_key", "draft_key", "similarity", "rank")
