"""Use lists, map references, zone references, amendment rows, candidate phrases, numeric requirements and terms, from tables of clauses and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelforge.functions import classify, measure
from parcelforge.functions.measure import bind
from parcelforge.functions.text import norm_key, slugify
from parcelforge.operators.extraction import in_order, squeeze
from parcelforge.operators.spatial import expand

#: Words that make a clause with a number a dimensional requirement.
DIMENSIONAL = ("minimum", "maximum", "height", "yard", "area", "setback", "frontage")
#: Columns of requirement tables that hold no values, and those of prose.
DESCRIPTORS, PROSE = ("row_number", "row_label", "requirement", "condition", "use", "zone"), ("general_provisions",)


def _upto(part: list[str], order: list[str]):
    return Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def use_block(lines: DataFrame, part: list[str], order: list[str], text: str, heading: str, label: str, family: str = "suburban") -> DataFrame:
    """(part, order, label, use_type, use_name, status): labelled lines after one that says ``following uses``, up to the next heading.

    ``heading`` and ``label`` (token, rest) are patterns; a label that is none, or a decimal before a unit, is no use.
    """
    opens = F.contains(F.lower(F.col(text)), F.lit("following uses"))
    state = F.last(F.when(opens, True).when(F.col(text).rlike(heading), False), ignorenulls=True).over(_upto(part, order))
    token, rest = F.regexp_extract(text, label, 1), squeeze(F.regexp_extract(text, label, 2))
    rows = lines.withColumn("_in", F.coalesce(state, F.lit(False)) & ~opens).where(F.col("_in") & F.col(text).rlike(label))
    rows = rows.where(classify.is_label(token) & ~classify.is_measurement_fragment(token, rest))
    gone = F.when(F.contains(F.lower(rest), F.lit("repealed")), "repealed").otherwise("active")
    return rows.select(*part, *order, token.alias("label"), classify.use_type(rest, family).alias("use_type"), F.rtrim(rest, F.lit(";.")).alias("use_name"), gone.alias("status"))


def listed_uses(provisions: DataFrame, part: list[str], order: list[str], title: str, label: str, text: str) -> DataFrame:
    """(part, order, label, use_type, use_name, conditions) of sections whose title speaks of permitted uses.

    ``.1`` states the conditions of the ``(a)`` items after it, or is a use itself where it announces none; other dotted provisions end its list and
    are uses under titles that end in ``AS OF RIGHT``.  Titles with ``SITE PLAN`` give uses by site plan approval.
    """
    said, low = F.col(label), F.lower(F.col(text))
    dotted = F.startswith(said, F.lit("."))
    rows = provisions.where(F.contains(F.col(title), F.lit("PERMITTED USE")))
    last = lambda c: F.last(F.when(dotted, c), ignorenulls=True).over(_upto(part, order))
    announces = F.contains(low, F.lit("following use")) | F.contains(low, F.lit("uses permitted"))
    first = F.last(F.when(said == ".1", F.col(text)), ignorenulls=True).over(_upto(part, order))
    rows = rows.withColumns({"_list": F.coalesce(last(said == ".1"), F.lit(False)), "_condition": first})
    site = F.contains(F.col(title), F.lit("SITE PLAN"))
    itself, right = (said == ".1") & ~announces, dotted & (said != ".1") & F.endswith(F.col(title), F.lit("AS OF RIGHT")) & (F.col(text) != "")
    item = F.col("_list") & F.startswith(said, F.lit("("))
    kind = F.when(right | ~site, "permitted_use").otherwise("site_plan_approval_use")
    name = F.when(item, F.rtrim(F.col(text), F.lit(";"))).otherwise(F.col(text))
    return rows.where(itself | right | item).select(
        *part, *order, said.alias("label"), kind.alias("use_type"), name.alias("use_name"), F.when(item, F.col("_condition")).otherwise(F.col(title)).alias("conditions")
    )


def map_references(lines: DataFrame, keys: list[str], text: str, page: str, caption: str = r"^(Map|Schedule)\s+[A-Za-z0-9]") -> DataFrame:
    """Distinct captions by page: (keys, page, label, reference_type, feature_key, feature_class, target)."""
    kind = classify.map_class(F.col(text))
    rows = lines.where(F.col(text).rlike(caption)).select(
        *keys, page, F.col(text).alias("label"), F.when(F.startswith(F.col(text), F.lit("Map ")), "map").otherwise("schedule").alias("reference_type"), slugify(F.col(text)).alias("feature_key"),
        kind.alias("feature_class"), classify.map_target(kind).alias("target"),
    )
    return rows.dropDuplicates([*keys, "label", page])


def digitisation_backlog(references: DataFrame, keys: list[str], page: str, reason: str) -> DataFrame:
    """What must be digitised before texts can be linked to these maps: one row for each reference."""
    return references.select(*keys, "feature_key", "feature_class", F.col(page).alias("source_page"), "label", F.lit(reason).alias("reason"), "target", F.lit("manual_or_vector_digitization_backlog").alias("source_type"))


def named_zones(clauses: DataFrame, keys: list[str], text: str, codes: list[str], names: dict[str, str]) -> DataFrame:
    """(keys, zone_code): zones that a clause names by code, as whole words with a blank or nothing for the dash, or by a name before ``zone``.

    The known codes are a municipality's, tens of them, and stand in the expression.
    """
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(text)), "[^a-z0-9-]+", " "), F.lit(" "))

    def hit(said: Column, code: str) -> Column:
        forms = {code.lower(), code.lower().replace("-", " "), code.lower().replace("-", "")}
        found = F.lit(False)
        for form in sorted(forms):
            found |= F.contains(said, F.lit(f" {form} "))
        for name, own in names.items():
            if own == code:
                found |= F.contains(F.lower(F.col(text)), F.lit(f"{name} zone"))
        return F.when(found, code)

    rows = clauses.select(*keys, F.explode(bind(plain, lambda said: F.array_compact(F.array(*[hit(said, c) for c in codes])))).alias("zone_code"))
    return rows.distinct()


def zone_relations(clauses: DataFrame, keys: list[str], clause: str, text: str, zone: str, codes: list[str], names: dict[str, str]) -> DataFrame:
    """(keys, clause, zone, zone_code, relationship_type, join_behavior, cross_reference): edges from clauses that take over another zone's uses or regulations.

    ``cross_reference`` marks one edge of each clause and zone, the plain reference beside what is inherited.
    """
    own = [*keys, clause, zone]
    refers = clauses.where(classify.names_zone_rules(F.col(text)))
    named = named_zones(refers, own, text, codes, names)
    edges = refers.select(*own, F.explode(classify.relation_types(F.col(text))).alias("relationship_type")).join(named, own)
    first = F.row_number().over(Window.partitionBy(*own, "zone_code").orderBy("relationship_type")) == 1
    return edges.select(*own, "zone_code", "relationship_type", classify.join_behaviour(F.col("relationship_type")).alias("join_behavior"), first.alias("cross_reference"))


def apply_zone_relations(uses: DataFrame, terms: DataFrame, edges: DataFrame, keys: list[str], clause: str) -> tuple[DataFrame, DataFrame]:
    """(uses, terms) without those that stand in clauses which only refer to other zones.

    ``uses`` (keys, clause, term_id), ``terms`` (keys, term_id, clauses: array of the clauses that state it).  A term goes if a removed use has it or if all its
    clauses refer elsewhere; terms without clauses stay.
    """
    refers = edges.select(*keys, F.col(clause)).distinct()
    kept = uses.join(refers, [*keys, clause], "left_anti")
    removed = uses.join(refers, [*keys, clause], "left_semi").select(*keys, "term_id").distinct()
    stated = terms.select(*keys, "term_id", F.explode("clauses").alias(clause))
    alive = stated.join(refers, [*keys, clause], "left_anti").select(*keys, "term_id").distinct().withColumn("_alive", F.lit(True))
    rest = terms.join(removed, [*keys, "term_id"], "left_anti").join(alive, [*keys, "term_id"], "left")
    return kept, rest.where(F.col("_alive") | (F.size("clauses") == 0)).drop("_alive")


def section_marks(lines: DataFrame, part: list[str], order: list[str], text: str) -> DataFrame:
    """Adds ``section`` (the last numbered heading at or before a line), ``clause`` (the first label with brackets in it) and ``context``."""
    line = squeeze(F.col(text))
    number, title = F.substring_index(line, " ", 1), F.trim(F.substring(line, F.length(F.substring_index(line, " ", 1)) + 1, F.length(line)))
    strange = F.length(F.regexp_replace(title, "[A-Za-z0-9 ,;:'\"()/-]", "")) > 0
    heading = number.rlike(r"^[0-9]+([.][0-9]+)*$") & title.rlike("^[A-Z]") & (F.length(title) >= 5) & ~strange
    words = F.transform(F.split(line, " "), lambda w: F.regexp_extract(w, r"^[^A-Za-z0-9]*([0-9]+([.][0-9]+)?([(][A-Za-z0-9.]+[)])+)", 1))
    clause = F.element_at(F.concat(F.filter(words, lambda w: w != ""), F.array(F.lit(None).cast("string"))), 1)
    return lines.withColumns({"section": F.last(F.when(heading, number), ignorenulls=True).over(_upto(part, order)), "clause": clause, "context": classify.line_context(line)})


def phrase_hits(lines: DataFrame, keys: list[str], text: str, phrases: list[tuple[str, str, str]], least: int = 3) -> DataFrame:
    """(keys, table, category, phrase) of each phrase (table, category, phrase in lower case) that a line of ``least`` characters holds.

    The phrase list is fixed and short; it stands in the expression, so no join is needed.
    """
    line = F.lower(squeeze(F.col(text)))
    entries = F.array(*[F.struct(F.lit(t).alias("table"), F.lit(c).alias("category"), F.lit(p).alias("phrase")) for t, c, p in phrases])
    found = lines.where(F.length(line) >= least).select(*keys, F.explode(bind(line, lambda said: F.filter(entries, lambda e: F.contains(said, e["phrase"])))).alias("_p"))
    return found.select(*keys, "_p.table", "_p.category", "_p.phrase")


def candidates(hits: DataFrame, order: list[str], most: int = 5) -> DataFrame:
    """(table, category, phrase, occurrences, examples): phrases by falling number, category and phrase; ``examples`` are the first ``most`` places, kept as the report's feature."""
    ranked = hits.withColumn("_n", F.row_number().over(Window.partitionBy("table", "category", "phrase").orderBy(*order)))
    first = F.array_sort(F.collect_list(F.when(F.col("_n") <= most, F.struct("_n", *order))))
    merged = ranked.groupBy("table", "category", "phrase").agg(F.count(F.lit(1)).alias("occurrences"), F.transform(first, lambda e: F.struct(*[e[c].alias(c) for c in order])).alias("examples"))
    return merged.orderBy(F.desc("occurrences"), "category", "phrase")


def amendment_rows(lines: DataFrame, part: list[str], page: str, order: list[str], text: str, row: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """(part, entry, number, text, page_start, page_end): a line of the form ``row`` (number, rest) opens an entry, others continue it; lines in ``skip`` are page furniture."""
    rows = lines.where(~F.col(text).isin(*skip)) if skip else lines
    hit = F.col(text).rlike(row)
    ordered = Window.partitionBy(*part).orderBy(page, *order)
    rows = rows.select(*part, page, *order, hit.alias("_hit"), F.regexp_extract(text, row, 1).alias("_number"), F.when(hit, F.regexp_extract(text, row, 2)).otherwise(F.col(text)).alias("_body"))
    rows = rows.withColumn("entry", F.sum(F.col("_hit").cast("int")).over(ordered)).where("entry > 0")
    return rows.groupBy(*part, "entry").agg(
        F.max(F.when(F.col("_hit"), F.col("_number"))).alias("number"), squeeze(in_order([page, *order], "_body")).alias("text"), F.min(page).alias("page_start"), F.max(page).alias("page_end")
    )


def numeric_values(cells: DataFrame, clauses: DataFrame) -> DataFrame:
    """(kind, ref, place, raw, value, unit, alternative_value, alternative_unit, measure_type, comparator, context): all measurements of table cells and clauses.

    ``cells`` (cell_id, column_id, column_label, requirement, condition, text), ``clauses`` (clause_id, text).  A cell's context is its row's requirement and condition, its
    column and its text.  Cells of one number word in a column of permitted buildings count buildings.
    """
    context = squeeze(F.concat_ws(" ", "requirement", "condition", "column_label", "text"))
    body = measure.bedrooms(F.col("text"))
    cell = cells.where(~F.col("column_id").isin(*DESCRIPTORS)).select(
        F.lit("table_cell").alias("kind"), F.col("cell_id").alias("ref"), context.alias("context"), measure.grouped(body).alias("_found"),
        F.when(F.col("column_id") == "accessory_buildings_permitted", measure.word_number(F.col("text"))).alias("_word"), F.col("text").alias("_text"),
    )
    word = F.array(F.struct(F.col("_text").alias("raw"), F.col("_word").cast("double").alias("amount"), F.lit("building").alias("unit"), F.lit(None).cast("struct<raw:string,amount:double,unit:string>").alias("alternative")))
    cell = cell.withColumn("_found", F.when((F.size("_found") == 0) & F.col("_word").isNotNull(), word).otherwise(F.col("_found"))).drop("_word", "_text")
    clause = clauses.select(F.lit("clause").alias("kind"), F.col("clause_id").alias("ref"), F.col("text").alias("context"), measure.grouped(F.col("text")).alias("_found"))
    rows = cell.unionByName(clause).select("kind", "ref", "context", F.posexplode("_found").alias("place", "m"))
    return rows.select(
        "kind", "ref", (F.col("place") + 1).alias("place"), F.col("m.raw").alias("raw"), F.col("m.amount").alias("value"), F.col("m.unit").alias("unit"),
        F.col("m.alternative.amount").alias("alternative_value"), F.col("m.alternative.unit").alias("alternative_unit"), measure.measure_type(F.col("m.unit"), F.col("context")).alias("measure_type"),
        measure.stated_comparator(F.col("context")).alias("comparator"), "context",
    )


def requirements(values: DataFrame, cells: DataFrame, clauses: DataFrame) -> DataFrame:
    """(kind, ref, requirement_type, category, label, lot_context, condition, values): one requirement for each cell or clause that holds a measurement."""
    many = values.groupBy("kind", "ref").agg(F.count(F.lit(1)).alias("values"))
    cell = cells.select(
        F.lit("table_cell").alias("kind"), F.col("cell_id").alias("ref"), F.lit("dimensional_standard").alias("requirement_type"), F.col("requirement").alias("label"),
        F.nullif(norm_key(F.col("column_label")), F.lit("")).alias("lot_context"), F.nullif(F.col("condition"), F.lit("")).alias("condition"), F.col("requirement").alias("_said"),
    )
    stated = F.lit(False)
    for word in DIMENSIONAL:
        stated |= F.contains(F.lower("text"), F.lit(word))
    none = F.lit(None).cast("string")
    clause = clauses.select(
        F.lit("clause").alias("kind"), F.col("clause_id").alias("ref"), F.when(stated, "dimensional_standard").otherwise("other").alias("requirement_type"), F.col("label"),
        none.alias("lot_context"), none.alias("condition"), F.col("text").alias("_said"),
    )
    fallback = F.coalesce(F.nullif(F.left(norm_key(F.col("_said")), F.lit(80)), F.lit("")), F.lit("other"))
    return cell.unionByName(clause).join(many, ["kind", "ref"]).withColumn("category", measure.category(F.coalesce("_said", F.lit("")), fallback)).drop("_said")


def unparsed_cells(values: DataFrame, cells: DataFrame) -> DataFrame:
    """(cell_id, text) of cells that hold something but no measurement, for review; ``n/a`` and prose are no such cells."""
    plain = F.lower(F.trim("text"))
    asked = cells.where(~F.col("column_id").isin(*DESCRIPTORS, *PROSE) & (F.col("text") != "") & ~plain.isin("n/a", "na"))
    return asked.select("cell_id", "text").join(values.where("kind = 'table_cell'").select(F.col("ref").alias("cell_id")).distinct(), "cell_id", "left_anti")


def terms_and_uses(parts: DataFrame, codes: DataFrame, keys: list[str], clause: str, skip: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(terms, uses) of the components of use names.

    ``parts`` (keys, clause, place, raw), one row per component, ``codes`` (code, code_table, category, status).  Terms are one row for each key, code table and normalised name
    (``unmatched`` without a code), with the clauses that state it; what no code or only one in review matches needs review.  Names in ``skip`` are neither.
    """
    named = parts.withColumn("normalized", norm_key(F.col("raw"))).where(F.col("normalized") != "")
    named = named.where(~F.col("normalized").isin(*skip)) if skip else named
    found = named.join(codes.withColumnRenamed("code", "normalized").dropDuplicates(["normalized"]), "normalized", "left")
    sure = F.when(F.col("code_table").isNull() | (F.col("status") == "review"), "needs_review").otherwise("high")
    table = F.coalesce("code_table", F.lit("unmatched"))
    rows = found.select(
        *keys, clause, "place", "raw", "normalized", F.concat_ws("-", F.lit("term"), table, "normalized").alias("term_id"), F.coalesce("category", F.lit("unknown")).alias("term_category"), sure.alias("confidence")
    )
    first = F.min(F.struct("place", clause, "raw"))["raw"].alias("term_raw")
    terms = rows.groupBy(*keys, "term_id", "normalized", "term_category", "confidence").agg(first, F.array_sort(F.collect_set(clause)).alias("clauses"))
    return terms, rows.select(*keys, clause, "place", "raw", "term_id", "confidence")


def rewrite_ids(rows: DataFrame, column: str, changes: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose array of ids is rewritten by ``changes`` (old_id, new_ids array): each id becomes its replacements, in order and once; ids without a change stay, an empty list removes one."""
    each = rows.select(*key, F.posexplode(column).alias("_at", "old_id")).join(changes, "old_id", "left")
    new = each.select(*key, "_at", F.posexplode(F.coalesce("new_ids", F.array("old_id"))).alias("_in", "_id"))
    place = new.groupBy(*key, "_id").agg(F.min(F.struct("_at", "_in")).alias("_p"))
    listed = place.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_id"))), lambda x: x["_id"]).alias("_new"))
    return rows.join(listed, key, "left").withColumn(column, F.coalesce("_new", F.array().cast("array<string>"))).drop("_new")


def reference_targets(references: DataFrame, target: list[str], path: str, page: str) -> DataFrame:
    """(target_id, source_text, paths, n): references of all documents by what they name, the first non-empty of ``target`` columns, with the documents that do and how often."""
    title = F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in target])
    rows = references.select(F.concat_ws(":", F.lit("requirement-reference"), slugify(title)).alias("target_id"), title.alias("_t"), path, page)
    return rows.groupBy("target_id").agg(F.min(F.struct(path, page, F.col("_t").alias("t")))["t"].alias("source_text"), F.array_sort(F.collect_set(path)).alias("paths"), F.count(F.lit(1)).alias("n"))


def area_tokens(labels: list[Column], plain: list[Column]) -> Column:
    """Keys of what a rule says of its area: each label's normal form, and the ``plain`` ones also with dashes and blanks as underscores; empty ones are left out."""
    forms = [norm_key(c) for c in [*labels, *plain]] + [F.translate(F.lower(c), "- ", "__") for c in plain]
    return F.filter(F.array_distinct(F.array_compact(F.array(*forms))), lambda t: t != "")


def area_links(rules: DataFrame, places: DataFrame, scope: str) -> DataFrame:
    """Distinct (scope, rule, place) where a token of the rule holds a key of the place or the other way round, within one bylaw.

    ``rules`` (scope, rule, tokens array), ``places`` (scope, place, keys array).  Distinct tokens meet distinct keys first, so rules that say the same
    cost one comparison; the links then follow by equality.
    """
    # the tokens of a rule or place, as one set, are its class: classes meet first, and the links, which may be very many, follow without a shuffle of their own
    said = rules.select(scope, "rule", F.explode("tokens").alias("token")).where("token <> ''").groupBy(scope, "rule").agg(F.array_sort(F.collect_set("token")).alias("_tokens"))
    known = places.select(scope, "place", F.explode("keys").alias("key")).where("key <> ''").groupBy(scope, "place").agg(F.array_sort(F.collect_set("key")).alias("_keys"))
    token, key = said.select(scope, "_tokens").distinct(), known.select(scope, "_keys").distinct()
    held = F.exists("_tokens", lambda t: F.exists("_keys", lambda k: F.contains(k, t) | F.contains(t, k)))
    met = token.join(key, scope).where(held)
    return expand(said.join(met, [scope, "_tokens"]), known, [scope, "_keys"], "rule").select(scope, "rule", "place")
