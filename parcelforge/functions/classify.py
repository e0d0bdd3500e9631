"""Ordered classifiers of texts, paths and labels, as native column expressions.  The tables state which phrase gives which class; the first that fits counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelforge.functions.text import first_match

#: Needles of section topics, in order.
TOPICS = [
    ("definitions", "definitions"), ("permit", "process"), ("application", "process"), ("permitted use", "permitted_uses"), ("use", "permitted_uses"), ("parking", "parking"),
    ("sign", "signage"), ("landscap", "landscaping"), ("buffer", "landscaping"), ("setback", "lot_requirements"), ("yard", "lot_requirements"), ("lot", "lot_requirements"),
    ("height", "lot_requirements"), ("map", "maps_schedules"), ("schedule", "maps_schedules"), ("design", "design_standards"), ("site specific", "site_specific"),
    ("administration", "administration"),
]
#: Phrases of kinds of uses, in order, by the bylaw's family.
USE_TYPES = {
    "suburban": [
        ("accessory", "accessory_use"), *[(w, "residential_use") for w in ("dwelling", "suite", "housing", "bedroom rental")],
        *[(w, "institutional_or_open_space_use") for w in ("school", "library", "hospital", "religious", "institution")],
        *[(w, "recreation_use") for w in ("park", "recreation", "playground", "club")],
    ],
    "urban": [
        ("accessory", "accessory_use"), *[(w, "residential_use") for w in ("dwelling", "shared housing", "apartment", "duplex")],
        *[(w, "institutional_or_open_space_use") for w in ("school", "library", "museum", "worship")], *[(w, "recreation_use") for w in ("park", "playground", "golf", "club")],
    ],
}
#: Phrases of map captions, in order.
MAP_CLASSES = [
    ("generalized future land use", "future_land_use_area"), *[(w, "planning_area_boundary") for w in ("planning areas", "area plan boundary", "study area")],
    *[(w, "site_specific_plan_area") for w in ("overview map", "neighbourhood plan", "interchange node")], ("environmental sensitivity", "environmental_constraint_area"),
    ("flood plain", "flood_plain_area"), ("watershed", "watershed_area"), *[(w, "transportation_corridor") for w in ("principal streets", "street hierarchy", "transportation system")],
    ("development sub-areas", "development_sub_area"), *[(w, "municipal_service_area") for w in ("water service", "sanitary sewer", "sewersheds")],
    ("community concept plan", "community_concept_plan_area"), ("density allocations", "density_allocation_area"),
]
#: Parts of source paths in lower case, in order, with domain and kind.
SOURCES = [
    ("/zoning and development bylaw", "land_use_regulation", "bylaw_text"), ("/zoning map", "land_use_regulation", "zoning_map"), ("/official plan", "policy", "official_plan_text"),
    ("municipal planning strategy", "policy", "official_plan_text"), ("/halifaxmps", "policy", "official_plan_text"), ("/future land use map", "policy", "future_land_use_map"),
    ("/wards", "municipal_geography", "ward_map"), ("/neighborhood", "municipal_geography", "neighborhood_map"), ("truck", "transportation", "truck_route_map"),
    ("cycling", "transportation", "cycling_map"), ("park", "parks", "parks_map"), ("street map", "transportation", "street_map"),
]
#: Types of source files by extension.
SOURCE_TYPES = {"extracted_json": ("json",), "pdf": ("pdf",), "image": ("png", "jpg", "jpeg", "gif", "tif", "tiff"), "gis_layer": ("gpkg", "shp", "geojson")}
#: Labels of the context of a line, in order.
CONTEXTS = ("permitted uses", "conditional uses", "prohibited uses", "regulations", "definitions", "parking", "signs", "maps", "schedule")
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")
#: What the root of a clause label looks like, by family; whether runs of small letters are split; which tokens may hold points.
LABEL_FORMS = {
    "number": (r"[0-9]+[A-Z]?", True, "roman"), "decimal": (r"[0-9]+([.][0-9]+)?[A-Z]?", True, "any"), "zone": (r"[A-Z]{0,4}-?[0-9]+([A-Z][0-9]*)?([.][0-9]+)?", False, "label"),
    "plain": (r"[A-Za-z0-9.]+", False, "any"), "section": (r"[0-9]+([.][0-9]+)*", False, "any"), "letter": (r"[A-Z]+[0-9]*", False, "any"),
}


def _has(text: Column, *phrases: str) -> Column:
    hit, low = F.lit(False), F.lower(text)
    for phrase in phrases:
        hit |= F.contains(low, F.lit(phrase))
    return hit


def topic(document_type: Column, title: Column) -> Column:
    return first_match(F.concat_ws(" ", F.coalesce(document_type, F.lit("")), F.coalesce(title, F.lit(""))), TOPICS, "other")


def use_type(text: Column, family: str = "suburban") -> Column:
    return first_match(text, USE_TYPES[family], "principal_use")


def policy_type(section_type: Column, text: Column) -> Column:
    return (
        F.when(_has(text, "repealed"), "repealed").when(_has(text, "deleted"), "deleted").when(section_type == "implementation", "implementation_policy")
        .when(_has(text, "generalized future land use map", "map "), "map_interpretation_policy").when(_has(text, "designation", "designated"), "designation_policy")
        .when(_has(text, "development agreement") & _has(text, "shall consider"), "development_agreement_criteria").otherwise("policy_statement")
    )


def modality(text: Column) -> Column:
    """The strongest of shall, should and may that is a word of the text; null without one."""
    words = F.split(F.lower(text), "[^a-z0-9_]+")
    return F.when(F.array_contains(words, "shall"), "shall").when(F.array_contains(words, "should"), "should").when(F.array_contains(words, "may"), "may")


def map_class(caption: Column) -> Column:
    return first_match(caption, MAP_CLASSES, "policy_map_reference")


def map_target(kind: Column) -> Column:
    """The column that later holds a map's features: shapes of areas, boundaries and corridors, else attributes."""
    shaped = F.endswith(kind, F.lit("_area")) | F.endswith(kind, F.lit("_boundary")) | kind.isin("development_sub_area", "transportation_corridor")
    return F.when(shaped, "spatial_features.geom").otherwise("spatial_features.attributes")


def path_parts(path: Column) -> tuple[Column, Column]:
    """(folder, file name) of a path."""
    parts = F.split(path, "/")
    return F.coalesce(F.get(parts, F.size(parts) - 2), F.lit("")), F.element_at(parts, -1)


def file_kind(path: Column) -> Column:
    """Kind of a document by its folder and name, as the versioned import names it."""
    folder, name = path_parts(path)
    return (
        F.when(folder == "zones", "zone").when(folder == "schedules", "schedule").when(name == "source-manifest.json", "manifest").when(name == "definitions.json", "definitions")
        .when(F.startswith(name, F.lit("appendix-")), "appendix").when(F.startswith(name, F.lit("general-provisions")), "general_provisions").otherwise("document")
    )


def section_kind(path: Column) -> Column:
    """Kind of a document as the rule import names it."""
    folder, name = path_parts(path)
    return (
        F.when(folder == "zones", "zone").when(folder == "schedules", "schedule").when(name == "definitions.json", "definitions").when(name == "maps.json", "maps")
        .when(name == "spatial-features-needed.json", "spatial_features_needed").when(name == "general-provisions.json", "general_provisions")
        .when(F.startswith(name, F.lit("appendix-")), "appendix").otherwise("document")
    )


def extension(path: Column) -> Column:
    """Lower-case extension without its point; '' for none."""
    name = path_parts(path)[1]
    return F.when(F.locate(".", name, 2) > 0, F.lower(F.substring_index(name, ".", -1))).otherwise("")


def source_type(path: Column) -> Column:
    out = F.lit("unknown")
    for kind, names in SOURCE_TYPES.items():
        out = F.when(extension(path).isin(*names), kind).otherwise(out)
    return out


def source_role(path: Column) -> Column:
    parts = F.split(path, "/")
    has = lambda p: F.array_contains(parts, p)
    primary = (has("docs") | has("zoning") | has("ocp")) & (extension(path) == "pdf")
    return F.when(has("schema"), "schema").when(has("scripts"), "converter_code").when(primary, "primary_source").otherwise("source_extract")


def source_class(path: Column) -> Column:
    """struct(domain, kind) of a source path."""
    low, out = F.lower(F.replace(path, F.lit("\\"), F.lit("/"))), F.struct(F.lit("unclassified").alias("domain"), F.lit("unknown").alias("kind"))
    for needle, domain, kind in reversed(SOURCES):
        out = F.when(F.contains(low, F.lit(needle)), F.struct(F.lit(domain).alias("domain"), F.lit(kind).alias("kind"))).otherwise(out)
    return out


def extraction_hints(kind: Column, ext: Column) -> Column:
    """What a source of this kind and extension asks of its extraction."""
    is_pdf, is_map, is_text = ext == "pdf", F.endswith(kind, F.lit("_map")), F.endswith(kind, F.lit("_text"))
    steps = [
        (is_pdf, "attempt_text_extraction"), (is_pdf, "attempt_vector_layer_extraction"), (~is_pdf, "ocr_required"), (is_map, "georeference_needed"),
        (is_map, "legend_parsing_needed"), (is_text, "section_and_table_parsing_needed"), (is_text, "citation_capture_required"),
    ]
    return F.array_compact(F.array(*[F.when(when, step) for when, step in steps]))


def line_context(line: Column) -> Column:
    return first_match(line, [(c, c) for c in CONTEXTS], "")


def zone_kind(schedule: Column, code: Column, name: Column) -> Column:
    planned = _has(F.concat_ws(" ", F.coalesce(code, F.lit("")), F.coalesce(name, F.lit(""))), "comprehensive", "development district")
    return F.when(F.coalesce(schedule, F.lit("")) != "", "schedule_zone").when(planned, "planned_development").otherwise("base")


def zone_class(kind: Column, uses: Column) -> Column:
    """Class of a zone by its kind and the categories and types of its permitted uses (array of strings; null ones are passed over)."""
    said = F.array_join(F.transform(F.array_compact(uses), F.lower), " ")
    lives, trades = _has(said, "residential", "dwelling"), _has(said, "commercial", "business", "office")
    return (
        F.when(kind == "planned_development", "planned").when(lives & trades, "mixed_with_residential").when(lives, "primarily_residential")
        .when(F.size(uses) > 0, "nonresidential").otherwise("unknown")
    )


def mapped_status(schedule: Column) -> Column:
    return F.when(F.coalesce(schedule, F.lit("")) != "", "partially_mapped").otherwise("unknown")


def permission_status(conditions: Column, symbols: Column) -> Column:
    """Permitted with conditions where any are stated, or where the symbols say more than ``permitted``."""
    marks = F.transform(F.coalesce(symbols, F.array().cast("array<string>")), F.lower)
    more = (F.size(marks) > 0) & (marks != F.array(F.lit("permitted")))
    return F.when((F.size(F.coalesce(conditions, F.array().cast("array<string>"))) > 0) | more, "permitted_with_conditions").otherwise("permitted")


def label_order(label: Column) -> Column:
    """struct(kind, number, text): natural order of row labels: numbers, then letters counted as a, b, ..., z, aa, then others."""
    plain = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    inner = F.substring(plain, F.lit(2), F.length(plain) - 2)
    token = F.when(F.startswith(plain, F.lit("(")) & F.endswith(plain, F.lit(")")) & (F.length(plain) > 2) & (F.locate(")", plain) == F.length(plain)), inner).otherwise(plain)
    number, letters = token.rlike("^[0-9]{1,18}$"), token.rlike("^[a-z]{1,13}$")
    value = F.aggregate(F.split(token, ""), F.lit(0).cast("long"), lambda n, c: F.when(c == "", n).otherwise(n * 26 + (F.ascii(c) - 96)))
    return F.struct(
        F.when(number, 0).when(letters, 1).otherwise(2).alias("kind"), F.when(number, token.try_cast("long")).when(letters, value).alias("number"), F.when(~number & ~letters, token).alias("text")
    )


def is_noise(line: Column, zone_name: Column, headers: tuple[str, ...], starts: tuple[str, ...]) -> Column:
    """Blank lines, page headers, page numbers and running titles of a bylaw's pages."""
    plain = F.trim(line)
    digits = F.regexp_replace(plain, "^[0-9]+", "")
    numbered = (F.length(digits) < F.length(plain)) & ((digits == "") | digits.rlike(r"^\s+\|\s"))
    begins = F.lit(False)
    for start in starts:
        begins |= F.startswith(plain, F.lit(start))
    return (plain == "") | plain.isin(*headers) | begins | numbered | F.endswith(plain, F.concat(F.lit("| "), F.upper(zone_name)))


def is_label(token: Column) -> Column:
    """May this token be a clause label: letters, digits, letters then digits (a dash between), digits then letters, or one of these with a decimal?"""
    parts = F.split(token, "[.]")
    head, tail = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    one = head.rlike("^([A-Za-z]+(-?[0-9]+)?|[0-9]+([A-Za-z]+[0-9]*)?)$")
    two = tail.rlike("^[0-9]+$") & head.rlike("^([A-Za-z]?[0-9]+|[A-Za-z]+)$")
    return F.coalesce((F.size(parts) == 1) & one | (F.size(parts) == 2) & two, F.lit(False))


def is_measurement_fragment(label: Column, text: Column, units: tuple[str, ...] = ("feet", "ft", "metres", "meters", "m", "square", "sq", "acres", "hectares", "percent", "%")) -> Column:
    """A decimal that begins a line before a unit is no label."""
    first = F.lower(F.regexp_replace(F.get(F.split(F.trim(text), r"\s+"), F.lit(0)), "[.,;()]", ""))
    return F.coalesce(label.rlike(r"^[0-9]+\.[0-9]+$") & first.isin(*units), F.lit(False))


def label_path(label: Column, form: str = "plain") -> Column:
    """Path of a clause label such as ``21(ea)(1)`` by the rules of one family of bylaws (``LABEL_FORMS``); null for a label of another form."""
    root_form, split_letters, points = LABEL_FORMS[form]
    plain = F.regexp_replace(label, r"\s+", "") if form != "zone" else F.trim(F.regexp_replace(label, r"\s+", " "))
    root = F.substring_index(plain, "(", 1)
    tokens = F.filter(F.split(F.substring(plain, F.length(root) + 1, F.length(plain)), "[()]"), lambda t: t != "")
    spelled = F.concat(root, F.array_join(F.transform(tokens, lambda t: F.concat(F.lit("("), t, F.lit(")"))), ""))
    roman_point = lambda t: F.substring_index(t, ".", 1).isin(*ROMAN) & F.substring_index(t, ".", -1).rlike("^[0-9]+$")
    ok = {"any": lambda t: F.lit(True), "roman": lambda t: ~F.contains(t, F.lit(".")) | roman_point(t), "label": is_label}[points]
    fits = root.rlike(f"^{root_form}$") & (spelled == plain) & F.forall(tokens, lambda t: t.rlike("^[A-Za-z0-9.]+$") & ok(t))
    letters = lambda t: F.when(t.rlike("^[a-z]{2,}$") & ~t.isin(*ROMAN), F.filter(F.split(t, ""), lambda c: c != "")).otherwise(F.array(t))
    path = F.flatten(F.transform(tokens, letters)) if split_letters else tokens
    return F.when(fits, F.concat(F.array(root), path))


def relation_types(text: Column) -> Column:
    """What a clause that names other zones takes over from them."""
    uses, rules = _has(text, "uses permitted", "uses as permitted"), _has(text, "regulations", "subject to")
    found = F.array_compact(F.array(F.when(uses, "inherits_uses"), F.when(rules, "inherits_regulations")))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("references_zone")))


def names_zone_rules(text: Column) -> Column:
    """Does a clause, if it names a zone, refer to that zone's uses or regulations?"""
    return _has(text, "uses permitted", "uses as permitted", "subject to the regulations", "subject to regulations", "regulations for permitted uses")


def join_behaviour(kind: Column) -> Column:
    return F.when(F.startswith(kind, F.lit("inherits_")), "include_target_values").otherwise("reference_only")


def citation_range(bylaw_start: Column, bylaw_end: Column, pdf_start: Column, pdf_end: Column) -> Column:
    """``bylaw page 3-4; PDF page 9`` of what is known."""
    span = lambda name, a, b: F.when(a.isNotNull() & (a != 0), F.concat(F.lit(name), a.cast("string"), F.when(b.isNotNull() & (b != 0) & (b != a), F.concat(F.lit("-"), b.cast("string"))).otherwise("")))
    return F.concat_ws("; ", span("bylaw page ", bylaw_start, bylaw_end), span("PDF page ", pdf_start, pdf_end))
