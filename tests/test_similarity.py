"""The comparison of sections against a plain form of the reference's rules."""

from __future__ import annotations

import random
import re
from difflib import SequenceMatcher

from parcelforge.operators import similarity

FAMILIES = {
    "permitted_uses": ("permitted uses", "permitted with conditions", "conditional uses"),
    "built_form": ("built form requirements", "development standards", "lot requirements", "yard requirements", "setback requirements", "building height"),
    "landscaping": ("landscape requirements", "landscaping", "land use buffers"), "signage": ("sign",),
}
SCHEMA = "key long, document_type string, zone_code string, title string, topic string, text string"


def _norm(v):
    return re.sub("[^a-z0-9]+", " ", (v or "").lower()).strip()


def _tokens(v):
    return {w for w in _norm(v).split(" ") if len(w) > 2}


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def _ratio(a, b):
    return SequenceMatcher(None, _norm(a), _norm(b)).ratio() if _norm(a) and _norm(b) else 0.0


def _family(v):
    return next((f for f, phrases in FAMILIES.items() if any(p in _norm(v) for p in phrases)), None)


def _expected(current, draft):
    out = {}
    for a, kind_a, zone_a, title_a, topic_a, text_a in current:
        scored = []
        for b, kind_b, zone_b, title_b, topic_b, text_b in draft:
            if not _norm(text_a) or not _norm(text_b) or (kind_a and kind_b and kind_a != kind_b):
                continue
            exact, family, title = _norm(title_a) == _norm(title_b), bool(_family(title_a)) and _family(title_a) == _family(title_b), _ratio(title_a, title_b)
            if zone_a and zone_b and zone_a == zone_b:
                eligible = exact or family
            elif zone_a or zone_b:
                eligible = False
            else:
                eligible = exact or family or (bool(topic_a) and topic_a == topic_b and title >= 0.62)
            text = _jaccard(_tokens(text_a), _tokens(text_b))
            score = max(title, _jaccard(_tokens(title_a), _tokens(title_b)) * 0.95, text * 0.75)
            score += 0.08 if topic_a and topic_a == topic_b else 0.0
            score = min(score + (0.12 if zone_a and zone_a == zone_b else 0.0), 1.0)
            if eligible and (exact or title >= 0.68 or text >= 0.32 or (family and score >= 0.50)):
                kind = "same_topic" if title >= 0.92 or score >= 0.92 else "renamed_or_restructured" if text >= 0.45 or score >= 0.72 else "partial_overlap"
                scored.append((-score, -title, -text, b, kind))
        for rank, (score, title, text, b, kind) in enumerate(sorted(scored)[:3], 1):
            out[a, b] = (round(-score, 9), round(-title, 9), round(-text, 9), kind, rank)
    return out


def test_candidates(spark):
    rng = random.Random(5)
    titles = ["Permitted Uses", "Conditional uses", "Lot requirements", "Yard requirements", "Signs", "Landscaping", "Parking", "Parkings", "Car parking lots", "Permits", "", None, "General rules"]
    words = ["lot", "yard", "house", "shop", "metre", "height", "front", "rear", "tree", "sign"]

    def sections(start):
        return [
            (start + i, rng.choice(["zone", "zone", "other", None, ""]), rng.choice(["R1", "R2", None, "", None]), rng.choice(titles), rng.choice(["uses", "parking", None, ""]),
             rng.choice([None, "", "-"]) if rng.random() < 0.1 else " ".join(rng.sample(words, rng.randint(1, 6))))
            for i in range(60)
        ]

    current, draft = sections(0), sections(1000)
    found = similarity.candidates(spark.createDataFrame(current, SCHEMA), spark.createDataFrame(draft, SCHEMA)).collect()
    got = {(r["current_key"], r["draft_key"]): (round(r["score"], 9), round(r["title_similarity"], 9), round(r["text_similarity"], 9), r["equivalence_type"], r["rank"]) for r in found}
    assert len(got) == len(found) and got == _expected(current, draft)
    assert {v[3] for v in got.values()} == {"same_topic", "renamed_or_restructured", "partial_overlap"}
