"""Stand-ins that let the generic operators run over the synthetic tables.

The tables hold no radiology text, so frequent words stand for the phrases of each label and
for negation triggers. No two-word phrase begins with the second word of another one, which
keeps the SQL that checks the phrase lookup simple; the lookup itself has no such limit.
"""

from __future__ import annotations

from reportweave import vocab
from reportweave.functions.entities import NegationRules

_WORDS = (
    "of that it for was on be as this are at an from th re er nd ha he ou st ed ing ti or tion "
    "ea nt ly ble sh wh then than thing anea erin der die den das zu auf le que les un el los"
).split()

PHRASES: dict[str, str] = dict(zip(_WORDS, vocab.DOMAINS))
PHRASES |= {
    "of the": "pathology_ischaemic",
    "to the": "descriptor_cyst",
    "de la": "pathology_traumatic",
    "in the": "location_other",
    "la": "pathology_vascular",
    "du": "pathology_neoplastic_paraneoplastic",
    "sich": "descriptor_flow",
    "mit": "location_white_matter",
    "rewh": "pathology_endocrine",
    "ononst": "pathology_cerebrovascular",
}
WORD_PHRASES = {p: label for p, label in PHRASES.items() if " " not in p}

RULES = NegationRules(
    preceding=("no", "not", "without", "with", "nicht", "pas", "sans", "is"),
    following=("by", "von", "par", "por"),
    termination=("and", "und", "et", "y"),
    pseudo=("with the", "is the"),
)

PLACE_WORDS = tuple(p for p, label in WORD_PHRASES.items() if label.startswith("location_"))
FINDING_WORDS = tuple(p for p in WORD_PHRASES if p not in PLACE_WORDS)

SECTION_MARKERS = {
    "from": "report_header",
    "with": "report_indications",
    "was": "report_metareport",
    "und": "report_body",
    "des": "report_body",
    "by": "report_body",
    "this": "report_tail",
}

CLASS_WORDS = {
    "ABNORMAL": ("no", "not", "nicht"),
    "IS_NORMAL": ("the", "der", "le"),
    "IS_NORMAL_FOR_AGE": ("of", "und", "de"),
    "IS_COMPARATIVE": ("and", "die", "la", "el"),
    "IS_MISSING": ("by",),
}

SAMPLE_SEED = 42
