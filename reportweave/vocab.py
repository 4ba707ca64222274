"""Fixed vocabularies of the report model."""

# --- fixed values: label names and their order define tensor and column positions ---
LOCATIONS = (
    "location_arteries",
    "location_brain_stem",
    "location_diencephalon",
    "location_ent",
    "location_eye",
    "location_ganglia",
    "location_grey_matter",
    "location_limbic_system",
    "location_meninges",
    "location_nerves",
    "location_neurosecretory_system",
    "location_other",
    "location_skull",
    "location_spine",
    "location_telencephalon",
    "location_veins",
    "location_ventricles",
    "location_white_matter",
    "location_qualifier",
)

DESCRIPTORS = (
    "descriptor_cyst",
    "descriptor_damage",
    "descriptor_diffusion",
    "descriptor_signal_change",
    "descriptor_enhancement",
    "descriptor_flow",
    "descriptor_interval_change",
    "descriptor_mass_effect",
    "descriptor_morphology",
    "descriptor_collection",
    "descriptor_necrosis",
)

PATHOLOGIES = (
    "pathology_haemorrhagic",
    "pathology_ischaemic",
    "pathology_vascular",
    "pathology_cerebrovascular",
    "pathology_treatment",
    "pathology_inflammatory_autoimmune",
    "pathology_congenital_developmental",
    "pathology_csf_disorders",
    "pathology_musculoskeletal",
    "pathology_neoplastic_paraneoplastic",
    "pathology_infectious",
    "pathology_neurodegenerative_dementia",
    "pathology_metabolic_nutritional_toxic",
    "pathology_endocrine",
    "pathology_opthalmological",
    "pathology_traumatic",
)

SECTIONS = (
    "report_header",
    "report_indications",
    "report_metareport",
    "report_body",
    "report_tail",
)

NORMALITY_CLASSES = (
    "ABNORMAL",
    "IS_MISSING",
    "IS_COMPARATIVE",
    "IS_NORMAL",
    "IS_NORMAL_FOR_AGE",
)

NORMALITY_DISPLAY = {
    "ABNORMAL": "Abnormal",
    "IS_MISSING": "Missing",
    "IS_NORMAL_FOR_AGE": "Normal_for_age",
    "IS_COMPARATIVE": "Comparative",
    "IS_NORMAL": "Normal",
}

EXCLUDED_FROM_EVALUATION = "pathology_musculoskeletal"

PLACEHOLDER = "<placeholder>"
OUTSIDE = "O"
MASKED_LABEL = -100
# --- end of fixed values ---

DOMAINS = LOCATIONS + DESCRIPTORS + PATHOLOGIES

# Pathologies that are scored against human labels, in alphabetical order.
EVALUATION_PATHOLOGIES = tuple(sorted(p for p in PATHOLOGIES if p != EXCLUDED_FROM_EVALUATION))

# Types that may be negated: every finding, no location.
NEGATABLE = PATHOLOGIES + DESCRIPTORS

# Tensor axes: entities, locations (slot 0 = no location), assertion (0 asserted, 1 negated).
TENSOR_ENTITIES = PATHOLOGIES + DESCRIPTORS
TENSOR_LOCATIONS = ("location_unk",) + LOCATIONS
TENSOR_CELLS = len(TENSOR_ENTITIES) * len(TENSOR_LOCATIONS) * 2

# Text cells that a CSV reader takes as missing (the default list of pandas.read_csv).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters that Python's str.strip removes; same meaning in Java and RE2.
BLANK_RANGES = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# One token per letter run, per number run and per other character that is not blank.
TOKEN_PATTERN = rf"(\p{{L}}+|\p{{N}}+|[^\p{{L}}\p{{N}}{BLANK_RANGES}])"
# A token together with the blanks behind it: these pieces cover a text with no leading blanks.
PIECE_PATTERN = rf"{TOKEN_PATTERN}[{BLANK_RANGES}]*"

# The same tokens and pieces for Java alone, which reads them faster: no group, nothing tried twice, and
# blanks below U+0100 one by one, as those are looked up in a table. What is no letter and no number
# after the first two branches needs no test for either; a piece never begins with a blank.
_JAVA_BLANKS = (
    r" \x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
JAVA_TOKEN_PATTERN = rf"\p{{L}}++|\p{{N}}++|[^{_JAVA_BLANKS}]"
JAVA_PIECE_PATTERN = rf"(?:\p{{L}}++|\p{{N}}++|(?s:.))[{_JAVA_BLANKS}]*+"
JAVA_BLANK_PATTERN = rf"[{_JAVA_BLANKS}]++"

SENTENCE_ENDS = (".", "!", "?")
