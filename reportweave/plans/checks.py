"""SQL that says the same as each registered query, for an independent engine.

Written over long tables with windows and joins, where the queries mostly stay inside rows.
"""

from __future__ import annotations

import re

from reportweave import vocab
from reportweave.plans import standins as st

SEED = st.SAMPLE_SEED


def _text(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _phrase_rows(phrases: dict[str, str]) -> str:
    return "VALUES " + ", ".join(
        f"('{p}', '{label}', {len(p.split(' '))})" for p, label in phrases.items()
    )


def _tokens_of(source: str, ident: str) -> str:
    """Tokens from pieces that cover the text; blanks are dropped after the offsets are known."""
    return rf"""
SELECT {ident}, CAST(row_number() OVER (PARTITION BY {ident} ORDER BY p) - 1 AS BIGINT) AS i,
       tok, lower(tok) AS w, CAST(stop - length(tok) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop
FROM (SELECT {ident}, p, tok, sum(length(tok)) OVER (PARTITION BY {ident} ORDER BY p) AS stop
      FROM (SELECT {ident}, unnest(l) AS tok, unnest(range(len(l))) AS p
            FROM (SELECT {ident}, regexp_extract_all(text, '(\p{{L}}+|\p{{N}}+|[^\p{{L}}\p{{N}}])') AS l
                  FROM {source})))
WHERE NOT regexp_full_match(tok, '[{vocab.BLANK_RANGES}]')"""


def _marks_of(phrases: str) -> str:
    """Longest phrase first; a two-word phrase hides what starts inside it."""
    return f"""
SELECT doc_id, i AS tok_start, CASE WHEN l2 IS NULL THEN i + 1 ELSE i + 2 END AS tok_end,
       coalesce(l2, l1) AS label, start, CASE WHEN l2 IS NULL THEN stop ELSE stop2 END AS stop
FROM (SELECT *, lag(l2) OVER (PARTITION BY doc_id ORDER BY i) AS hidden
      FROM (SELECT t.doc_id, t.i, t.start, t.stop, t.stop2, p2.label AS l2, p1.label AS l1
            FROM (SELECT *, w || ' ' || lead(w) OVER d AS w2, lead(stop) OVER d AS stop2
                  FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY i)) t
            LEFT JOIN {phrases} p2 ON p2.n = 2 AND p2.phrase = t.w2
            LEFT JOIN {phrases} p1 ON p1.n = 1 AND p1.phrase = t.w))
WHERE l2 IS NOT NULL OR (l1 IS NOT NULL AND hidden IS NULL)"""


_SECTION_OF = """CASE WHEN role = 'system' THEN 'report_header'
  WHEN role = 'user' AND turn <= 1 THEN 'report_indications'
  WHEN role = 'user' THEN 'report_metareport'
  WHEN turn <= 2 THEN 'report_body' ELSE 'report_tail' END"""

_KEEP = _text(vocab.EVALUATION_PATHOLOGIES)

PARTS: dict[str, str] = {
    "tokens": _tokens_of("documents", "doc_id"),
    "phrases(phrase, label, n)": _phrase_rows(st.PHRASES),
    "word_phrases(phrase, label, n)": _phrase_rows(st.WORD_PHRASES),
    "trigger_phrases(phrase, label, n)": _phrase_rows(st.RULES.phrases()),
    "marks": _marks_of("phrases"),
    "word_marks": _marks_of("word_phrases"),
    "triggers": _marks_of("trigger_phrases"),
    "segment_starts": f"""
SELECT DISTINCT doc_id, i FROM (
  SELECT doc_id, tok_start AS i FROM triggers WHERE label = 'termination'
  UNION ALL SELECT doc_id, i + 1 FROM tokens WHERE tok IN ({_text(vocab.SENTENCE_ENDS)}))""",
    "segmented": """
SELECT t.doc_id, t.i, sum(CASE WHEN s.i IS NULL THEN 0 ELSE 1 END)
         OVER (PARTITION BY t.doc_id ORDER BY t.i) AS seg
FROM tokens t LEFT JOIN segment_starts s ON s.doc_id = t.doc_id AND s.i = t.i""",
    "segment_triggers": """
SELECT g.doc_id, g.seg, min(CASE WHEN label = 'preceding' THEN tok_start END) AS first_pre,
       max(CASE WHEN label = 'following' THEN tok_end END) AS last_fol
FROM triggers t JOIN segmented g ON g.doc_id = t.doc_id AND g.i = t.tok_start GROUP BY ALL""",
    "ents": f"""
SELECT m.doc_id, CAST(row_number() OVER (PARTITION BY m.doc_id ORDER BY m.tok_start) - 1 AS BIGINT) AS ent_pos,
       m.label AS entity_group, m.tok_start, m.tok_end, m.start, m.stop,
       m.label IN ({_text(vocab.NEGATABLE)}) AND a.seg = b.seg
         AND (coalesce(g.first_pre < m.tok_start, false) OR coalesce(g.last_fol > m.tok_end, false)) AS negated
FROM marks m
JOIN segmented a ON a.doc_id = m.doc_id AND a.i = m.tok_start
JOIN segmented b ON b.doc_id = m.doc_id AND b.i = m.tok_end - 1
LEFT JOIN segment_triggers g ON g.doc_id = m.doc_id AND g.seg = a.seg""",
    "neg_spans": """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS BIGINT) AS neg_pos,
       CASE WHEN w IN ('no', 'not', 'nicht', 'pas', 'sans', 'is') THEN 'negated' ELSE 'asserted' END AS grp,
       start, start + 40 AS stop
FROM tokens WHERE w IN ('no', 'not', 'nicht', 'pas', 'sans', 'is', 'with', 'by', 'von', 'par')""",
    "tags": """
SELECT t.doc_id, t.i, t.tok, t.start, t.stop,
       CASE WHEN e.tok_start IS NULL THEN 'O' WHEN e.tok_start = t.i THEN 'B-' || e.entity_group
            ELSE 'I-' || e.entity_group END AS tag,
       CASE WHEN e.tok_start IS NULL THEN 'O'
            ELSE (CASE WHEN e.tok_start = t.i THEN 'B-' ELSE 'I-' END)
              || (CASE WHEN e.negated THEN 'negated' ELSE 'asserted' END) END AS status_tag
FROM tokens t LEFT JOIN ents e ON e.doc_id = t.doc_id AND t.i >= e.tok_start AND t.i < e.tok_end""",
    "tag_ids": """
SELECT tag, CAST(row_number() OVER (ORDER BY tag) - 1 AS BIGINT) AS id
FROM (SELECT DISTINCT tag FROM tags)""",
    "classed": """
SELECT d.doc_id, d.text,
       CASE WHEN l.quality = 1 AND length(d.text) > 3000 THEN 'IS_NORMAL_FOR_AGE'
            WHEN l.quality = 1 AND l.toxic = 0 AND length(d.text) > 1500 THEN 'IS_NORMAL'
            WHEN l.toxic = 1 THEN 'IS_COMPARATIVE'
            WHEN length(d.text) < 300 THEN 'IS_MISSING' ELSE 'ABNORMAL' END AS normality_class
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "section_texts": f"""
SELECT conv_id, section, CAST(min(turn) AS BIGINT) AS ord, string_agg(text, ' ' ORDER BY turn) AS text
FROM (SELECT conv_id, turn, text, {_SECTION_OF} AS section FROM conversations WHERE text <> '')
GROUP BY conv_id, section""",
    "section_names(section, k)": "VALUES " + ", ".join(
        f"('{s}', {k})" for k, s in enumerate(vocab.SECTIONS, start=1)),
    "markers(w, section)": "VALUES " + ", ".join(
        f"('{w}', '{s}')" for w, s in st.SECTION_MARKERS.items()),
    "slices": """
SELECT doc_id, CAST(row_number() OVER d - 1 AS BIGINT) AS ord, section, i AS tok_from,
       coalesce(lead(i) OVER d, n) AS tok_to
FROM (SELECT t.doc_id, t.i, m.section, c.n FROM tokens t JOIN markers m ON m.w = t.w
      JOIN (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id) c ON c.doc_id = t.doc_id)
WINDOW d AS (PARTITION BY doc_id ORDER BY i)""",
    "doc_sections": """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_ord) - 1 AS BIGINT) AS ord, section, text
FROM (SELECT s.doc_id, s.section, min(s.ord) AS first_ord,
             string_agg(substr(d.text, a.start + 1, b.stop - a.start), ' ' ORDER BY s.ord) AS text
      FROM slices s JOIN documents d ON d.doc_id = s.doc_id
      JOIN tokens a ON a.doc_id = s.doc_id AND a.i = s.tok_from
      JOIN tokens b ON b.doc_id = s.doc_id AND b.i = s.tok_to - 1
      GROUP BY s.doc_id, s.section)""",
    "section_starts": r"""
SELECT conv_id, section, k, text, regexp_extract(text, '(\p{L}+|\p{N}+|[^\p{L}\p{N}\s])', 1) AS first_token,
       sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY k) - length(text) - 1
         + length(text) - length(ltrim(text, chr(10) || chr(9) || chr(13) || ' ')) AS start
FROM section_texts JOIN section_names USING (section) WHERE text <> ''""",
    "gold": f"""
SELECT doc_id, entity_group AS label FROM ents WHERE entity_group IN ({_KEEP})
GROUP BY doc_id, entity_group HAVING count(*) >= 2""",
    "pred": f"""
SELECT DISTINCT doc_id, entity_group AS label FROM ents
WHERE NOT negated AND entity_group IN ({_KEEP})""",
    "grid": """
SELECT d.doc_id, c.label, g.doc_id IS NOT NULL AS gold, p.doc_id IS NOT NULL AS pred
FROM documents d CROSS JOIN (SELECT DISTINCT label FROM gold) c
LEFT JOIN gold g ON g.doc_id = d.doc_id AND g.label = c.label
LEFT JOIN pred p ON p.doc_id = d.doc_id AND p.label = c.label""",
    "confusion": """
SELECT label, count(*) FILTER (NOT gold AND NOT pred) AS tn, count(*) FILTER (NOT gold AND pred) AS fp,
       count(*) FILTER (gold AND NOT pred) AS fn, count(*) FILTER (gold AND pred) AS tp
FROM grid GROUP BY label""",
    "spec": """
SELECT label, tn / nullif(tn + fp, 0)::DOUBLE AS specificity, tp + fn AS support, tn, fp FROM confusion""",
    "specificities": """
SELECT label, specificity FROM spec
UNION ALL SELECT 'micro avg', sum(tn) / nullif(sum(tn + fp), 0)::DOUBLE FROM spec
UNION ALL SELECT 'macro avg', CASE WHEN count(specificity) = count(*) THEN avg(specificity) END FROM spec
UNION ALL SELECT 'weighted avg', CASE WHEN count(specificity) = count(*)
  THEN sum(specificity * support) / sum(support) END FROM spec""",
    "label_scores": """
SELECT label, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0.0) AS precision,
       coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0.0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0.0) AS f1, tp + fn AS support, tp, fp, fn
FROM confusion""",
    "doc_scores": """
SELECT doc_id, count(*) FILTER (gold AND pred) AS hits, count(*) FILTER (gold) AS ng, count(*) FILTER (pred) AS np
FROM grid GROUP BY doc_id""",
    "report": """
SELECT label, precision, recall, f1, support FROM label_scores
UNION ALL SELECT 'micro avg', sum(tp) / nullif(sum(tp + fp), 0)::DOUBLE, sum(tp) / nullif(sum(tp + fn), 0)::DOUBLE,
  2 * sum(tp) / nullif(sum(2 * tp + fp + fn), 0)::DOUBLE, sum(support) FROM label_scores
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM label_scores
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM label_scores
UNION ALL SELECT 'samples avg', avg(coalesce(hits / nullif(np, 0)::DOUBLE, 0.0)),
  avg(coalesce(hits / nullif(ng, 0)::DOUBLE, 0.0)), avg(coalesce(2 * hits / nullif(ng + np, 0)::DOUBLE, 0.0)),
  sum(ng) FROM doc_scores""",
    "sents": f"""
SELECT doc_id, i, tok, w, coalesce(sum(CASE WHEN tok IN ({_text(vocab.SENTENCE_ENDS)}) THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent
FROM tokens""",
    "deps": """
SELECT doc_id, sent, i, tok, w, f + (i - f) // 2 AS head,
       ['amod', 'nsubj', 'prep', 'pobj'][length(tok) % 4 + 1] AS dep
FROM (SELECT *, min(i) OVER (PARTITION BY doc_id, sent) AS f FROM sents)""",
    "links": """
SELECT a.doc_id, a.i AS tok_i, b.i AS tok_j FROM deps a
JOIN deps b ON b.doc_id = a.doc_id AND b.sent = a.sent AND b.head = a.i AND b.i <> a.i
WHERE a.dep = 'nsubj' AND b.dep = 'pobj'
UNION SELECT a.doc_id, a.i, c.i FROM deps a
JOIN deps b ON b.doc_id = a.doc_id AND b.sent = a.sent AND b.i = a.i + 1
JOIN deps c ON c.doc_id = b.doc_id AND c.sent = b.sent AND c.i = b.head AND c.i <> b.i
WHERE a.dep = 'amod' AND b.dep = 'prep' AND c.dep IN ('pobj', 'nsubj')
UNION SELECT a.doc_id, a.i, b.i FROM deps a
JOIN deps b ON b.doc_id = a.doc_id AND b.sent = a.sent AND b.head = a.head AND b.i > a.i
WHERE a.w = 'of' AND b.dep = 'nsubj' AND a.head <> a.i AND b.head <> b.i
""" + f"""UNION SELECT a.doc_id, a.i, b.i FROM deps a
JOIN deps b ON b.doc_id = a.doc_id AND b.sent = a.sent AND b.i <> a.i AND (b.head = a.i OR b.i = a.head)
WHERE a.w IN ({_text(st.FINDING_WORDS)}) AND b.w IN ({_text(st.PLACE_WORDS)})""",
    "pairs": """
SELECT DISTINCT l.doc_id, s.ent_pos, s.entity_group, t.ent_pos AS target_pos, t.entity_group AS target_group
FROM links l
JOIN ents s ON s.doc_id = l.doc_id AND l.tok_i >= s.tok_start AND l.tok_i < s.tok_end
JOIN ents t ON t.doc_id = l.doc_id AND l.tok_j >= t.tok_start AND l.tok_j < t.tok_end""",
    "triplets": f"""
SELECT doc_id, entity, location, negated, count(*) AS n FROM (
  SELECT doc_id, entity_group AS entity, 'location_unk' AS location, negated FROM ents
  WHERE entity_group IN ({_text(vocab.TENSOR_ENTITIES)})
  UNION ALL SELECT e.doc_id, e.entity_group, p.target_group, e.negated
  FROM ents e JOIN pairs p ON p.doc_id = e.doc_id AND p.ent_pos = e.ent_pos
  WHERE e.entity_group IN ({_text(vocab.TENSOR_ENTITIES)}) AND p.target_group IN ({_text(vocab.LOCATIONS)}))
GROUP BY ALL""",
    "model_rows": """
SELECT coalesce(lag(tok) OVER (PARTITION BY doc_id ORDER BY i), '<s>') AS prev, tok, tag FROM tags""",
    "pair_counts": "SELECT prev, tok, tag, count(*) AS n FROM model_rows GROUP BY ALL",
    "model": """
SELECT prev, tok, tag, CAST(total AS BIGINT) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY prev, tok ORDER BY n DESC, tag DESC) AS r,
         sum(n) OVER (PARTITION BY prev, tok) AS total FROM pair_counts) WHERE r = 1
UNION ALL SELECT NULL, tok, tag, CAST(total AS BIGINT) FROM (
  SELECT *, row_number() OVER (PARTITION BY tok ORDER BY n DESC, tag DESC) AS r,
         sum(n) OVER (PARTITION BY tok) AS total
  FROM (SELECT tok, tag, sum(n) AS n FROM pair_counts GROUP BY ALL)) WHERE r = 1""",
    "turns": "SELECT conv_id * 1000 + turn AS turn_id, text FROM conversations",
    "turn_tokens": _tokens_of("turns", "turn_id"),
    "turn_rows": """
SELECT turn_id, i, tok, coalesce(lag(tok) OVER (PARTITION BY turn_id ORDER BY i), '<s>') AS prev FROM turn_tokens""",
    "tag_steps": """
SELECT prev, tag, count(*) AS n FROM (
  SELECT coalesce(lag(tag) OVER (PARTITION BY doc_id ORDER BY i), '<s>') AS prev, tag FROM tags) GROUP BY ALL""",
    "tag_names": "SELECT tag FROM tags UNION SELECT 'O'",
    "tag_moves": """
SELECT p.prev, t.tag, CAST(round(1000 * ln((coalesce(s.n, 0) + 1.0::DOUBLE)
    / (coalesce(b.n, 0) + (SELECT count(*) FROM tag_names)))) AS BIGINT) AS score
FROM (SELECT tag AS prev FROM tag_names UNION ALL SELECT '<s>') p CROSS JOIN tag_names t
LEFT JOIN tag_steps s ON s.prev = p.prev AND s.tag = t.tag
LEFT JOIN (SELECT prev, sum(n) AS n FROM tag_steps GROUP BY prev) b ON b.prev = p.prev
WHERE NOT starts_with(t.tag, 'I-') OR p.prev IN ('I-' || substr(t.tag, 3), 'B-' || substr(t.tag, 3))""",
    "tag_choices": """
SELECT c.tok, c.tag, CAST(round(1000 * ln((c.n + 0.5::DOUBLE) / (coalesce(t.n, 0) + 1))) AS BIGINT) AS score
FROM (SELECT tok, tag, sum(n) AS n FROM (SELECT tok, tag, n FROM pair_counts
        UNION ALL SELECT DISTINCT tok, 'O', 0 FROM pair_counts) GROUP BY ALL) c
LEFT JOIN (SELECT tag, sum(n) AS n FROM tag_steps GROUP BY tag) t ON t.tag = c.tag""",
    "turn_choices": """
SELECT r.turn_id, r.i, coalesce(c.tag, 'O') AS tag, coalesce(c.score, 0) AS score
FROM turn_rows r LEFT JOIN tag_choices c ON c.tok = r.tok""",
    "split_reports": f"""
SELECT *, CASE WHEN r <= n - ceil(0.2::DOUBLE * n) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r FROM classed)""",
    "report_words": r"""
SELECT doc_id, word, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents) GROUP BY ALL""",
    "class_words": """
SELECT s.normality_class AS label, w.word, sum(w.n) AS n
FROM split_reports s JOIN report_words w ON w.doc_id = s.doc_id WHERE s.split = 'train' GROUP BY ALL""",
    "class_sizes": """
SELECT c.label, CAST(round(1000000 * ln(c.n::DOUBLE / sum(c.n) OVER ())) AS BIGINT) AS prior,
       coalesce(w.n, 0) + (SELECT count(DISTINCT word) FROM class_words) AS base
FROM (SELECT normality_class AS label, count(*) AS n FROM split_reports WHERE split = 'train' GROUP BY ALL) c
LEFT JOIN (SELECT label, sum(n) AS n FROM class_words GROUP BY label) w ON w.label = c.label""",
    "class_scores": """
SELECT s.doc_id, k.label, any_value(k.prior) + coalesce(sum(w.n * CAST(round(1000000
    * ln((coalesce(c.n, 0) + 1)::DOUBLE / k.base)) AS BIGINT)), 0) AS score
FROM split_reports s CROSS JOIN class_sizes k
LEFT JOIN (SELECT * FROM report_words WHERE word IN (SELECT word FROM class_words)) w ON w.doc_id = s.doc_id
LEFT JOIN class_words c ON c.label = k.label AND c.word = w.word GROUP BY s.doc_id, k.label""",
    "mask_spans": """
SELECT doc_id, start, stop, coalesce(max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS kept_from
FROM (SELECT doc_id, start, start + 15 AS stop FROM neg_spans)""",
    "ranked_lang": f"""
SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r,
       count(*) OVER (PARTITION BY lang) AS cnt FROM documents""",
    "featured": f"""
SELECT doc_id, row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r, count(*) OVER () AS cnt
FROM documents WHERE regexp_matches(text, 'idiot|nicht|Atth')""",
}

_ORDER = list(PARTS)
_NAMES = {key: key.split("(")[0] for key in PARTS}


def _mentioned(sql: str) -> set[str]:
    words = set(re.findall(r"\w+", sql))
    return {key for key, name in _NAMES.items() if name in words}


def compose(select: str, recursive: str = "") -> str:
    """A query with the parts it mentions, and the parts those mention, in order."""
    needed: set[str] = set()
    todo = _mentioned(select + recursive)
    while todo:
        key = todo.pop()
        if key not in needed:
            needed.add(key)
            todo |= _mentioned(PARTS[key]) - {key}
    ctes = [f"{key} AS MATERIALIZED ({PARTS[key]})" for key in _ORDER if key in needed]
    if recursive:
        ctes.append(recursive)
    if not ctes:
        return select
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select


def _draws(group: str, n: int, by: str) -> str:
    return f"""SELECT unnest(range({n})) AS draw, * FROM {by}"""


def _wide(ents: str = "ents") -> str:
    cells = [
        f"count(*) FILTER (e.entity_group = '{d}' AND {'' if flag else 'NOT '}e.negated) AS {prefix}{d}"
        for flag, prefix in ((0, "asserted_"), (1, "denied_"))
        for d in vocab.DOMAINS
    ]
    return (
        "SELECT d.doc_id, " + ", ".join(cells)
        + f" FROM documents d LEFT JOIN {ents} e ON e.doc_id = d.doc_id GROUP BY d.doc_id"
    )


def _number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


# All spans are 40 wide, so the first that overlaps is the next to start from 40 before.
_OVERLAP = """
SELECT m.doc_id, m.ent_pos, m.entity_group,
       coalesce(s.start <= m.stop AND s.grp = 'negated', false) AS negated{extra}
FROM {marks} m ASOF LEFT JOIN neg_spans s ON s.doc_id = m.doc_id AND m.start - 40 <= s.start"""

_NUMBERED_WORDS = """(SELECT doc_id, label AS entity_group, start, stop,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY tok_start) - 1 AS BIGINT) AS ent_pos FROM word_marks)"""


def checks() -> dict[str, str]:
    c: dict[str, str] = {}
    c["tokenise"] = 'SELECT doc_id, i, tok, start, stop AS "end" FROM tokens'
    c["gazetteer_mentions"] = (
        "SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY tok_start) - 1 AS BIGINT) AS ent_pos,"
        ' label AS entity_group, start, stop AS "end", tok_start, tok_end FROM marks'
    )
    c["negex"] = (
        "SELECT e.doc_id, ent_pos, entity_group, substr(d.text, start + 1, stop - start) AS word, start,"
        ' stop AS "end", negated FROM ents e JOIN documents d ON d.doc_id = e.doc_id'
    )
    c["gazetteer_negex"] = c["negex"]
    c["mention_negation"] = _OVERLAP.format(marks="ents", extra="")
    c["mention_negation_nested"] = c["mention_negation"]
    c["annotate"] = _OVERLAP.format(marks=_NUMBERED_WORDS, extra=', m.start, m.stop AS "end"')
    c["annotate_windows"] = c["annotate"]
    counted = [f"count(*) FILTER (w IN ({_text(words)}))" for words in st.CLASS_WORDS.values()]
    shown = _text(vocab.NORMALITY_DISPLAY[k] for k in st.CLASS_WORDS)
    c["classify_by_model"] = f"""
SELECT doc_id, [{shown}][list_position(n, list_max(n))] AS label,
       round((list_max(n) + 1) / (list_sum(n) + {len(counted)})::DOUBLE, 6) AS score
FROM (SELECT d.doc_id, [{", ".join(counted)}] AS n
      FROM documents d LEFT JOIN tokens t ON t.doc_id = d.doc_id GROUP BY d.doc_id)"""
    c["annotate_counts"] = _wide(f"({c['annotate']})")
    c["domain_counts"] = (
        "SELECT doc_id, entity_group, negated, count(*) AS n FROM ents GROUP BY ALL"
    )
    c["domain_counts_wide"] = _wide()
    c["asserted_labels"] = """
SELECT d.doc_id, coalesce(string_agg(DISTINCT e.entity_group, ',' ORDER BY e.entity_group), '') AS labels
FROM documents d LEFT JOIN ents e ON e.doc_id = d.doc_id AND NOT e.negated GROUP BY d.doc_id"""
    c["exclude_label_docs"] = f"""
SELECT d.doc_id, count(e.ent_pos) AS n_ents FROM documents d LEFT JOIN ents e ON e.doc_id = d.doc_id
GROUP BY d.doc_id HAVING count(*) FILTER (e.entity_group = '{vocab.EXCLUDED_FROM_EVALUATION}') = 0"""

    c["blank_placeholder"] = f"""
SELECT c.conv_id, n.section, CASE WHEN trim(coalesce(s.text, '')) = '' THEN '{vocab.PLACEHOLDER}' ELSE s.text END AS text
FROM (SELECT DISTINCT conv_id FROM conversations) c CROSS JOIN section_names n
LEFT JOIN section_texts s ON s.conv_id = c.conv_id AND s.section = n.section"""
    c["length_band"] = "SELECT doc_id, length(text) AS n FROM documents WHERE length(text) > 30 AND length(text) < 1000"
    c["keyword_filter"] = "SELECT doc_id FROM documents WHERE regexp_matches(text, 'idiot|nicht|Atth')"
    c["normalise_labels"] = """
SELECT replace(replace(entity_group, '_', '-'), 'opthalm', 'ophthalm') AS raw, entity_group AS label, count(*) AS n
FROM ents GROUP BY ALL"""
    c["normality_class"] = "SELECT doc_id, normality_class FROM classed"
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.NORMALITY_DISPLAY.items())
    c["map_labels"] = f"SELECT doc_id, CASE normality_class {names} END AS name FROM classed"
    c["nonempty_section"] = "SELECT conv_id, text FROM section_texts WHERE section = 'report_body' AND text <> ''"
    c["first_choice"] = """
SELECT d.doc_id, min(p.label) AS choice FROM documents d LEFT JOIN pred p ON p.doc_id = d.doc_id GROUP BY d.doc_id"""
    x, y = (_number(f"'{k}:' || doc_id") for k in "xy")
    c["random_map"] = f"SELECT doc_id, {x} / 4294967296.0::DOUBLE AS x, {y} / 4294967296.0::DOUBLE AS y FROM documents"

    c["stratified_sample"] = "SELECT doc_id, lang FROM ranked_lang WHERE r <= 50"
    c["normality_sample"] = f"""
SELECT doc_id, normality_class FROM (SELECT doc_id, normality_class,
  row_number() OVER (PARTITION BY normality_class ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r FROM classed)
WHERE r <= 100"""
    slot = _number(f"'draw:{SEED}:' || g.lang || ':' || g.draw")
    c["bootstrap_sample"] = f"""
SELECT d.doc_id, g.lang, g.draw FROM (
  SELECT lang, cnt, unnest(range(50)) AS draw FROM (SELECT DISTINCT lang, cnt FROM ranked_lang)) g
JOIN ranked_lang d ON d.lang = g.lang AND d.r = {slot} % g.cnt + 1"""
    c["simple_sample"] = f"SELECT doc_id FROM documents ORDER BY md5('{SEED}:' || doc_id), doc_id LIMIT 100"
    slot = _number(f"'draw:{SEED}:0:' || g.draw")
    c["simple_bootstrap"] = f"""
SELECT d.doc_id, g.draw FROM (SELECT cnt, unnest(range(300)) AS draw FROM (SELECT DISTINCT cnt FROM featured)) g
JOIN featured d ON d.r = {slot} % g.cnt + 1"""
    c["even_domain_sample"] = f"""
SELECT label AS domain, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY label
  ORDER BY md5('{SEED}:' || label || ':' || doc_id), doc_id) AS r FROM pred) WHERE r <= 33"""
    c["exact_split"] = f"""
SELECT doc_id, CASE WHEN r <= n - h THEN 'train' WHEN r <= n - ceil(0.5::DOUBLE * h) THEN 'dev' ELSE 'test' END AS split
FROM (SELECT *, ceil(0.2::DOUBLE * n) AS h FROM (SELECT doc_id, count(*) OVER () AS n,
  row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r FROM documents))"""
    c["shuffle_rows"] = "SELECT doc_id FROM documents"
    c["grid_strata"] = """
SELECT vec_id, CAST(floor(embedding[1]::DOUBLE / 0.05::DOUBLE) AS BIGINT) || ':'
  || CAST(floor(embedding[2]::DOUBLE / 0.05::DOUBLE) AS BIGINT) AS cell FROM embeddings"""

    c["section_boundaries"] = "SELECT * FROM slices"
    c["section_documents"] = "SELECT doc_id, ord, section, text FROM doc_sections"
    c["section_by_model"] = c["section_documents"]
    c["section_windows"] = c["section_documents"]
    c["section_dump"] = """
SELECT d.doc_id, d.text || chr(10) || chr(10) || coalesce(string_agg(s.section || chr(10) || s.text,
  chr(10) || chr(10) ORDER BY s.ord), '') AS dump
FROM documents d LEFT JOIN doc_sections s ON s.doc_id = d.doc_id GROUP BY d.doc_id, d.text"""
    c["assemble_sections"] = "SELECT conv_id, section, ord, text FROM section_texts"
    c["section_labels"] = r"""
SELECT conv_id, coalesce(string_agg(tok, ' ' ORDER BY r), '') AS tokens,
       coalesce(string_agg(CAST(lab AS VARCHAR), ' ' ORDER BY r), '') AS labels
FROM (SELECT conv_id, tok, CASE WHEN p = 0 THEN k ELSE 0 END AS lab,
             row_number() OVER (PARTITION BY conv_id ORDER BY k, p) AS r
      FROM (SELECT conv_id, k, unnest(l) AS tok, unnest(range(len(l))) AS p
            FROM (SELECT conv_id, k, regexp_extract_all(text, '(\p{L}+|\p{N}+|[^\p{L}\p{N}\s])') AS l
                  FROM section_texts JOIN section_names USING (section))))
GROUP BY conv_id"""
    c["section_offsets"] = """
SELECT conv_id, section AS label, CAST(start AS BIGINT) AS start, CAST(start + length(first_token) AS BIGINT) AS "end"
FROM section_starts"""

    c["iob_tags"] = "SELECT doc_id, string_agg(tag, ' ' ORDER BY i) AS tags FROM tags GROUP BY doc_id"
    c["iob_tag_rows"] = "SELECT doc_id, i, tok, tag FROM tags"
    c["assertion_tags"] = "SELECT doc_id, string_agg(status_tag, ' ' ORDER BY i) AS tags FROM tags GROUP BY doc_id"
    c["relabel_tokens"] = """
SELECT doc_id, string_agg(CASE WHEN contains(tok, 'th') OR contains(tok, 'De') THEN 'O' ELSE tag END, ' ' ORDER BY i) AS tags
FROM tags GROUP BY doc_id"""
    c["tag_vocabulary"] = "SELECT id, tag FROM tag_ids"
    c["label_encode"] = """
SELECT doc_id, string_agg(CAST(v.id AS VARCHAR), ' ' ORDER BY i) AS ids
FROM tags t JOIN tag_ids v ON v.tag = t.tag GROUP BY doc_id"""
    c["label_decode"] = c["iob_tags"]
    c["class_encode"] = """
SELECT doc_id, normality_class, CAST(dense_rank() OVER (ORDER BY normality_class) - 1 AS BIGINT) AS label_id FROM classed"""
    c["align_labels"] = """
SELECT doc_id, '-100 ' || string_agg((length(tok) % 5) || repeat(' -100', CAST(ceil(length(tok) / 4.0) AS INT) - 1),
  ' ' ORDER BY i) || ' -100' AS labels FROM tokens GROUP BY doc_id"""
    c["group_entities"] = """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY island) - 1 AS BIGINT) AS ent_pos,
       any_value(kind) AS entity_group, round(avg(score), 6) AS score, min(start) AS start, max(stop) AS "end"
FROM (SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS island
      FROM (SELECT *, 1.0::DOUBLE / (1 + length(tok)) AS score, starts_with(tag, 'B-')
              OR kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY doc_id ORDER BY i) AS begins
            FROM (SELECT *, regexp_replace(tag, '^[BI]-', '') AS kind FROM tags)))
WHERE kind <> 'O' GROUP BY doc_id, island"""
    c["group_entities_long"] = c["group_entities"]
    c["argmax_label"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS label,
  round(1.0::DOUBLE / list_sum(list_transform(embedding, lambda s: exp(s::DOUBLE - list_max(embedding)::DOUBLE))), 6) AS score
FROM embeddings"""

    c["span_align"] = """
SELECT e.doc_id, e.ent_pos, a.i AS tok_start, b.i + 1 AS tok_end FROM ents e
JOIN tokens a ON a.doc_id = e.doc_id AND a.start = e.start + CASE WHEN e.ent_pos % 3 = 0 THEN 1 ELSE 0 END
JOIN tokens b ON b.doc_id = e.doc_id AND b.stop = e.stop"""
    c["span_overlaps"] = """
SELECT doc_id, neg_pos, previous_end FROM (SELECT *, max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_end FROM neg_spans) WHERE previous_end > start"""
    c["dep_match"] = "SELECT doc_id, tok_i, tok_j FROM links"
    c["entity_relations"] = "SELECT * FROM pairs"
    c["triplet_counts"] = "SELECT doc_id, entity, location, negated, n FROM triplets"
    entity_rows = ", ".join(f"('{e}', {k})" for k, e in enumerate(vocab.TENSOR_ENTITIES))
    location_rows = ", ".join(f"('{e}', {k})" for k, e in enumerate(vocab.TENSOR_LOCATIONS))
    c["triplet_tensor"] = f"""
SELECT g.doc_id, string_agg(CAST(coalesce(t.n, 0) AS VARCHAR), ' ' ORDER BY g.cell) AS tensor
FROM (SELECT doc_id, unnest(range({vocab.TENSOR_CELLS})) AS cell FROM documents) g
LEFT JOIN (SELECT doc_id, x * {2 * len(vocab.TENSOR_LOCATIONS)} + y * 2 + CAST(negated AS INT) AS cell, n FROM triplets
  JOIN (VALUES {entity_rows}) e(entity, x) USING (entity) JOIN (VALUES {location_rows}) l(location, y) USING (location)) t
ON t.doc_id = g.doc_id AND t.cell = g.cell GROUP BY g.doc_id"""

    c["binarise_labels"] = "SELECT doc_id, label, gold, pred FROM grid"
    c["multilabel_confusion"] = "SELECT label, tn, fp, fn, tp FROM confusion"
    c["specificity"] = "SELECT label, round(specificity, 6) AS specificity FROM specificities"
    c["multilabel_report"] = """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM report"""
    c["domain_metrics"] = """
SELECT r.label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support, round(s.specificity, 6) AS specificity,
  CASE WHEN r.label <> 'samples avg' THEN round(recall, 6) END AS sensitivity
FROM report r LEFT JOIN specificities s ON s.label = r.label"""
    c["class_report"] = """
WITH guess AS (SELECT normality_class AS g, CASE WHEN length(text) < 300 THEN 'IS_MISSING'
    WHEN length(text) > 3500 THEN 'IS_NORMAL_FOR_AGE' WHEN length(text) > 1500 THEN 'IS_NORMAL' ELSE 'ABNORMAL' END AS p
  FROM classed),
per_class AS (SELECT label, (SELECT count(*) FROM guess WHERE g = label AND p = label) AS tp,
    (SELECT count(*) FROM guess WHERE g = label) AS support, (SELECT count(*) FROM guess WHERE p = label) AS np
  FROM (SELECT g AS label FROM guess UNION SELECT p FROM guess)),
scores AS (SELECT label, coalesce(tp / nullif(np, 0)::DOUBLE, 0.0) AS precision, coalesce(tp / nullif(support, 0)::DOUBLE, 0.0) AS recall,
    coalesce(2 * tp / nullif(np + support, 0)::DOUBLE, 0.0) AS f1, support, tp FROM per_class),
lines AS (SELECT label, precision, recall, f1, support FROM scores
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM scores
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM scores)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM lines"""
    c["label_errors"] = """
SELECT doc_id, label, CASE WHEN pred THEN 'false_positive' ELSE 'false_negative' END AS kind FROM grid WHERE gold <> pred"""
    c["gold_vs_pred"] = """
SELECT d.doc_id, coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM gold g WHERE g.doc_id = d.doc_id), '') AS label,
  coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM pred p WHERE p.doc_id = d.doc_id), '') AS prediction
FROM documents d"""
    c["span_scores"] = """
SELECT label, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0.0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0.0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0.0), 6) AS f1
FROM (SELECT coalesce(label, 'all') AS label, count(*) FILTER (g AND p) AS tp, count(*) FILTER (NOT g AND p) AS fp,
        count(*) FILTER (g AND NOT p) AS fn
      FROM (SELECT coalesce(a.label, b.label) AS label, a.doc_id IS NOT NULL AS g, b.doc_id IS NOT NULL AS p
            FROM marks a FULL JOIN word_marks b
            ON a.doc_id = b.doc_id AND a.start = b.start AND a.stop = b.stop AND a.label = b.label)
      GROUP BY ROLLUP (label))"""
    c["span_scores_spaced"] = c["span_scores"]

    c["tagger_fit"] = "SELECT prev, tok, tag, n FROM model"
    c["tagger_apply"] = """
SELECT r.turn_id AS doc_id, r.i, r.tok, coalesce(a.tag, b.tag, 'O') AS tag FROM turn_rows r
LEFT JOIN model a ON a.prev = r.prev AND a.tok = r.tok
LEFT JOIN model b ON b.prev IS NULL AND b.tok = r.tok"""

    c["classify_bayes"] = """
SELECT s.doc_id, s.split, s.normality_class, b.label, round(b.share, 6) AS score FROM split_reports s
JOIN (SELECT doc_id, max({'score': score, 'label': label}).label AS label,
        1 / sum(exp((score - top)::DOUBLE / 1000000)) AS share
      FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS top FROM class_scores) GROUP BY doc_id) b ON b.doc_id = s.doc_id"""

    digested = "doc_id, lang, source, sha256(coalesce(text, '')) AS text_sha256"
    c["csv_round_trip"] = c["jsonl_round_trip"] = f"SELECT {digested} FROM documents"
    c["split_round_trip"] = f"SELECT d.*, s.split FROM (SELECT {digested} FROM documents) d JOIN ({c['exact_split']}) s ON s.doc_id = d.doc_id"
    c["metrics_round_trip"] = c["domain_metrics"]
    c["error_report"] = """
SELECT g.doc_id, g.label, CASE WHEN g.pred THEN 'false_positive' ELSE 'false_negative' END AS kind, sha256(d.text) AS report_sha256
FROM grid g JOIN documents d ON d.doc_id = g.doc_id WHERE g.gold <> g.pred"""
    # Not WHERE i < 16: the engine rewrites a filter on a row number and then numbers from 1.
    c["truncate_tokens"] = """
SELECT doc_id, string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i < 16) AS tokens FROM tokens GROUP BY doc_id"""
    c["fill_null"] = """
SELECT d.doc_id, coalesce(CAST(l.toxic AS VARCHAR), 'unknown') AS toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
    c["accepted_texts"] = """
SELECT sha256(d.text) AS text_sha256 FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 1"""
    c["exclusive_ends"] = "SELECT doc_id, entity_group AS label, tok_start, tok_end FROM ents"

    options = ",".join(vocab.EVALUATION_PATHOLOGIES)
    c["choice_tasks"] = f"""
SELECT d.doc_id, md5(d.text) AS text_md5, 'choice' AS _view_id, 'multiple' AS choice_style, 'accept' AS answer,
  coalesce(string_agg(p.label, ',' ORDER BY p.label), '') AS accept, '{options}' AS options
FROM documents d LEFT JOIN pred p ON p.doc_id = d.doc_id
WHERE d.doc_id NOT IN (SELECT doc_id FROM ents WHERE entity_group = '{vocab.EXCLUDED_FROM_EVALUATION}')
GROUP BY d.doc_id, d.text"""
    c["relabel_tasks"] = """
SELECT d.doc_id, coalesce(string_agg(replace(p.label, '_', '-'), ',' ORDER BY replace(p.label, '_', '-')), '') AS accept
FROM documents d LEFT JOIN pred p ON p.doc_id = d.doc_id GROUP BY d.doc_id"""
    c["document_tasks"] = r"""
SELECT s.conv_id, string_agg(s.text, ' ' ORDER BY s.k) AS text,
  string_agg(s.section || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + length(s.first_token) AS BIGINT), ' ' ORDER BY s.k) AS spans,
  CAST(sum(len(regexp_extract_all(s.text, '(\p{L}+|\p{N}+|[^\p{L}\p{N}\s])'))) AS BIGINT) AS n_tokens,
  CAST(length(rtrim(string_agg(s.text, ' ' ORDER BY s.k), chr(10) || chr(9) || chr(13) || ' ')) AS BIGINT) AS last_end
FROM section_starts s GROUP BY s.conv_id"""
    c["mask_spans"] = """
SELECT d.doc_id, coalesce(s.heads, '') || substr(d.text, coalesce(s.last_stop, 0) + 1) AS masked
FROM documents d LEFT JOIN (
  SELECT m.doc_id, max(m.stop) AS last_stop,
         string_agg(CASE WHEN m.start > m.kept_from THEN substr(t.text, m.kept_from + 1, m.start - m.kept_from) ELSE '' END,
                    '' ORDER BY m.start, m.stop) AS heads
  FROM mask_spans m JOIN documents t ON t.doc_id = m.doc_id GROUP BY m.doc_id) s ON s.doc_id = d.doc_id"""
    composed = {name: compose(sql) for name, sql in c.items() if name != "class_report"}
    composed["class_report"] = compose("SELECT * FROM (" + c["class_report"] + ")")
    composed["dep_closure"] = compose(
        """SELECT doc_id, count(*) AS n_pairs, CAST(sum(depth) AS BIGINT) AS sum_depth, CAST(sum(anc) AS BIGINT) AS sum_anc
FROM climb GROUP BY doc_id""",
        recursive="""climb AS (
  SELECT doc_id, i, head AS anc, 1 AS depth FROM deps WHERE head <> i
  UNION ALL SELECT c.doc_id, c.i, d.head, c.depth + 1 FROM climb c
  JOIN deps d ON d.doc_id = c.doc_id AND d.i = c.anc WHERE d.head <> d.i)""",
    )
    composed["tagger_decode"] = compose(
        """SELECT t.turn_id AS doc_id, coalesce(p.tags, '') AS tags FROM turns t LEFT JOIN (
  SELECT turn_id, array_to_string(max({'i': i, 'score': score, 'tag': tag, 'path': path}).path, ' ') AS tags FROM paths GROUP BY turn_id) p ON p.turn_id = t.turn_id""",
        recursive="""paths AS (
  SELECT c.turn_id, c.i, c.tag, CAST(m.score + c.score AS BIGINT) AS score, [c.tag] AS path
  FROM turn_choices c JOIN tag_moves m ON m.prev = '<s>' AND m.tag = c.tag WHERE c.i = 0
  UNION ALL SELECT turn_id, i, tag, CAST(best.score + emit AS BIGINT), list_append(best.path, tag) FROM (
    SELECT c.turn_id, c.i, c.tag, any_value(c.score) AS emit,
           max({'score': p.score + m.score, 'prev': p.tag, 'path': p.path}) AS best
    FROM paths p JOIN turn_choices c ON c.turn_id = p.turn_id AND c.i = p.i + 1
    JOIN tag_moves m ON m.prev = p.tag AND m.tag = c.tag GROUP BY c.turn_id, c.i, c.tag))""",
    )
    composed["dep_numbers"] = compose(
        """SELECT doc_id, sent, i, pre, pre + below - 1 AS last, depth FROM (
  SELECT w.*, row_number() OVER (PARTITION BY w.doc_id, w.sent ORDER BY path) - 1 AS pre, s.below
  FROM ways w JOIN (SELECT doc_id, x AS i, count(*) AS below FROM (SELECT doc_id, unnest(path) AS x FROM ways)
                    GROUP BY ALL) s ON s.doc_id = w.doc_id AND s.i = w.i)""",
        recursive="""ways AS (
  SELECT doc_id, CAST(sent AS BIGINT) AS sent, i, [i] AS path, 0::BIGINT AS depth FROM deps WHERE head = i
  UNION ALL SELECT d.doc_id, CAST(d.sent AS BIGINT), d.i, list_append(w.path, d.i), w.depth + 1
  FROM ways w JOIN deps d ON d.doc_id = w.doc_id AND d.head = w.i AND d.i <> w.i)""",
    )
    composed["dep_ancestors"] = compose(
        r"""SELECT DISTINCT 'far_below' AS pattern, a.doc_id, a.i AS tok_i, b.i AS tok_j FROM deps b
JOIN climb c ON c.doc_id = b.doc_id AND c.i = b.i JOIN deps a ON a.doc_id = c.doc_id AND a.i = c.anc
WHERE regexp_full_match(a.tok, '\p{L}+') AND a.dep = 'nsubj' AND b.dep NOT IN ('amod', 'prep') AND length(b.tok) >= 3
UNION SELECT 'below_a_mark', a.doc_id, a.i, x.i FROM deps a
JOIN climb c ON c.doc_id = a.doc_id AND c.i = a.i JOIN deps b ON b.doc_id = c.doc_id AND b.i = c.anc
JOIN deps x ON x.doc_id = b.doc_id AND x.head = b.i AND x.i <> b.i
WHERE a.w IN ('the', 'de', 'der') AND regexp_full_match(b.tok, '\p{L}+') AND length(b.tok) < 4
  AND NOT regexp_full_match(x.tok, '\p{L}+') AND NOT regexp_full_match(x.tok, '\p{N}+')""",
        recursive="""climb AS (
  SELECT doc_id, i, head AS anc FROM deps WHERE head <> i
  UNION ALL SELECT c.doc_id, c.i, d.head FROM climb c
  JOIN deps d ON d.doc_id = c.doc_id AND d.i = c.anc WHERE d.head <> d.i)""",
    )
    return composed
