"""Registered queries: every operator run over the whole synthetic tables.

Each function takes ``(spark, folder)`` and returns a DataFrame whose columns match the SQL of
the same name in ``reportweave.plans.checks``.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import entities as en
from reportweave.functions import keys, labels
from reportweave.functions import text as tx
from reportweave.functions.arrays import bind
from reportweave.operators import (
    alignment,
    annotation,
    bayes,
    classifier,
    counts,
    evaluation,
    gazetteer,
    grouping,
    inference,
    longform,
    negation,
    relations,
    sampling,
    sections,
    sequence,
    tagger,
    tasks,
    vocabulary,
)
from reportweave.operators.lookup import phrase_table
from reportweave.plans import jobs
from reportweave.plans import standins as st
from reportweave.sources import jsonl, reports
from reportweave.sources.stored import new_path, store
from reportweave.sources.tables import read_table, spread_locally

Query = Callable[[SparkSession, str], DataFrame]
SEED = st.SAMPLE_SEED
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- stand-in inputs


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread_locally(read_table(spark, sf, "documents").select("doc_id", "text"))


def annotated(spark: SparkSession, sf: str) -> DataFrame:
    return annotation.annotate(documents(spark, sf), st.PHRASES, st.RULES)


def asserted(spark: SparkSession, sf: str) -> DataFrame:
    return annotation.assertions(documents(spark, sf), st.PHRASES, st.RULES).drop("text")


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    return longform.mention_table(annotated(spark, sf))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, tokens, ents``."""
    return annotation.annotate(
        documents(spark, sf), st.PHRASES, st.RULES, keep_tokens="tokens"
    ).drop("text")


def tag_examples(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, tokens, ner_tags``."""
    return tagged(spark, sf).select(
        "doc_id", "tokens", en.iob_tags(F.col("ents"), F.size("tokens")).alias("ner_tags")
    )


def trigger_spans(text: Column, width: int) -> Column:
    """Ranges of ``width`` characters from every trigger word of a text."""
    negating = ("no", "not", "nicht", "pas", "sans", "is")
    words = {*negating, "with", "by", "von", "par"}

    def spans(parts: Column, lead: Column, hits: Column) -> Column:
        tokens = F.transform(
            hits, lambda h: F.struct(h["i"].alias("tok_start"), (h["i"] + 1).alias("tok_end"))
        )
        # Only the few triggers are located, not every token.
        places = bind(tokens, lambda t: tx.locate_spans(parts, lead, t))
        return F.zip_with(
            hits,
            places,
            lambda h, place: F.struct(
                F.when(h["w"].isin(list(negating)), "negated").otherwise("asserted").alias("entity_group"),
                place["start"].alias("start"),
                (place["start"] + width).alias("end"),
            ),
        )

    return bind(
        tx.pieces(text),
        lambda parts: bind(
            tx.leading_blanks(text),
            lambda lead: bind(
                en.wanted_words(F.transform(parts, tx.token_of), words),
                lambda hits: spans(parts, lead, hits),
            ),
        ),
    )


def negation_spans(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, neg_pos, entity_group, start, end`` as a long table."""
    spans = trigger_spans(F.col("text"), 40)
    return (
        documents(spark, sf)
        .select("doc_id", F.posexplode(spans).alias("neg_pos", "s"))
        .select(
            "doc_id",
            F.col("neg_pos").cast("bigint").alias("neg_pos"),
            "s.entity_group",
            F.col("s.start").cast("bigint").alias("start"),
            F.col("s.end").cast("bigint").alias("end"),
        )
    )


def flagged_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the four normality flags; unlabelled documents have null flags."""
    n = F.length("text")
    # Lengths are taken before the join: no text goes through it unless the result has it.
    docs = read_table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("Narrative"),
        (n < 300).alias("IS_MISSING"),
        (n > 1500).alias("_long"),
        (n > 3000).alias("_longer"),
    )
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return docs.join(read_table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id",
        "Narrative",
        "IS_MISSING",
        toxic.alias("IS_COMPARATIVE"),
        (good & (F.col("toxic") == 0) & F.col("_long")).alias("IS_NORMAL"),
        (good & F.col("_longer")).alias("IS_NORMAL_FOR_AGE"),
    )


def classed_reports(spark: SparkSession, sf: str) -> DataFrame:
    return flagged_reports(spark, sf).select(
        "doc_id",
        "Narrative",
        labels.normality_class(
            F.col("IS_MISSING"),
            F.col("IS_COMPARATIVE"),
            F.col("IS_NORMAL"),
            F.col("IS_NORMAL_FOR_AGE"),
        ).alias("normality_class"),
    )


def section_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """A conversation as a report: a turn is a piece of the section its role stands for."""
    turn, role = F.col("turn"), F.col("role")
    section = (
        F.when(role == "system", "report_header")
        .when((role == "user") & (turn <= 1), "report_indications")
        .when(role == "user", "report_metareport")
        .when(turn <= 2, "report_body")
        .otherwise("report_tail")
    )
    return read_table(spark, sf, "conversations").select(
        "conv_id", section.alias("section"), turn.alias("ord"), "text"
    )


def sectioned_reports(spark: SparkSession, sf: str) -> DataFrame:
    """``conv_id`` and five nullable section columns."""
    pieces = sections.assemble_sections(section_pieces(spark, sf), "conv_id")
    return sections.section_columns(pieces, "conv_id")


def gold_and_pred(spark: SparkSession, sf: str) -> DataFrame:
    """Gold: labels mentioned twice or more. Predicted: labels asserted at least once."""
    ents = F.col("ents")
    names = F.array_distinct(F.transform(ents, lambda e: e["entity_group"]))
    often = F.filter(
        names, lambda n: F.size(F.filter(ents, lambda e: e["entity_group"] == n)) >= 2
    )
    keep = list(vocab.EVALUATION_PATHOLOGIES)
    scored = asserted(spark, sf).select(
        "doc_id",
        labels.keep_labels(often, keep).alias("gold"),
        en.asserted_labels(ents, keep).alias("pred"),
    )
    return store(scored, "gold-and-pred")


def dependencies(spark: SparkSession, sf: str) -> DataFrame:
    """Heap-shaped parse of every sentence: the head of its token j is its token j div 2."""
    is_end = lambda t: t.isin(list(vocab.SENTENCE_ENDS))
    names = labels.literal_array(["amod", "nsubj", "prep", "pobj"])
    docs = documents(spark, sf).select("doc_id", tx.words(F.col("text")).alias("toks"))

    def starts(toks: Column) -> Column:
        ends = F.filter(F.transform(toks, lambda t, i: F.when(is_end(t), i + 1)), lambda i: i.isNotNull())
        return F.concat(F.array(F.lit(0)), ends)

    def sentence(toks: Column, firsts: Column, first: Column, sent: Column) -> Column:
        stop = F.coalesce(F.get(firsts, sent + 1), F.size(toks))
        return F.transform(
            F.slice(toks, first + 1, stop - first),
            lambda tok, k: F.struct(
                sent.cast("bigint").alias("sent"),
                (first + k).cast("bigint").alias("i"),
                tok.alias("tok"),
                (first + F.shiftright(k, 1)).cast("bigint").alias("head"),
            ),
        )

    rows = bind(
        F.col("toks"),
        lambda toks: bind(
            starts(toks),
            lambda firsts: F.flatten(
                F.transform(firsts, lambda first, sent: sentence(toks, firsts, first, sent))
            ),
        ),
    )
    exploded = docs.select("doc_id", F.explode_outer(rows).alias("r")).select("doc_id", "r.*")
    return exploded.where("i is not null").withColumn(
        "dep", F.get(names, F.length("tok") % 4)
    )


PATTERNS = {
    "subject_object": [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": {"DEP": "nsubj"}},
        {"LEFT_ID": "a", "REL_OP": ">", "RIGHT_ID": "b", "RIGHT_ATTRS": {"DEP": "pobj"}},
    ],
    "modifier_chain": [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": {"DEP": "amod"}},
        {"LEFT_ID": "a", "REL_OP": ".", "RIGHT_ID": "b", "RIGHT_ATTRS": {"DEP": "prep"}},
        {"LEFT_ID": "b", "REL_OP": "<", "RIGHT_ID": "c", "RIGHT_ATTRS": {"DEP": {"IN": ["pobj", "nsubj"]}}},
    ],
    "sibling": [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": {"LOWER": "of"}},
        {"LEFT_ID": "a", "REL_OP": "$++", "RIGHT_ID": "b", "RIGHT_ATTRS": {"DEP": "nsubj"}},
    ],
    "finding_place": [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": {"LOWER": {"IN": list(st.FINDING_WORDS)}}},
        {"LEFT_ID": "a", "REL_OP": ">", "RIGHT_ID": "b", "RIGHT_ATTRS": {"LOWER": {"IN": list(st.PLACE_WORDS)}}},
    ],
    "place_finding": [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": {"LOWER": {"IN": list(st.FINDING_WORDS)}}},
        {"LEFT_ID": "a", "REL_OP": "<", "RIGHT_ID": "b", "RIGHT_ATTRS": {"LOWER": {"IN": list(st.PLACE_WORDS)}}},
    ],
}


def token_relations(spark: SparkSession, sf: str) -> DataFrame:
    return relations.dep_match(dependencies(spark, sf), PATTERNS)


# ---------------------------------------------------------------- tokens, entities, negation


@query
def tokenise(spark, sf):
    return longform.token_table(documents(spark, sf))


@query
def gazetteer_mentions(spark, sf):
    phrases = phrase_table(spark, st.PHRASES)
    return gazetteer.gazetteer_mentions(documents(spark, sf), phrases, max_words=2)


@query
def negex(spark, sf):
    return mentions(spark, sf).select(
        "doc_id", "ent_pos", "entity_group", "word", "start", "end", "negated"
    )


@query
def gazetteer_negex(spark, sf):
    """What ``negex`` finds, from a table of 100,000 phrases and more."""
    others = spark.range(100_000).select(
        F.concat_ws(" ", F.lit("of"), F.concat(F.lit("zz"), F.col("id").cast("string")), F.lit("the")).alias("phrase"),
        F.lit("descriptor_other").alias("label"),
    )
    phrases = phrase_table(spark, st.PHRASES).union(others)
    return vocabulary.vocabulary_entities(documents(spark, sf), phrases, st.RULES, max_words=3).drop(
        "tok_start", "tok_end"
    )


@query
def mention_negation(spark, sf):
    found = mentions(spark, sf).select("doc_id", "ent_pos", "entity_group", "start", "end")
    return negation.mention_negation(found, negation_spans(spark, sf)).select(
        "doc_id", "ent_pos", "entity_group", "negated"
    )


@query
def mention_negation_nested(spark, sf):
    docs = annotation.annotate(documents(spark, sf), st.PHRASES)
    docs = docs.withColumn("spans", trigger_spans(F.col("text"), 40))
    docs = docs.withColumn("ents", en.first_overlap_negated(F.col("ents"), F.col("spans")))
    return longform.mention_table(docs).select("doc_id", "ent_pos", "entity_group", "negated")


@query
def domain_counts(spark, sf):
    long = asserted(spark, sf).select("doc_id", F.inline("ents"))
    return counts.domain_counts(long)


@query
def domain_counts_wide(spark, sf):
    return counts.domain_counts_wide(asserted(spark, sf))


@query
def asserted_labels(spark, sf):
    return asserted(spark, sf).select(
        "doc_id", F.array_join(en.asserted_labels(F.col("ents")), ",").alias("labels")
    )


@query
def exclude_label_docs(spark, sf):
    return (
        asserted(spark, sf)
        .where(~en.has_label(F.col("ents"), vocab.EXCLUDED_FROM_EVALUATION))
        .select("doc_id", F.size("ents").cast("bigint").alias("n_ents"))
    )


# ---------------------------------------------------------------- filters and labels


@query
def blank_placeholder(spark, sf):
    long = sectioned_reports(spark, sf).unpivot(
        "conv_id", list(vocab.SECTIONS), "section", "text"
    )
    return long.select("conv_id", "section", tx.blank_placeholder(F.col("text")).alias("text"))


@query
def length_band(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.where(tx.length_between(F.col("text"), 30, 1000)).select(
        "doc_id", F.length("text").cast("bigint").alias("n")
    )


@query
def keyword_filter(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.where(tx.contains_pattern(F.col("text"), "idiot|nicht|Atth")).select("doc_id")


@query
def normalise_labels(spark, sf):
    hyphened = F.replace(
        F.translate("entity_group", "_", "-"), F.lit("opthalm"), F.lit("ophthalm")
    )
    found = asserted(spark, sf).select(F.inline("ents")).withColumn("raw", hyphened)
    return found.groupBy("raw", labels.normalise_label(F.col("raw")).alias("label")).agg(
        F.count("*").alias("n")
    )


@query
def normality_class(spark, sf):
    return classed_reports(spark, sf).select("doc_id", "normality_class")


@query
def map_labels(spark, sf):
    name = labels.map_label(F.col("normality_class"), vocab.NORMALITY_DISPLAY)
    return classed_reports(spark, sf).select("doc_id", name.alias("name"))


@query
def nonempty_section(spark, sf):
    return (
        sections.assemble_sections(section_pieces(spark, sf), "conv_id")
        .where((F.col("section") == "report_body") & (F.col("text") != ""))
        .select("conv_id", "text")
    )


@query
def first_choice(spark, sf):
    accept = en.asserted_labels(F.col("ents"), vocab.EVALUATION_PATHOLOGIES)
    return asserted(spark, sf).select("doc_id", labels.first_choice(accept).alias("choice"))


@query
def random_map(spark, sf):
    ids = read_table(spark, sf, "documents").select("doc_id")
    return ids.select(
        "doc_id",
        keys.uniform("x", F.col("doc_id")).alias("x"),
        keys.uniform("y", F.col("doc_id")).alias("y"),
    )


# ---------------------------------------------------------------- samples and splits


@query
def stratified_sample(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.stratified_sample(docs, ["lang"], 50, ["doc_id"], SEED, on_short="take_all")


@query
def normality_sample(spark, sf):
    return classifier.normality_training_set(
        flagged_reports(spark, sf), 500, SEED, on_short="take_all"
    ).select("doc_id", "normality_class")


@query
def bootstrap_sample(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.bootstrap_sample(docs, ["lang"], 50, ["doc_id"], SEED)


@query
def simple_sample(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    return sampling.simple_sample(docs, 100, ["doc_id"], SEED)


@query
def simple_bootstrap(spark, sf):
    docs = read_table(spark, sf, "documents")
    has_features = docs.where(tx.contains_pattern(F.col("text"), "idiot|nicht|Atth"))
    return sampling.simple_bootstrap(has_features.select("doc_id"), 300, ["doc_id"], SEED)


@query
def even_domain_sample(spark, sf):
    wide = store(counts.domain_counts_wide(asserted(spark, sf)), "domain-counts")
    columns = {d: f"asserted_{d}" for d in vocab.EVALUATION_PATHOLOGIES}
    quota = 500 // len(columns)
    return sampling.even_domain_sample(wide, columns, quota, ["doc_id"], SEED).select(
        "domain", "doc_id"
    )


@query
def exact_split(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    return sampling.exact_split(docs, ["doc_id"], SEED)


@query
def shuffle_rows(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    return sampling.shuffle_rows(docs, ["doc_id"], SEED)


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    place = lambda k: F.get("embedding", F.lit(k)).cast("double")
    return read_table(spark, sf, "embeddings").select(
        "vec_id", place(0).alias("_X"), place(1).alias("_Y")
    )


@query
def grid_strata(spark, sf):
    return sampling.grid_strata(_positions(spark, sf), "_X", "_Y", 0.05).select("vec_id", "cell")


@query
def cluster_strata(spark, sf):
    return sampling.cluster_strata(_positions(spark, sf), "_X", "_Y", k=100).select(
        "vec_id", "cluster_id"
    )


# ---------------------------------------------------------------- sections


@query
def section_boundaries(spark, sf):
    names = labels.literal_map(st.SECTION_MARKERS)
    marks = F.transform(
        tx.words(F.col("text")),
        lambda w: F.coalesce(F.try_element_at(names, F.lower(w)), F.lit(vocab.OUTSIDE)),
    )
    return (
        documents(spark, sf)
        .withColumn("labels", marks)
        .select("doc_id", F.posexplode(sections.section_slices(F.col("labels"))).alias("ord", "s"))
        .select(
            "doc_id",
            F.col("ord").cast("bigint").alias("ord"),
            "s.section",
            F.col("s.from").cast("bigint").alias("tok_from"),
            F.col("s.to").cast("bigint").alias("tok_to"),
        )
    )


def _sectioned_documents(spark: SparkSession, sf: str) -> DataFrame:
    return sections.section_documents(documents(spark, sf), st.SECTION_MARKERS)


@query
def section_documents(spark, sf):
    return (
        _sectioned_documents(spark, sf)
        .select("doc_id", F.posexplode("sections").alias("ord", "s"))
        .select("doc_id", F.col("ord").cast("bigint").alias("ord"), "s.section", "s.text")
    )


def _section_model():
    """Stand-in for a token model: the marker words, from the Python side."""
    names = st.SECTION_MARKERS
    return lambda texts: [[names.get(t.lower(), vocab.OUTSIDE) for t in tokens] for tokens in texts]


@query
def section_by_model(spark, sf):
    found = inference.section_with_model(documents(spark, sf), _section_model)
    return found.select("doc_id", F.posexplode("sections").alias("ord", "s")).select(
        "doc_id", F.col("ord").cast("bigint").alias("ord"), "s.section", "s.text"
    )


@query
def section_dump(spark, sf):
    return _sectioned_documents(spark, sf).select(
        "doc_id", tx.section_dump(F.col("text"), F.col("sections")).alias("dump")
    )


@query
def assemble_sections(spark, sf):
    return sections.assemble_sections(section_pieces(spark, sf), "conv_id")


@query
def section_labels(spark, sf):
    return sections.section_labels(sectioned_reports(spark, sf)).select(
        "conv_id",
        F.array_join("tokens", " ").alias("tokens"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"),
    )


@query
def section_offsets(spark, sf):
    marked = sections.section_offsets(sectioned_reports(spark, sf))
    return marked.select("conv_id", F.inline("marks")).select(
        "conv_id",
        "label",
        F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"),
    )


# ---------------------------------------------------------------- training sets


@query
def iob_tags(spark, sf):
    return tag_examples(spark, sf).select("doc_id", F.array_join("ner_tags", " ").alias("tags"))


@query
def iob_tag_rows(spark, sf):
    # The words alone: nothing is spent on offsets.
    words = F.posexplode(tx.words(F.col("text"))).alias("i", "tok")
    tokens = documents(spark, sf).select("doc_id", words).withColumn("i", F.col("i").cast("bigint"))
    return alignment.iob_table(tokens, mentions(spark, sf))


@query
def assertion_tags(spark, sf):
    tags = en.iob_tags(F.col("ents"), F.size("tokens"))
    return (
        tagged(spark, sf)
        .withColumn("ents", en.assertion_entities(F.col("ents")))
        .select("doc_id", F.array_join(tags, " ").alias("tags"))
    )


@query
def relabel_tokens(spark, sf):
    cleared = en.clear_tags(F.col("ner_tags"), F.col("tokens"), ["th", "De"])
    return tag_examples(spark, sf).select("doc_id", F.array_join(cleared, " ").alias("tags"))


@query
def tag_vocabulary(spark, sf):
    return tagger.tag_vocabulary(tag_examples(spark, sf)).select(
        F.col("id").cast("bigint").alias("id"), "tag"
    )


def _encoded(spark: SparkSession, sf: str) -> DataFrame:
    examples = store(tag_examples(spark, sf), "tag-examples")
    names = tagger.vocabulary_array(tagger.tag_vocabulary(examples))
    return examples.withColumn("names", names).withColumn(
        "ids", labels.encode(F.col("ner_tags"), F.col("names"))
    )


@query
def label_encode(spark, sf):
    return _encoded(spark, sf).select(
        "doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids")
    )


@query
def label_decode(spark, sf):
    return _encoded(spark, sf).select(
        "doc_id", F.array_join(labels.decode(F.col("ids"), F.col("names")), " ").alias("tags")
    )


@query
def class_encode(spark, sf):
    return classifier.class_encode(classed_reports(spark, sf), "normality_class").select(
        "doc_id", "normality_class", F.col("label_id").cast("bigint").alias("label_id")
    )


def _piece_count(token: Column) -> Column:
    return F.ceil(F.length(token) / 4).cast("int")


@query
def align_labels(spark, sf):
    special = F.array(F.lit(None).cast("int"))
    words = F.flatten(F.transform("tokens", lambda t, i: F.array_repeat(i, _piece_count(t))))
    tags = F.transform("tokens", lambda t: F.length(t) % 5)
    docs = documents(spark, sf).select("doc_id", tx.words(F.col("text")).alias("tokens"))
    return docs.select(
        "doc_id", F.concat(special, words, special).alias("w"), tags.alias("t")
    ).select(
        "doc_id",
        F.array_join(
            labels.first_piece_labels(F.col("w"), F.col("t")).cast("array<string>"), " "
        ).alias("labels"),
    )


def _pieces(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, pieces``: tokens cut to four characters; only a first piece carries the tag."""
    docs = annotation.annotate(documents(spark, sf), st.PHRASES, st.RULES)
    docs = docs.withColumn("toks", tx.tokens(F.col("text")))
    docs = docs.withColumn("tags", en.iob_tags(F.col("ents"), F.size("toks")))

    def piece(t: Column, tag: Column, i: Column, k: Column) -> Column:
        start = t["start"] + 4 * k
        return F.struct(
            i.cast("bigint").alias("word_id"),
            F.when(k == 0, tag).otherwise("O").alias("label"),
            (1.0 / (1 + F.length(t["tok"]) + k)).alias("score"),
            start.cast("bigint").alias("start"),
            F.least(start + 4, t["end"]).cast("bigint").alias("end"),
        )

    def cut(tags: Column) -> Column:
        return F.flatten(
            F.transform(
                "toks",
                lambda t, i: F.transform(
                    F.sequence(F.lit(0), _piece_count(t["tok"]) - 1),
                    lambda k: piece(t, F.get(tags, i), i, k),
                ),
            )
        )

    return docs.select("doc_id", bind(F.col("tags"), lambda tags: cut(tags)).alias("pieces"))


@query
def group_entities(spark, sf):
    grouped = grouping.group_entities_in_rows(_pieces(spark, sf))
    return grouped.select("doc_id", F.posexplode_outer("ents").alias("ent_pos", "e")).where(
        "ent_pos is not null"
    ).select(
        "doc_id",
        F.col("ent_pos").cast("bigint").alias("ent_pos"),
        "e.entity_group",
        F.round("e.score", 6).alias("score"),
        "e.start",
        "e.end",
    )


@query
def group_entities_long(spark, sf):
    pieces = _pieces(spark, sf).select("doc_id", F.inline_outer("pieces")).where(
        "word_id is not null"
    ).withColumn("pos", F.col("start"))
    grouped = grouping.group_entities(grouping.word_labels(pieces), index="word_id")
    return grouped.select(
        "doc_id", "ent_pos", "entity_group", F.round("score", 6).alias("score"), "start", "end"
    )


@query
def argmax_label(spark, sf):
    vectors = read_table(spark, sf, "embeddings")
    return vectors.select(
        "vec_id",
        labels.argmax_index(F.col("embedding")).cast("bigint").alias("label"),
        F.round(labels.argmax_probability(F.col("embedding")), 6).alias("score"),
    )


# ---------------------------------------------------------------- token spans, relations, tensors


@query
def span_align(spark, sf):
    moved = F.col("start") + F.when(F.col("ent_pos") % 3 == 0, 1).otherwise(0)
    spans = mentions(spark, sf).withColumn("start", moved)
    tokens = longform.token_table(documents(spark, sf))
    return alignment.span_align(spans, tokens).select("doc_id", "ent_pos", "tok_start", "tok_end")


@query
def span_overlaps(spark, sf):
    return negation.overlapping_pairs(negation_spans(spark, sf)).select(
        "doc_id", "neg_pos", "previous_end"
    )


@query
def dep_match(spark, sf):
    return token_relations(spark, sf)


@query
def dep_numbers(spark, sf):
    """Pre-order numbers, by which an ancestor is recognised without listing pairs."""
    numbered = relations.tree_numbers(dependencies(spark, sf))
    return numbered.select(
        "doc_id", "sent", "i", *[F.col(c).cast("bigint").alias(c) for c in ("pre", "last", "depth")]
    )


ANCESTRY_PATTERNS = {
    "far_below": [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": {"POS": "WORD", "DEP": "nsubj"}},
        {"LEFT_ID": "a", "REL_OP": ">>", "RIGHT_ID": "b", "RIGHT_ATTRS": {"DEP": {"NOT_IN": ["amod", "prep"]}, "LENGTH": {">=": 3}}},
    ],
    "below_a_mark": [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": {"LOWER": {"REGEX": "^(the|de|der)$"}}},
        {"LEFT_ID": "a", "REL_OP": "<<", "RIGHT_ID": "b", "RIGHT_ATTRS": {"POS": {"IN": ["WORD"]}, "LENGTH": {"<": 4}}},
        {"LEFT_ID": "b", "REL_OP": ">", "RIGHT_ID": "c", "RIGHT_ATTRS": {"POS": {"NOT_IN": ["WORD", "NUM"]}}},
    ],
}


@query
def dep_ancestors(spark, sf):
    kind = F.when(F.col("tok").rlike(r"^\p{L}+$"), "WORD").when(F.col("tok").rlike(r"^\p{N}+$"), "NUM")
    tokens = dependencies(spark, sf).withColumn("pos", kind.otherwise("PUNCT"))
    return relations.match_patterns(tokens, ANCESTRY_PATTERNS)


@query
def dep_closure(spark, sf):
    closure = relations.ancestor_closure(dependencies(spark, sf))
    return closure.groupBy("doc_id").agg(
        F.count("*").alias("n_pairs"),
        F.sum("depth").alias("sum_depth"),
        F.sum("anc").alias("sum_anc"),
    )


@query
def entity_relations(spark, sf):
    return relations.entity_relations(token_relations(spark, sf), mentions(spark, sf))


def _triplets(spark: SparkSession, sf: str) -> DataFrame:
    found = store(mentions(spark, sf), "mentions")
    pairs = relations.entity_relations(token_relations(spark, sf), found)
    return counts.triplet_counts(found, pairs, "skip")


@query
def triplet_counts(spark, sf):
    return _triplets(spark, sf)


@query
def triplet_tensor(spark, sf):
    cells = _triplets(spark, sf)
    docs = read_table(spark, sf, "documents")
    return counts.triplet_tensor(docs, cells).select(
        "doc_id", F.array_join(F.col("tensor").cast("array<string>"), " ").alias("tensor")
    )


# ---------------------------------------------------------------- evaluation


@query
def binarise_labels(spark, sf):
    return evaluation.binarise_labels(gold_and_pred(spark, sf))


@query
def multilabel_confusion(spark, sf):
    return evaluation.multilabel_confusion(gold_and_pred(spark, sf))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def specificity(spark, sf):
    confusion = evaluation.multilabel_confusion(gold_and_pred(spark, sf))
    return _rounded(evaluation.specificity(confusion), "specificity")


@query
def multilabel_report(spark, sf):
    report = evaluation.multilabel_report(gold_and_pred(spark, sf))
    return _rounded(report, "precision", "recall", "f1")


@query
def domain_metrics(spark, sf):
    metrics = evaluation.domain_metrics(gold_and_pred(spark, sf))
    return _rounded(metrics, "precision", "recall", "f1", "specificity", "sensitivity")


@query
def class_report(spark, sf):
    guess = (
        F.when(F.length("Narrative") < 300, "IS_MISSING")
        .when(F.length("Narrative") > 3500, "IS_NORMAL_FOR_AGE")
        .when(F.length("Narrative") > 1500, "IS_NORMAL")
        .otherwise("ABNORMAL")
    )
    pairs = classed_reports(spark, sf).select(
        F.col("normality_class").alias("gold"), guess.alias("pred")
    )
    return _rounded(evaluation.class_report(pairs), "precision", "recall", "f1")


@query
def label_errors(spark, sf):
    return evaluation.label_errors(gold_and_pred(spark, sf))


@query
def gold_vs_pred(spark, sf):
    return evaluation.gold_vs_pred(gold_and_pred(spark, sf)).select(
        "doc_id",
        F.array_join("label", ",").alias("label"),
        F.array_join("prediction", ",").alias("prediction"),
    )


@query
def span_scores(spark, sf):
    label = F.col("entity_group").alias("label")
    gold = mentions(spark, sf).select("doc_id", "start", "end", label)
    words_only = annotation.annotate(documents(spark, sf), st.WORD_PHRASES)
    pred = longform.mention_table(words_only).select("doc_id", "start", "end", label)
    return _rounded(evaluation.span_scores(gold, pred), "precision", "recall", "f1")


@query
def span_scores_spaced(spark, sf):
    """``span_scores`` where the predictions come from texts that are spaced in another way."""
    docs = documents(spark, sf)
    apart = docs.withColumn("text", F.regexp_replace("text", r"([ .,;:])", "  $1 "))
    sides = [
        annotation.annotate(side, phrases).select("doc_id", tx.words(F.col("text")).alias("tokens"), "ents")
        for side, phrases in ((docs, st.PHRASES), (apart, st.WORD_PHRASES))
    ]
    return _rounded(evaluation.tokenised_span_scores(*sides), "precision", "recall", "f1")


# ---------------------------------------------------------------- learned and plugged-in models


@query
def tagger_fit(spark, sf):
    return tagger.tagger_fit(tagger.tag_rows(tag_examples(spark, sf)))


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
        tx.words(F.col("text")).alias("tokens"),
    )


@query
def tagger_apply(spark, sf):
    model = store(tagger.tagger_fit(tagger.tag_rows(tag_examples(spark, sf))), "tagger")
    rows = tagger.tag_rows(_turns(spark, sf), tags=None)
    return tagger.tagger_apply(rows, model).select("doc_id", "i", "tok", "tag")


@query
def tagger_decode(spark, sf):
    """Tags of whole turns by the best valid path, learned from all documents."""
    model = sequence.sequence_fit(store(tag_examples(spark, sf), "tag-examples"))
    model = sequence.SequenceModel(
        store(model.emissions, "tag-emissions"), store(model.transitions, "tag-transitions")
    )
    found = sequence.sequence_decode(_turns(spark, sf), model)
    return found.select("doc_id", F.array_join("tags", " ").alias("tags"))


@query
def classify_bayes(spark, sf):
    """Every report by a model of the train part."""
    reports = store(classed_reports(spark, sf).withColumnRenamed("Narrative", "text"), "classed")
    split = sampling.exact_split(reports, ["doc_id"], SEED, test_size=0.2, dev_share=1.0)
    model = bayes.bayes_fit(split.where("split = 'train'"), label="normality_class")
    model = bayes.BayesModel(store(model.words, "bayes-words"), store(model.classes, "bayes-classes"))
    found = bayes.bayes_classify(reports, model).join(split.select("doc_id", "split", "normality_class"), "doc_id")
    return found.select("doc_id", "split", "normality_class", "label", F.round("score", 6).alias("score"))


@query
def classify_documents(spark, sf):
    reports = classed_reports(spark, sf).withColumnRenamed("Narrative", "text")
    split = sampling.exact_split(reports, ["doc_id"], SEED, test_size=0.2, dev_share=1.0)
    model = classifier.fit_classifier(split.where("split = 'train'"))
    scored = classifier.classify_documents(model, split.where("split = 'test'"))
    return scored.select("doc_id", "normality_class", "label", "score")


def _word_model():
    """Stand-in for a language model: labels single words, from the Python side."""
    import regex

    pattern = regex.compile(r"\p{L}+")

    def predict(texts):
        return [
            [
                {"entity_group": st.WORD_PHRASES[m.group().lower()], "score": 1.0,
                 "word": m.group(), "start": m.start(), "end": m.end()}
                for m in pattern.finditer(text)
                if m.group().lower() in st.WORD_PHRASES
            ]
            for text in texts
        ]

    return predict


def _negation_model():
    import regex

    pattern = regex.compile(r"\p{L}+")
    negating = {"no", "not", "nicht", "pas", "sans", "is"}
    others = {"with", "by", "von", "par"}

    def predict(texts):
        return [
            [
                {"entity_group": "negated" if m.group().lower() in negating else "asserted",
                 "score": 1.0, "word": m.group(), "start": m.start(), "end": m.start() + 40}
                for m in pattern.finditer(text)
                if m.group().lower() in negating | others
            ]
            for text in texts
        ]

    return predict


def model_annotator(df: DataFrame) -> DataFrame:
    return inference.annotate_with_models(df, _word_model, _negation_model)


@query
def annotate(spark, sf):
    found = model_annotator(documents(spark, sf))
    return (
        found.select("doc_id", F.posexplode("ents").alias("ent_pos", "e"))
        .select(
            "doc_id",
            F.col("ent_pos").cast("bigint").alias("ent_pos"),
            "e.entity_group",
            F.col("e.start").cast("bigint").alias("start"),
            F.col("e.end").cast("bigint").alias("end"),
            "e.negated",
        )
    )


MODEL_LIMIT = 512


def _cut_off(model):
    """``model`` as one that reads 512 tokens and silently leaves out what comes after."""
    import regex

    token = regex.compile(r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]")

    def load():
        predict = model()

        def limited(texts):
            ends = [[m.end() for m in islice(token.finditer(t), MODEL_LIMIT)] for t in texts]
            return predict([t[: e[-1] if e else 0] for t, e in zip(texts, ends, strict=True)])

        return limited

    return load


@query
def annotate_windows(spark, sf):
    """What ``annotate`` finds, by models that never see more than 512 tokens of a text."""
    found = inference.annotate_windows(
        documents(spark, sf), _cut_off(_word_model), _cut_off(_negation_model), limit=MODEL_LIMIT
    )
    return longform.mention_table(
        found.withColumn("ents", F.transform("ents", _without_tokens))
    ).select("doc_id", "ent_pos", "entity_group", "start", "end", "negated")


def _without_tokens(e: Column) -> Column:
    none = F.lit(None).cast("int")
    return e.withField("tok_start", none).withField("tok_end", none)


def _limited_section_model():
    names = st.SECTION_MARKERS

    def predict(texts):
        if any(len(tokens) > MODEL_LIMIT for tokens in texts):
            raise ValueError("more tokens than the model takes")
        return [[names.get(t.lower(), vocab.OUTSIDE) for t in tokens] for tokens in texts]

    return predict


@query
def section_windows(spark, sf):
    """What ``section_documents`` finds, by a model that refuses more than 512 tokens."""
    found = inference.section_with_model(
        documents(spark, sf), _limited_section_model, limit=MODEL_LIMIT
    )
    return found.select("doc_id", F.posexplode("sections").alias("ord", "s")).select(
        "doc_id", F.col("ord").cast("bigint").alias("ord"), "s.section", "s.text"
    )


def _class_model():
    """Stand-in for a text classifier: the class whose words are most frequent."""
    import regex

    word = regex.compile(r"\p{L}+")

    def predict(texts):
        found = []
        for text in texts:
            n = [0] * len(st.CLASS_WORDS)
            for m in word.finditer(text):
                for k, words in enumerate(st.CLASS_WORDS.values()):
                    n[k] += m.group().lower() in words
            best = max(range(len(n)), key=lambda k: (n[k], -k))
            found.append({"label": list(st.CLASS_WORDS)[best], "score": (n[best] + 1) / (sum(n) + len(n))})
        return found

    return predict


@query
def classify_by_model(spark, sf):
    found = inference.classify_with_model(
        documents(spark, sf), _class_model, names=vocab.NORMALITY_DISPLAY
    )
    return found.select("doc_id", "label", F.round("score", 6).alias("score"))


@query
def annotate_counts(spark, sf):
    """Domain counts of what a pair of models finds."""
    wide = jobs.extract_domains(documents(spark, sf), model_annotator, text="text")
    return wide.drop("text", "ents")


# ---------------------------------------------------------------- records and masking


@query
def choice_tasks(spark, sf):
    docs = annotation.assertions(documents(spark, sf), st.PHRASES, st.RULES)
    docs = docs.where(~en.has_label(F.col("ents"), vocab.EXCLUDED_FROM_EVALUATION))
    made = tasks.choice_tasks(docs, carry=["doc_id"])
    return made.select(
        "doc_id",
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
        "_view_id",
        F.col("config.choice_style").alias("choice_style"),
        "answer",
        F.array_join("accept", ",").alias("accept"),
        F.array_join(F.transform("options", lambda o: o["id"]), ",").alias("options"),
    )


@query
def relabel_tasks(spark, sf):
    old = asserted(spark, sf).withColumn("accept", F.array().cast("array<string>"))
    return tasks.relabel_tasks(old).select("doc_id", F.array_join("accept", ",").alias("accept"))


@query
def document_tasks(spark, sf):
    marked = sections.section_offsets(sectioned_reports(spark, sf))
    marked = marked.withColumn("tokens", tx.tokens(F.col("text")))
    made = tasks.document_tasks(marked, carry=["conv_id"])
    span = lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))
    last = F.element_at("tokens", -1)
    return made.select(
        "conv_id",
        "text",
        F.array_join(F.transform("ents", span), " ").alias("spans"),
        F.size("tokens").cast("bigint").alias("n_tokens"),
        last["end"].cast("bigint").alias("last_end"),
    )


@query
def mask_spans(spark, sf):
    docs = documents(spark, sf).withColumn("spans", trigger_spans(F.col("text"), 15))
    ranges = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return docs.withColumn("ranges", ranges).select(
        "doc_id", tx.mask_ranges(F.col("text"), F.col("ranges")).alias("masked")
    )


# ---------------------------------------------------------------- sources and sinks, there and back


def _text_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents").select("doc_id", "lang", "source", "text")


def _digested(df: DataFrame) -> DataFrame:
    """Rows with a digest in place of the whole text."""
    text = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", text.alias("text_sha256"))


@query
def csv_round_trip(spark, sf):
    path = new_path(spark, "reports-csv")
    reports.write_reports(_text_rows(spark, sf), path)
    return _digested(reports.read_reports(spark, path, ["doc_id", "lang", "source", "text"]))


@query
def split_round_trip(spark, sf):
    """Train and test parts, written in folders and read one by one."""
    path = new_path(spark, "reports-split")
    rows = sampling.exact_split(_text_rows(spark, sf), ["doc_id"], SEED, test_size=0.2, dev_share=0.5)
    reports.write_reports(rows, path, split="split")
    parts = [
        _digested(reports.read_split(spark, path, part, ["doc_id", "lang", "source", "text"])).withColumn("split", F.lit(part))
        for part in ("train", "dev", "test")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def jsonl_round_trip(spark, sf):
    path = new_path(spark, "reports-jsonl")
    jsonl.write_jsonl(_text_rows(spark, sf), path)
    read = jsonl.read_jsonl(spark, path, "doc_id bigint, lang string, source string, text string")
    return _digested(read.where(F.col("_corrupt_record").isNull()))


@query
def metrics_round_trip(spark, sf):
    path = new_path(spark, "metrics")
    jsonl.write_metrics(evaluation.domain_metrics(gold_and_pred(spark, sf)), path)
    names = ("precision", "recall", "f1", "specificity", "sensitivity")
    schema = ", ".join(["label string", "support bigint", *[f"{n} double" for n in names]])
    return _rounded(jsonl.read_jsonl(spark, path, schema).drop("_corrupt_record"), *names)


@query
def error_report(spark, sf):
    """False positives and negatives with the texts they are in, written by label and kind."""
    path = new_path(spark, "errors")
    texts = documents(spark, sf).withColumnRenamed("text", "report")
    scored = jobs.pair_predictions(gold_and_pred(spark, sf), texts)
    jsonl.write_errors(evaluation.label_errors(scored, carry=["report"]), path)
    read = spark.read.schema("doc_id bigint, report string, label string, kind string").json(path)
    return read.select("doc_id", "label", "kind", F.sha2(F.col("report").cast("binary"), 256).alias("report_sha256"))


@query
def truncate_tokens(spark, sf):
    """The first 16 tokens of every text, as a user may want them; nothing else here cuts texts."""
    words = tx.truncate(tx.words(F.col("text")), 16)
    return documents(spark, sf).select("doc_id", F.array_join(words, " ").alias("tokens"))


@query
def fill_null(spark, sf):
    """Every page of a report and the label it may not have."""
    flags = read_table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("string").alias("toxic"))
    joined = documents(spark, sf).select("doc_id").join(flags, "doc_id", "left")
    return joined.select("doc_id", tx.fill_null(F.col("toxic"), "unknown").alias("toxic"))


@query
def accepted_texts(spark, sf):
    """Texts of the records that a person accepted: here those of good quality."""
    flags = read_table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "accept").otherwise("reject").alias("answer")
    )
    kept = tasks.accepted(documents(spark, sf).join(flags, "doc_id"))
    return tasks.text_only(kept).select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query
def exclusive_ends(spark, sf):
    spans = F.transform(
        "ents",
        lambda e: F.struct(
            e["entity_group"].alias("label"), e["tok_start"].alias("token_start"), (e["tok_end"] - 1).alias("token_end")
        ),
    )
    ended = annotated(spark, sf).select("doc_id", F.explode(tasks.exclusive_ends(spans)).alias("s"))
    return ended.select(
        "doc_id", "s.label", F.col("s.tok_start").cast("bigint").alias("tok_start"), F.col("s.tok_end").cast("bigint").alias("tok_end")
    )
