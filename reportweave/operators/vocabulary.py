"""Entities with assertion status by a vocabulary table of any size.

The vocabulary never becomes part of a plan or of the driver. Two bitmaps of fixed size, of the
phrases' first words and of their whole surfaces, reach the rows as one scalar; the row walks its
tokens by them, and only runs of tokens that are phrases but for chance leave it, to be looked up
exactly. Texts are not shuffled: what meets per document are candidates and negation events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave.functions import entities as en
from reportweave.functions import text as tx
from reportweave.functions.arrays import bind, running_sum, settled
from reportweave.operators import annotation

BITMAP_BITS = 1 << 22  # 512 kB each


def _bit(value: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(bits)).cast("int")


def _bitmap(values: DataFrame, bits: int) -> Column:
    """``ARRAY<BIGINT>`` with the bits of the column ``value`` set, as a scalar subquery.

    The words without a bit are left out of the aggregation and filled in afterwards.
    """
    at = values.select(_bit(F.col("value"), bits).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, at % 64))").alias("bits")
    )
    every = words.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    filled = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    whole = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(whole, lambda x: x["bits"]).alias("bitmap")).scalar()


def _holds(bitmap: Column, value: Column, bits: int) -> Column:
    at = _bit(value, bits)
    return F.call_function("bit_get", F.get(bitmap, F.shiftright(at, 6)), at.bitwiseAND(63)) == 1


def _candidates(toks: Column, heads: Column, surfaces: Column, max_words: int, bits: int) -> Column:
    """``ARRAY<STRUCT<tok_start,tok_end,surface>>``: runs of tokens that may be phrases."""
    lowered = F.transform(toks, F.lower)

    def runs(words: Column) -> Column:
        starts = F.filter(
            F.transform(words, lambda w, i: F.when(_holds(heads, w, bits), i)), lambda i: i.isNotNull()
        )

        def from_start(i: Column) -> Column:
            longest = F.least(F.lit(max_words), F.size(words) - i)
            every = F.transform(
                F.sequence(F.lit(1), longest),
                lambda n: F.struct(
                    i.alias("tok_start"), (i + n).alias("tok_end"),
                    F.array_join(F.slice(words, i + 1, n), " ").alias("surface"),
                ),
            )
            return F.filter(every, lambda c: _holds(surfaces, c["surface"], bits))

        return F.flatten(F.transform(starts, from_start))

    return bind(lowered, runs)


def vocabulary_entities(
    docs: DataFrame,
    phrases: DataFrame,
    rules: en.NegationRules | None,
    max_words: int,
    text: str = "text",
    doc_id: str = "doc_id",
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """One row per leftmost-longest match of ``phrases(phrase, label)``, with its assertion status.

    ``doc_id, ent_pos, entity_group, word, start, end, negated, tok_start, tok_end``, as
    ``annotation.annotate`` finds them from a short list. ``phrases`` is a table, unique on the
    lower-case ``phrase`` (with a label) of up to ``max_words`` tokens joined by one blank; it may have any
    number of rows. With more phrases than the bitmaps tell apart more runs are looked up, and the
    result stays the same. ``doc_id`` is unique; a document without a match has no row. A blank
    text is replaced by the placeholder first. Without ``rules`` nothing is negated.
    """
    known = phrases.where(F.col("phrase") != "").select("phrase", "label")
    heads = _bitmap(known.select(F.substring_index("phrase", " ", 1).alias("value")), bitmap_bits)
    surfaces = _bitmap(known.select(F.col("phrase").alias("value")), bitmap_bits)

    whole = tx.blank_placeholder(F.col(text))
    work = docs.select(F.col(doc_id), whole.alias("_text"))
    work = work.withColumn("_parts", tx.pieces(F.col("_text"))).withColumn(
        "_toks", F.transform("_parts", tx.token_of)
    )
    if rules is None:
        work = work.withColumn("_events", F.array().cast("array<bigint>"))
    else:
        work = work.withColumn("_hits", en.wanted_words(F.col("_toks"), rules.wanted()))
        work = annotation.find_phrases(work, rules.phrases(), "_triggers")
        work = work.withColumn(
            "_events", en.scope_events(F.col("_hits"), F.col("_triggers"), rules.sentence_ends)
        )
    # What stays of the row from here on are candidates with offsets, and events.
    # Each bitmap is named once, so that it goes into the expression and is no field of any row.
    work = work.withColumns({"_heads": heads, "_surfaces": surfaces}).withColumn(
        "_cands",
        bind(
            F.col("_heads"),
            lambda h: bind(
                F.col("_surfaces"), lambda s: _candidates(F.col("_toks"), h, s, max_words, bitmap_bits)
            ),
        ),
    )

    def place(parts: Column, ends: Column, lead: Column, c: Column) -> Column:
        word = F.rtrim(
            F.array_join(F.slice(parts, c["tok_start"] + 1, c["tok_end"] - c["tok_start"]), ""),
            F.lit(tx.vocab.BLANKS),
        )
        start = lead + F.coalesce(F.get(ends, c["tok_start"] - 1), F.lit(0))
        return F.struct(
            c["tok_start"].alias("tok_start"), c["tok_end"].alias("tok_end"), c["surface"].alias("surface"),
            word.alias("word"), start.alias("start"), (start + F.length(word)).alias("end"),
        )

    placed = bind(
        F.col("_parts"),
        lambda parts: bind(
            running_sum(F.transform(parts, F.length)),
            lambda ends: bind(
                tx.leading_blanks(F.col("_text")),
                lambda lead: F.transform("_cands", lambda c: place(parts, ends, lead, c)),
            ),
        ),
    )
    rows = work.select(doc_id, "_events", settled(placed, "_placed")).where(F.size("_placed") > 0)
    # The events travel with a document's first candidate only.
    found = rows.select(doc_id, "_events", F.posexplode("_placed").alias("_k", "c")).select(
        doc_id, F.when(F.col("_k") == 0, F.col("_events")).alias("_events"), "c.*"
    )
    return _chosen(found, known, rules, doc_id)


def _chosen(found: DataFrame, known: DataFrame, rules: en.NegationRules | None, doc_id: str) -> DataFrame:
    """Exact look-up of the candidates, choice per document, and the status of what is chosen."""
    surfaces = known.withColumnRenamed("phrase", "surface")
    entry = F.struct("tok_start", "tok_end", "label", "word", "start", "end")
    by_doc = found.join(surfaces, "surface", "left").groupBy(doc_id).agg(
        F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), entry))).alias("_all"),
        F.first("_events", ignorenulls=True).alias("_base"),
    )
    # Of the runs with one start only the longest, the last in order, is a candidate.
    by_doc = by_doc.withColumn(
        "_longest",
        F.filter("_all", lambda c, k: ~c["tok_start"].eqNullSafe(F.get("_all", k + 1)["tok_start"])),
    ).withColumn("_take", en.free_flags(F.col("_longest")))
    by_doc = by_doc.withColumn("_marks", en.flagged(F.col("_longest"), F.col("_take"))).where(F.size("_marks") > 0)
    if rules is None:
        by_doc = by_doc.withColumn("_neg", F.transform("_marks", lambda m: F.lit(False)))
    else:
        by_doc = annotation.decide(by_doc.withColumnRenamed("_base", "_events"), rules)
    ents = F.transform("_marks", lambda m, k: F.struct(m.alias("m"), F.get("_neg", k).alias("negated")))
    return by_doc.select(doc_id, F.posexplode(ents).alias("ent_pos", "e")).select(
        doc_id,
        F.col("ent_pos").cast("bigint").alias("ent_pos"),
        F.col("e.m.label").alias("entity_group"),
        F.col("e.m.word").alias("word"),
        F.col("e.m.start").cast("bigint").alias("start"),
        F.col("e.m.end").cast("bigint").alias("end"),
        F.col("e.negated").alias("negated"),
        F.col("e.m.tok_start").cast("bigint").alias("tok_start"),
        F.col("e.m.tok_end").cast("bigint").alias("tok_end"),
    )
