"""A tagger that chooses the tags of a whole text together.

Tokens and neighbouring tags are counted; the best path through the tags of a text is found by a
fold inside its row. Only paths that are valid tag sequences are looked at: an ``I-`` follows a
``B-`` or ``I-`` of its own label. A baseline, as ``operators.tagger`` is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions.arrays import bind, running_states
from reportweave.operators.lookup import bounded_values, weighted_lookup
from reportweave.operators.tagger import START
from reportweave.sources.stored import store

MAX_TAGS = 1_000  # the table of neighbours is held by every task: 8 MB at this bound
SCALE = 1_000  # scores are whole numbers, so sums are exact in any order


@dataclass
class SequenceModel:
    """``emissions``: ``tok, choices, n``, a choice being ``(id, score)`` of a tag seen with the token,
    and of O always. ``transitions``: ``prev_id, id, prev, tag, score`` for all pairs of tags; the
    start has the id after the last tag, and a pair that is not valid has no score.
    """

    emissions: DataFrame
    transitions: DataFrame


def _score(part: Column, whole: Column) -> Column:
    return F.round(F.lit(float(SCALE)) * F.ln(part / whole)).cast("bigint")


def _counts(examples: DataFrame, tokens: str, tags: str) -> DataFrame:
    """``is_tok, tok, is_tag, prev, tag, n``: how often a token has a tag behind another tag.

    A text with more tokens than tags has tokens without a tag, one with more tags has tags alone.
    """
    or_none = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    words = F.transform(or_none(tokens), lambda t: F.struct(t.alias("tok")))
    # The start of a text counts as a tag that is never chosen.
    steps = F.transform(
        or_none(tags),
        lambda t, i: F.struct(F.coalesce(F.get(F.col(tags), i - 1), F.lit(START)).alias("prev"), t.alias("tag")),
    )
    pair = lambda w, s: F.struct(
        w.isNotNull().alias("is_tok"), w["tok"].alias("tok"),
        s.isNotNull().alias("is_tag"), s["prev"].alias("prev"), s["tag"].alias("tag"),
    )
    rows = examples.select(F.inline(F.zip_with(words, steps, pair)))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def sequence_fit(
    examples: DataFrame, tokens: str = "tokens", tags: str = "ner_tags", doc_id: str = "doc_id"
) -> SequenceModel:
    """Counts tokens by tag, and tags by the tag before; more than ``MAX_TAGS`` tags are an error.

    A score is 1,000 times the logarithm of a smoothed share, rounded: of a token among those of
    its tag, (n + 1/2) / (N + 1), and of a tag after another, (n + 1) / (N + number of tags). The
    examples are read once; all counts are sums of one stored table, of a row per token, tag and tag before.
    """
    counted = store(_counts(examples, tokens, tags), "tag-counts")
    pairs = counted.where("is_tok").groupBy("tok", "tag").agg(F.sum("n").alias("n"))
    steps = store(counted.where("is_tag").groupBy("prev", "tag").agg(F.sum("n").alias("n")), "tag-steps")
    seen = steps.select("tag")
    names = F.sort_array(F.array_union(bounded_values(seen, "tag", MAX_TAGS), F.array(F.lit(vocab.OUTSIDE))))
    id_of = lambda c: (F.array_position(names, F.col(c)) - 1).cast("int")

    totals = steps.groupBy("tag").agg(F.sum("n").alias("of_tag"))
    outside = F.lit(vocab.OUTSIDE)
    of_outside = F.coalesce(totals.where(F.col("tag") == outside).agg(F.max("of_tag")).scalar(), F.lit(0))
    scored = pairs.join(totals, "tag").select(
        "tok", "n", "tag",
        F.struct(id_of("tag").alias("id"), _score(F.col("n") + 0.5, F.col("of_tag") + 1).alias("score")).alias("choice"),
    )
    floor = F.struct(
        (F.array_position(names, outside) - 1).cast("int").alias("id"),
        _score(F.lit(0.5), of_outside + 1).alias("score"),
    )
    emissions = scored.groupBy("tok").agg(
        F.collect_list("choice").alias("found"), F.sum("n").alias("n"),
        F.bool_or(F.col("tag") == outside).alias("has_outside"),
    ).select(
        "tok",
        F.when(F.col("has_outside"), F.col("found")).otherwise(F.array_append("found", floor)).alias("choices"),
        "n",
    )

    grid = examples.sparkSession.range(1).select(names.alias("names")).select(
        F.posexplode(F.array_append("names", F.lit(START))).alias("prev_id", "prev"), "names"
    ).select("prev_id", "prev", F.posexplode("names").alias("id", "tag"))
    label = F.substring("tag", 3, 1_000_000)
    valid = ~F.col("tag").startswith("I-") | (
        F.col("prev").rlike("^[BI]-") & (F.substring("prev", 3, 1_000_000) == label)
    )
    before = steps.groupBy("prev").agg(F.sum("n").alias("of_prev"))
    transitions = grid.join(steps, ["prev", "tag"], "left").join(before, "prev", "left").select(
        "prev_id", "id", "prev", "tag",
        F.when(
            valid,
            _score(
                F.coalesce("n", F.lit(0)) + F.lit(1.0),
                F.coalesce("of_prev", F.lit(0)) + F.size(names),
            ),
        ).alias("score"),
    )
    return SequenceModel(emissions, transitions)


def best_path(choices: Column, matrix: Column, n_tags: Column) -> Column:
    """Ids of the best path; ``choices`` has an array of ``(id, score)`` per token.

    ``matrix``: scores by ``previous id * n_tags + id``, null where not allowed. Ties go to the
    larger id, of the previous tag first. Every token must have a choice that may follow all others.
    """
    number = lambda c: c.cast("bigint")

    def forward(state: Column, here: Column) -> Column:
        def reach(c: Column) -> Column:
            ways = F.transform(
                state,
                lambda p, j: F.struct(
                    (p["score"] + F.get(matrix, p["id"] * n_tags + c["id"])).alias("score"),
                    p["id"].alias("id"), j.alias("back"),
                ),
            )
            # A way without a score sorts below all others.
            return F.transform(
                F.array(F.array_max(ways)),
                lambda w: F.struct(c["id"].alias("id"), (w["score"] + c["score"]).alias("score"), w["back"].alias("back")),
            )

        return F.filter(F.flatten(F.transform(here, reach)), lambda s: s["score"].isNotNull())

    start = F.array(F.struct(n_tags.cast("int").alias("id"), number(F.lit(0)).alias("score"), F.lit(0).alias("back")))

    def backward(after: Column, entries: Column) -> Column:
        best = F.array_max(F.transform(entries, lambda e, j: F.struct(e["score"], e["id"], j.alias("at"))))["at"]
        at = F.when(after["back"] < 0, best).otherwise(after["back"])
        return bind(F.get(entries, at), lambda e: F.struct(e["id"].alias("id"), e["back"].alias("back")))

    last = F.struct(F.lit(-1).alias("id"), F.lit(-1).alias("back"))
    states = F.reverse(running_states(choices, start, forward))
    return F.transform(F.reverse(running_states(states, last, backward)), lambda e: e["id"])


def sequence_decode(docs: DataFrame, model: SequenceModel, tokens: str = "tokens", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, tags``: the tags of every token of a text, by the best valid path.

    A token that was never seen is O. Tokens are looked up as rows, frequent ones without a
    shuffle, and a text is put together again by ``doc_id``, which must be unique. A text without
    tokens, or with null for them, has no tags.
    """
    by_place = model.transitions.agg(
        F.array_sort(F.collect_list(F.struct("prev_id", "id", "tag", "score"))).alias("cells")
    ).select(
        F.transform("cells", lambda r: r["score"]).alias("matrix"),
        F.transform(F.filter("cells", lambda r: r["prev_id"] == 0), lambda r: r["tag"]).alias("names"),
    )
    matrix, names = by_place.select("matrix").scalar(), by_place.select("names").scalar()
    outside = F.array(
        F.struct((F.array_position(names, F.lit(vocab.OUTSIDE)) - 1).cast("int").alias("id"), F.lit(0).cast("bigint").alias("score"))
    )
    rows = docs.select(doc_id, F.posexplode_outer(tokens).alias("i", "tok"))
    # Scalar tables become columns first, as lambdas cannot hold a subquery.
    found = weighted_lookup(rows, model.emissions, ["tok"], "n").withColumn("_outside", outside)
    here = F.struct("i", F.coalesce("choices", "_outside").alias("choices"))
    texts = found.groupBy(doc_id).agg(
        F.sort_array(F.collect_list(F.when(F.col("i").isNotNull(), here))).alias("_tokens")
    ).withColumns({"_matrix": matrix, "_names": names})
    path = best_path(F.transform("_tokens", lambda t: t["choices"]), F.col("_matrix"), F.size("_names"))
    return texts.select(doc_id, F.transform(path, lambda k: F.get(F.col("_names"), k)).alias("tags"))
