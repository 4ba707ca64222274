"""Language identification by words, backing off to character n-grams.

A known word scores by its log frequency in every language. An unseen word is covered from left
to right by the longest known n-grams, down to single characters, and scores by the mean of
their log frequencies. Spark counts words and n-grams over a bounded sample of labelled rows; the
model's size is bounded too, so it can be broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportweave.llm.batches import slices
from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

FIT_DOCS = 6_000  # labelled documents to learn from
MODEL_WORDS = 50_000  # most frequent words kept
MODEL_GRAMS = 50_000  # most frequent n-grams kept
LONGEST_GRAM = 5
SAMPLE_BUCKETS = 16_384
FINE_BUCKETS = 65_536  # of the one sample bucket that is cut
MEMO_WORDS = 50_000  # unseen words whose scores a worker remembers
UNKNOWN = "und"
MIN_SCORE = 0.5  # less certain documents are rejected where a pipeline filters

_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class LanguageModel:
    """Log frequencies: one row per word or n-gram, one column per language."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters (Unicode category L)."""
    found = _WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # The pattern takes in numerals such as fractions; they end a word.
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def _first_too_many(rows: DataFrame, bucket: Column, limit: int) -> tuple[int, int] | None:
    """The first bucket that ends above ``limit`` rows and the rows before it; none if all fit."""
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("bucket"))
    above = counts.select("bucket", "n", so_far.alias("rows")).where(F.col("rows") > limit)
    found = above.agg(F.min(F.struct("bucket", (F.col("rows") - F.col("n")).alias("before")))).first()[0]
    return None if found is None else (found["bucket"], found["before"])


def bounded_sample(rows: DataFrame, id: str, limit: int) -> DataFrame:
    """``limit`` of ``rows``, or the whole table where it has no more.

    Rows are taken in the order of two hashes over all their columns, so a repeated or missing id
    does not bring them together. Buckets of the first hash are taken whole; the one that does
    not fit is cut by the second, and a bucket of that one that does not fit holds repeats of a
    few rows, which are taken by number. Buckets are counted by pre-aggregated sums, so the
    choice is repeatable and gathers no rows. Columns must be of types that can be grouped.
    """
    columns = [F.col(id).cast("string"), *[F.col(f"`{c}`") for c in rows.columns if c != id]]
    coarse = F.pmod(F.xxhash64(*columns, F.lit("language sample")), F.lit(SAMPLE_BUCKETS))
    fine = F.pmod(F.xxhash64(*columns, F.lit("within a bucket")), F.lit(FINE_BUCKETS))
    first = _first_too_many(rows, coarse, limit)
    if first is None:
        return rows
    left = limit - first[1]
    within = rows.where(coarse == first[0])
    second = _first_too_many(within, fine, left)
    if second is None:  # only if the rows are not the same when read again
        return rows.where(coarse <= first[0])
    sample = rows.where((coarse < first[0]) | ((coarse == first[0]) & (fine < second[0])))
    left -= second[1]
    if not left:
        return sample
    names = [f"`{c}`" for c in rows.columns]
    repeats = within.where(fine == second[0]).groupBy(*names).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(
        Window.partitionBy(F.lit(0)).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    )
    times = F.least("_n", F.lit(left) - F.coalesce(before, F.lit(0)))
    taken = repeats.withColumn("_times", times.cast("int")).where("_times > 0")
    return sample.union(taken.select(*names, F.explode(F.array_repeat(F.lit(0), F.col("_times")))).select(*names))


def count_words(rows: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang, token, n``, counted per slice first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found: dict[str, Counter] = {}
                for label, body in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                    found.setdefault(label, Counter()).update(words_of(body))
                out = [(label, w, n) for label, c in found.items() for w, n in c.items()]
                columns = list(zip(*out, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.string()),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.int64()),
                    ],
                    ["lang", "token", "n"],
                )

    counted = rows.select(F.col(lang), F.col(text)).mapInArrow(
        count, "lang string, token string, n bigint"
    )
    return counted.groupBy("lang", "token").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame, longest: int = LONGEST_GRAM) -> DataFrame:
    """``lang, token, n`` of all n-grams of 1 to ``longest`` characters in the words."""
    starts = F.sequence(F.lit(1), F.length("token"))
    sized = words.where(F.length("token") > 0).select("lang", "token", "n", F.explode(starts).alias("at"))
    widths = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("token") - F.col("at") + 1))
    grams = sized.select("lang", "n", F.explode(
        F.transform(widths, lambda w: F.substring(F.col("token"), F.col("at"), w))
    ).alias("token"))
    return grams.groupBy("lang", "token").agg(F.sum("n").alias("n"))


def _strongest(
    counts: DataFrame, limit: int, languages: list[str]
) -> tuple[list[str], np.ndarray]:
    """The ``limit`` tokens with the largest totals and their counts by language: a bounded model."""
    by_language = [
        F.sum(F.when(F.col("lang") == name, F.col("n")).otherwise(0)).alias(f"n{i}")
        for i, name in enumerate(languages)
    ]
    per_token = counts.groupBy("token").agg(F.sum("n").alias("total"), *by_language)
    best = per_token.orderBy(F.col("total").desc(), "token").limit(limit).drop("total").toArrow()
    columns = [best.column(i + 1).to_numpy() for i in range(len(languages))]
    return best.column(0).to_pylist(), np.column_stack(columns) if columns else np.zeros((0, 0))


def fit(
    labelled: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    fit_docs: int = FIT_DOCS,
    model_words: int = MODEL_WORDS,
    model_grams: int = MODEL_GRAMS,
) -> LanguageModel:
    """Learns from rows with a text and a language; ``fit_docs`` bounds how many are read.

    Without such rows the model knows no language and every prediction is ``und``.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(id, text, lang)
    sample = bounded_sample(rows, id, fit_docs)
    words = store(count_words(sample, lang, text), "language-words")
    grams = store(count_grams(words), "language-grams")
    sums = [
        {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        for counts in (words, grams)
    ]
    languages = sorted(sums[0], key=lambda name: (-sums[0][name], name))
    index: list[dict[str, int]] = []
    tables: list[np.ndarray] = []
    at = 0
    for counts, limit, total in zip((words, grams), (model_words, model_grams), sums, strict=True):
        tokens, found = _strongest(counts, limit, languages)
        index.append({token: at + i for i, token in enumerate(tokens)})
        all_of = np.array([total.get(name, 0) for name in languages], float)
        tables.append(np.log((found + 0.5) / (all_of + 0.5 * len(tokens) + 1)))
        at += len(tokens)
    return LanguageModel(languages, index[0], index[1], np.concatenate(tables))


class Scorer:
    """Scores texts. All words that a worker knows or remembers have a row in one table."""

    def __init__(self, model: LanguageModel, longest: int = LONGEST_GRAM, memo: int = MEMO_WORDS) -> None:
        self.model, self.longest, self.memo = model, longest, memo
        self.rows: dict[str, int] = {}
        self.table = np.zeros((len(model.words) + memo, len(model.languages)))
        self.table[: len(model.words)] = model.table[: len(model.words)]
        self.forget()

    def forget(self) -> None:
        """Back to the words of the model."""
        self.rows = dict(self.model.words)

    def unseen(self, word: str) -> np.ndarray:
        """Mean row of the n-grams that cover the word, longest first; zeros if none is known."""
        grams, rows, at = self.model.grams, [], 0
        while at < len(word):
            for width in range(min(self.longest, len(word) - at), 0, -1):
                row = grams.get(word[at : at + width])
                if row is not None:
                    rows.append(row)
                    break
            else:
                width = 1
            at += width
        if not rows:
            return np.zeros(len(self.model.languages))
        return self.model.table[rows].mean(axis=0)

    def total(self, found: Counter) -> np.ndarray:
        """Sum of the rows of all words, as often as they occur, in parts of ``memo`` words at most."""
        total = np.zeros(len(self.model.languages))
        words = list(found)
        for at in range(0, len(words), self.memo):
            part = words[at : at + self.memo]
            new = [w for w in part if w not in self.rows]
            if len(self.rows) + len(new) > len(self.table):
                self.forget()
                new = [w for w in part if w not in self.rows]
            for w in new:
                row = self.rows[w] = len(self.rows)
                self.table[row] = self.unseen(w)
            rows = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
            total += np.fromiter(map(found.__getitem__, part), float, len(part)) @ self.table[rows]
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """Most likely language and its probability; ties go to the more frequent language."""
        found = Counter(words_of(text)) if text else {}
        if not found or not self.model.languages:
            return UNKNOWN, 0.0
        total = self.total(found)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def predict(
    docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, lang_pred, score`` (0 to 1) for every row of ``docs``; other columns are left out.

    A null text, or one without letters, is ``und`` with score 0, and every text is if the model
    knows no language. Texts are read whole. Repeated rows and null ids come back as they are; no
    rows give no rows. Workers take a few texts at a time and hold one model and a bounded table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole):
                found = [scorer.predict(t) for t in batch[1].to_pylist()]
                names, scores = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [batch[0], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["id", "lang_pred", "score"],
                )
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(predicted, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id)


def keep_identified(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """The documents whose language is known with at least ``min_score``; columns stay as they are.

    Learns from the labelled rows of ``docs`` itself. Without any label only documents without
    letters are rejected, null texts among them. Nothing is added to a row, so columns may have
    any name. Repeated rows and null ids are judged by their text; no rows give no rows.
    """
    model = fit(docs, id, text, lang)
    if not model.languages:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole):
                found = [scorer.predict(t) for t in batch[at].to_pylist()]
                yield batch.filter(pa.array([name != UNKNOWN and score >= min_score for name, score in found], pa.bool_()))
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(accepted, docs.schema)


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is kept from learning; one without an id is not."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    labelled = docs.where(~held_out())
    model = fit(labelled.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )
