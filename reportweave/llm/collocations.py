"""Phrase collocations by stripes: every prefix keys a counter of the words that follow it.

A stripe holds how often each word follows a prefix of k words; a marker stands for the end of a
piece and for words too rare to matter. Tasks build stripes of many texts at a time, a shuffle
brings the stripes of a prefix together, and they are merged entry by entry. From the merged
stripes come the extensions (phrases of k + 1 words), the total of a prefix (its own count) and
the largest extension of a phrase, by which a longer phrase subsumes it.

No phrase is frequent unless its parts are, so stripes of k words are built only at frequent
phrases of k words. Tasks learn which those are from a bitmap of fixed size: a wrong hit costs
an entry that is counted and dropped later, and no phrase is missed. Prefixes that hold a large
share of all words are split by the following word, so no stripe has to fit one task whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportweave.llm.sketch import mix
from reportweave.llm.words import byte_table, cut, groups, joined, value_hashes
from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

LONGEST = 3  # words of a phrase
MIN_COUNT = 10
SUBSUMED_PERCENT = 50
TOP = 2_000
BITMAP_BITS = 1 << 26  # 8 MB, broadcast
HOT_SHARE = 2_000  # a prefix with more than 1 / HOT_SHARE of all words is split; at most so many are
HOT_PARTS = 64
RANK_PARTS = 64
TASK_BYTES = 3 * 1024 * 1024  # of texts or stripes worked on at once

_BREAKS = byte_table(b".,;:!?\n\v\f\r")
_BLANKS = byte_table(b" \t.,;:!?\n\v\f\r")
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_STRIPE = "lang string, prefix string, part int, nexts binary, counts binary"


def phrase_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, from the hashes of the words."""
    found = words[: max(len(words) - length + 1, 0)]
    for k in range(1, length):
        found = mix(found * _FOLD + words[k : len(words) - length + 1 + k])
    return found


class Bitmap:
    """A set of hashes that may hold others too."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % np.uint64(len(self.bits) * 64)
        word = self.bits[(at >> np.uint64(6)).astype(np.int64)]
        return (word >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(phrases: DataFrame, length: int, bits: int) -> Bitmap:
    """The bitmap of ``lang, phrase`` rows; at most ``bits`` bits come to the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch[0].to_pylist(), object)
            out = []
            for lang in np.unique(langs.astype(str)):
                mine = batch[1].filter(pa.array(langs == lang))
                words = pc.list_flatten(pc.split_pattern(mine, " "))
                hashes = value_hashes(words, lang)
                # Runs across two phrases are left out by their places.
                out.append(phrase_hashes(hashes, length)[::length] % np.uint64(bits))
            at = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], ["at"])

    at = phrases.select("lang", "phrase").mapInArrow(places, "at bigint")
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(at % 64 AS INT)))").alias("bits")
    ).toArrow()
    found = np.zeros(max(bits // 64, 1), np.uint64)
    found[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return Bitmap(found)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    langs = pc.dictionary_encode(batch[0])
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, batch[1].filter(pc.equal(langs.indices, code))


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number of each word's form, the forms (A-Z in lower case), and whether the next word goes on."""
    raw, _ = joined(texts)
    raw = np.frombuffer(raw.tobytes().lower(), np.uint8)
    starts, _, forms = cut(raw, _BLANKS)
    piece = np.cumsum(_BREAKS[raw], dtype=np.int32)[starts]
    goes_on = np.append(piece[1:] == piece[:-1], False) if len(starts) else np.zeros(0, bool)
    return forms.indices.to_numpy().astype(np.int64), forms.dictionary.cast(pa.binary()), goes_on


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of all words of ``lang, text`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, TASK_BYTES):
            for lang, texts in _by_language(batch):
                ids, forms, _ = _words(texts)
                n = np.bincount(ids, minlength=len(forms))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(forms), pa.string()), forms.cast(pa.string()), pa.array(n, pa.int64())],
                    ["lang", "phrase", "f"],
                )

    found = docs.mapInArrow(count, "lang string, phrase string, f bigint")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _pack(
    lang: list[str], prefix: pa.Array, part: np.ndarray, bounds: np.ndarray, nexts: pa.Array, counts: np.ndarray
) -> pa.RecordBatch:
    """Stripes from entries in their order; stripe i has the entries ``bounds[i]`` to ``bounds[i + 1]``."""
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), nexts.cast(pa.binary()))
    packed = pa.BinaryArray.from_buffers(
        pa.binary(), len(bounds) - 1,
        [None, pa.py_buffer((bounds * 8).astype(np.int32)), pa.py_buffer(counts.astype("<i8").tobytes())],
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), prefix.cast(pa.string()), pa.array(part, pa.int32()),
         pc.binary_join(lists, b" "), packed],
        ["lang", "prefix", "part", "nexts", "counts"],
    )


def build_stripes(docs: DataFrame, length: int, frequent: Bitmap, hot: set[tuple[str, str]]) -> DataFrame:
    """Stripes of prefixes of ``length`` words over ``lang, text`` rows, one per prefix and task slice.

    With one word in the prefix an empty next word stands for the end of a piece or a rare word,
    so that the stripe's total is the count of the prefix. Stripes of ``hot`` prefixes come in
    parts by the next word.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent.bits, hot))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = shared.value
        known = Bitmap(bits)
        for batch in groups(batches, TASK_BYTES):
            for lang, texts in _by_language(batch):
                ids, forms, goes_on = _words(texts)
                if len(ids) < length:
                    continue
                hashes = value_hashes(forms, lang)
                runs = np.ones(len(ids) - length + 1, bool)
                for k in range(length - 1):
                    runs &= goes_on[k : k + len(runs)]
                if length == 1:
                    runs &= known.holds(hashes)[ids]
                else:
                    runs &= known.holds(phrase_hashes(hashes[ids], length))
                extends = np.zeros(len(runs), bool)
                extends[:-1] = runs[:-1] & runs[1:] & goes_on[length - 1 : length - 2 + len(runs)]
                at = np.flatnonzero(runs if length == 1 else extends)
                if not len(at):
                    continue
                last = np.minimum(at + length, len(ids) - 1)
                nexts = np.where(extends[at], ids[last], len(forms))
                prefixes = ids[at]
                size = len(forms) + 1
                for k in range(1, length):
                    _, first, prefixes = np.unique(
                        prefixes * size + ids[at + k], return_index=True, return_inverse=True
                    )
                if length == 1:
                    _, first, prefixes = np.unique(prefixes, return_index=True, return_inverse=True)
                values = [forms.take(pa.array(ids[at[first] + k])) for k in range(length)]
                prefix = values[0] if length == 1 else pc.binary_join_element_wise(*values, b" ")
                entries, counts = np.unique(prefixes * size + nexts, return_counts=True)
                of, nexts = np.divmod(entries, size)
                is_hot = np.zeros(len(prefix), bool)
                if hot:
                    mine = pa.array([p for name, p in hot if name == lang], pa.string())
                    is_hot = pc.is_in(prefix.cast(pa.string()), mine).to_numpy(zero_copy_only=False)
                parts = np.append(mix(hashes) % np.uint64(HOT_PARTS), np.uint64(0)).astype(np.int64)
                part = np.where(is_hot[of], parts[nexts], 0)
                order = np.lexsort((part, of))
                of, part, nexts, counts = of[order], part[order], nexts[order], counts[order]
                stripe = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
                with_end = pa.concat_arrays([forms, pa.array([b""], pa.binary())])
                yield _pack(
                    [lang] * len(stripe), prefix.take(pa.array(of[stripe])), part[stripe],
                    np.append(stripe, len(of)), with_end.take(pa.array(nexts)), counts,
                )
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(build, _STRIPE)


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One stripe per run of equal keys: entries of the same next word are added."""
    changes = np.zeros(batch.num_rows, bool)
    changes[0] = True
    for c in range(3):
        column = batch[c]
        changes[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    key = np.cumsum(changes) - 1
    entries = pc.binary_length(batch[4]).to_numpy() // 8
    counts = np.frombuffer(b"".join(batch[4].to_pylist()), "<i8")
    raw = np.frombuffer(b" ".join(batch[3].to_pylist()) + b" ", np.uint8)
    ends = np.flatnonzero(raw == 32)
    lengths = np.diff(ends, prepend=-1) - 1
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends),
        [None, pa.py_buffer(np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)), pa.py_buffer(raw[raw != 32])],
    ).dictionary_encode()
    size = len(words.dictionary)
    packed = np.repeat(key, entries) * size + words.indices.to_numpy()
    order = np.argsort(packed, kind="stable")
    begin = np.flatnonzero(np.diff(packed[order], prepend=-1) != 0)
    of, nexts = np.divmod(packed[order][begin], size)
    first = np.flatnonzero(changes)
    bounds = np.searchsorted(of, np.arange(len(first) + 1))
    keys = batch.take(pa.array(first))
    return _pack(
        keys[0].to_pylist(), keys[1], keys[2].to_numpy(), bounds,
        words.dictionary.take(pa.array(nexts)), np.add.reduceat(counts[order], begin),
    )


def merge_stripes(stripes: DataFrame) -> DataFrame:
    """One stripe per ``lang, prefix, part``: what all stripes of it count, entry by entry."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_stripe: pa.RecordBatch | None = None
        for batch in groups(batches, TASK_BYTES):
            together = batch if open_stripe is None else pa.concat_batches([open_stripe, batch])
            done = _merged(together)
            yield done.slice(0, done.num_rows - 1)
            open_stripe = done.slice(done.num_rows - 1)
        if open_stripe is not None:
            yield open_stripe
        pa.default_memory_pool().release_unused()

    keys = ["lang", "prefix", "part"]
    return stripes.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge, _STRIPE)


def extensions(stripes: DataFrame, min_count: int) -> DataFrame:
    """``lang, prefix, next, a`` of all entries counted ``min_count`` times and, with a null next, totals."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, TASK_BYTES):
            entries = pc.binary_length(batch[4]).to_numpy() // 8
            counts = np.frombuffer(b"".join(batch[4].to_pylist()), "<i8")
            words = pc.list_flatten(pc.split_pattern(batch[3].cast(pa.string()), " "))
            of = np.repeat(np.arange(batch.num_rows), entries)
            enough = (counts >= min_count) & (pc.binary_length(words).to_numpy() > 0)
            totals = np.add.reduceat(counts, np.cumsum(entries) - entries)
            row = pa.array(np.concatenate((of[enough], np.arange(batch.num_rows))))
            yield pa.RecordBatch.from_arrays(
                [batch[0].take(row), batch[1].take(row),
                 pa.concat_arrays([words.filter(pa.array(enough)), pa.nulls(batch.num_rows, pa.string())]),
                 pa.array(np.concatenate((counts[enough], totals)))],
                ["lang", "prefix", "next", "a"],
            )

    return stripes.mapInArrow(unpack, "lang string, prefix string, next string, a bigint")


def _hot(phrases: DataFrame, total: int) -> set[tuple[str, str]]:
    """The prefixes that hold more than their share of all words; fewer than ``HOT_SHARE`` for each length."""
    found = phrases.where(F.col("f") * HOT_SHARE > F.lit(total)).select("lang", "phrase").collect()
    return {(r["lang"], r["phrase"]) for r in found}


def _score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a a / (l r)) in exact decimals; counts have at most 15 digits."""
    a, left, right = (f"CAST({c} AS DECIMAL(15,0))" for c in (a, left, right))
    return F.expr(f"CAST(1000000 AS DECIMAL(7,0)) * {a} * {a} div ({left} * {right})")


def mine_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    subsumed_percent: int = SUBSUMED_PERCENT,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of all phrases that stay as candidates.

    A candidate has 2 to ``longest`` words inside one piece of a text and occurs ``min_count``
    times or more in its language (null: ``und``; null texts are empty). ``l`` and ``r`` are the
    counts of the two parts at its weakest cut, ``n`` that of all words. A candidate goes if a
    longer one around it occurs at least ``subsumed_percent`` percent as often. Texts are read
    whole, repeated rows count each, other columns are ignored, no rows give no rows.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counted = store(count_words(rows), "phrase-words")
    sums = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    level = counted.where(F.col("f") >= min_count)
    phrases: list[DataFrame] = []
    for length in range(1, longest):
        known = bitmap_of(level, length, bitmap_bits)
        built = build_stripes(rows, length, known, _hot(level, total))
        found = store(extensions(merge_stripes(built), min_count), f"phrase-extensions-{length}")
        if length == 1:
            totals = found.where(F.col("next").isNull()).groupBy("lang", F.col("prefix").alias("phrase"))
            phrases.append(totals.agg(F.sum("a").alias("f")).where(F.col("f") >= min_count))
        level = found.where(F.col("next").isNotNull()).select(
            "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("a").alias("f")
        )
        phrases.append(level)
    candidates = phrases[1]
    for longer in phrases[2:]:
        candidates = candidates.union(longer)
    candidates = candidates.select("lang", "phrase", F.split("phrase", " ").alias("words"), F.col("f").alias("a"))

    parts = store(phrases[0].union(candidates.select("lang", "phrase", "a")), "phrases")
    cuts = candidates.select(
        "lang", "phrase", "words", "a",
        F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"),
    ).select(
        "*", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"),
    )
    count_of = lambda side, name: parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    scored = cuts.join(count_of("left", "l"), ["lang", "left"]).join(count_of("right", "r"), ["lang", "right"])
    scored = scored.withColumn("score", _score("a", "l", "r"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    inner = candidates.where(F.size("words") > 2).select("lang", "a", "words", F.explode(sizes).alias("size")).select(
        "lang", "a", F.explode(F.transform(
            F.sequence(F.lit(1), F.size("words") - F.col("size") + 1),
            lambda at: F.array_join(F.slice("words", at, F.col("size")), " "),
        )).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < subsumed_percent * F.col("a"))
    )
    return kept.join(sums, "lang").select(
        "lang", "phrase", F.split("phrase", " ").alias("words"), "a", "cut.l", "cut.r", "n", "cut.score"
    )


def strongest(phrases: DataFrame, limit: int = TOP) -> DataFrame:
    """The first ``limit`` phrases of each language with their ``rank``, first within parts of each."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part")
    within = Window.partitionBy("lang", "part").orderBy(*order)
    few = phrases.select("*", part).select("*", F.row_number().over(within).alias("rank")).where(F.col("rank") <= limit)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= limit).drop("part")


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    found = strongest(mine_phrases(read_table(spark, sf, "documents")))
    return found.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, w[i : i + k - 1] AS g
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), range(1, 4) AS r(k)
  WHERE i + k - 1 <= len(w)
), f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.g, c.k, c.a, x.k AS cut, x.f AS l, y.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.g = c.g[1 : x.k]
         JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.g = c.g[x.k + 1 : c.k]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), gone AS (
  SELECT DISTINCT b.lang, b.g FROM c b JOIN c t ON t.lang = b.lang AND b.k = 2 AND t.k = 3
     AND (t.g[1 : 2] = b.g OR t.g[2 : 3] = b.g) AND 100 * t.a >= 50 * b.a
), kept AS (SELECT * FROM best ANTI JOIN gone USING (lang, g)),
ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
