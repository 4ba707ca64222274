"""Removal of passages that occur earlier in the corpus, by suffix automata of reference shards.

The corpus is its own reference. A window of 20 words can only repeat where the smallest of its
6-word hashes (its anchor) occurs twice, so Spark counts anchors first, and only texts around
repeated anchors go on. They are dealt by anchor: equal windows have equal anchors, so each shard
of the reference can be matched apart, and its automaton has a bounded size. Within a shard the
segments come in the order of the corpus. Each is streamed through the automaton of all earlier
ones for its matching statistics, and then added. A statistic of 20 or more ends a window that
starts earlier elsewhere; overlapping windows join to the maximal spans that are removed.

An automaton meets its shard's segments in the task that builds it. Sending every automaton to
every document would cost shards times documents, as the reference grows with the corpus;
``remove_known`` does so for a reference of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.llm.automaton import SuffixAutomaton
from reportweave.llm.sketch import mix
from reportweave.llm.words import byte_table, cut, groups, joined, value_hashes
from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

WINDOW = 20  # words
ANCHOR = 6  # words hashed together
HOT_ANCHOR = 2_000  # an anchor that occurs more often is dealt window by window
SHARD_WORDS = 50_000  # an automaton is begun anew after so many words, between anchors
MAX_REFERENCE_WORDS = 2_000_000  # of a reference that is broadcast

SAMPLE_SHARE = 64  # one text of so many is looked at for heavy anchors
HEAVY_SHARE = 1_000  # an anchor that holds more than 1 / HEAVY_SHARE of them is heavy
SALTS = 64  # parts into which the rows of a heavy anchor are dealt

_BLANKS = byte_table(b" \t\n\v\f\r")
_FOLD = np.uint64(0x9E3779B97F4A7C15)


class _Texts:
    """Words of a few texts: where each starts and ends, its hash, and the words of each text."""

    def __init__(self, texts: pa.Array) -> None:
        self.raw, self.text_starts = joined(texts)
        self.starts, self.ends, forms = cut(self.raw, _BLANKS)
        self.ids = forms.indices.to_numpy()
        self.hashes = value_hashes(forms.dictionary)[self.ids]
        self.bounds = np.append(np.searchsorted(self.starts, self.text_starts), len(self.starts))
        self.of = np.repeat(np.arange(len(texts)), np.diff(self.bounds))


def _run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words."""
    number = max(len(hashes) - length + 1, 0)
    found = np.zeros(number, np.uint64)
    for k in range(length):
        found = mix(found * _FOLD + hashes[k : k + number])
    return found


def anchors(texts: _Texts, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of every text, the place of each window's anchor, and all anchor hashes.

    The anchor is the smallest hash of ``anchor`` words within the window, the first of equals:
    the same words always have it at the same place.
    """
    hashes = _run_hashes(texts.hashes, anchor)
    width = window - anchor + 1
    starts = np.arange(max(len(texts.starts) - window + 1, 0))
    least = np.arange(len(hashes))
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = least[: max(len(least) - step, 0)], least[step:]
        least = np.where(hashes[left] <= hashes[right], left, right)
        covered += step
    inside = texts.of[starts] == texts.of[starts + window - 1] if len(starts) else np.zeros(0, bool)
    return starts[inside], least[: len(starts)][inside], hashes


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id, key, text``: the key is the same for rows with the same id and text only, but for chance."""
    key = F.xxhash64(F.col(id), F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(id).cast("bigint").alias("id"), key.alias("key"), F.col(text).alias("text"))


def _anchor_rows(rows: DataFrame, window: int, anchor: int, heavy: tuple[int, ...] = ()) -> DataFrame:
    """``hash, salt, key, place`` of all anchors; the place counts words from the start of the text.

    The salt spreads the rows of a heavy anchor and is 0 for the others.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            texts = _Texts(batch[1])
            _, places, hashes = anchors(texts, window, anchor)
            places = np.unique(places)
            of = texts.of[places]
            keys, found = batch[0].take(pa.array(of)), hashes[places].view(np.int64)
            spread = mix(keys.to_numpy().view(np.uint64) + places.astype(np.uint64)) % np.uint64(SALTS)
            salt = np.where(np.isin(found, heavy), spread.astype(np.int32), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(salt), keys, pa.array((places - texts.bounds[of]).astype(np.int32))],
                ["hash", "salt", "key", "place"],
            )

    return rows.select("key", "text").mapInArrow(find, "hash bigint, salt int, key bigint, place int")


def _heavy_anchors(rows: DataFrame, window: int, anchor: int) -> tuple[int, ...]:
    """At most ``HEAVY_SHARE`` anchors that hold much of a sample of the texts.

    They decide how rows are dealt, and nothing else.
    """
    some = _anchor_rows(rows.where(F.pmod("key", F.lit(SAMPLE_SHARE)) == 0), window, anchor)
    counts = store(some.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1"), "sampled-anchors")
    total = counts.agg(F.sum("times")).first()[0] or 0
    return tuple(r["hash"] for r in counts.where(F.col("times") * HEAVY_SHARE > F.lit(total)).collect())


_SEGMENT = "route bigint, id bigint, key bigint, place int, shape int, words binary"
_LEAD = 1 << 16


def _segments(placed: DataFrame, window: int, anchor: int) -> DataFrame:
    """Segments around repeated anchors: all windows of one anchor, as one run of words.

    ``place`` is the anchor's; ``shape`` holds how many words the first window starts before it
    (times ``_LEAD``) and the number of windows. Of equal
    segments met together only the earliest keeps its words; the others repeat it for certain.
    Windows of hot anchors are segments of their own, dealt by all their words.
    """

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            texts = _Texts(batch[2])
            starts, places, hashes = anchors(texts, window, anchor)
            of = texts.of[places]
            kind = np.zeros(len(texts.starts), np.int8)
            for mark, column in ((1, batch[3]), (2, batch[4])):
                base = np.repeat(texts.bounds[:-1], column.value_lengths().to_numpy())
                kind[base + column.flatten().to_numpy()] = mark
            keep = kind[places] > 0
            starts, places, of = starts[keep], places[keep], of[keep]
            single = kind[places] == 2
            new = np.ones(len(starts), bool)
            new[1:] = (places[1:] != places[:-1]) | single[1:]
            begin = np.flatnonzero(new)
            if not len(begin):
                continue
            number = np.diff(np.append(begin, len(starts)))
            first, place, row = starts[begin], places[begin], of[begin]
            route = hashes[place].copy()
            alone = single[begin]
            if alone.any():
                route[alone] = _run_hashes(texts.hashes, window)[first[alone]]
            ids = batch[0].take(pa.array(row))
            keys = batch[1].take(pa.array(row))
            # Repeats within this slice are known to be repeats of its earliest.
            inner = place - texts.bounds[row]
            no_id, id_values = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            key_values = keys.to_numpy()
            order = np.lexsort((inner, key_values, id_values, no_id))
            words: list[bytes | None] = [None] * len(begin)
            seen: dict[tuple, tuple] = {}
            for i in order.tolist():
                a, b = int(first[i]), int(first[i] + number[i] + window - 1)
                run = b" ".join(texts.raw[texts.starts[a] : texts.ends[b - 1]].tobytes().split())
                mine = (no_id[i], id_values[i], key_values[i], inner[i])
                if seen.setdefault((route[i], run), mine) == mine:
                    words[i] = run
            yield pa.RecordBatch.from_arrays(
                [pa.array(route.view(np.int64)), ids, keys,
                 pa.array(inner.astype(np.int32)),
                 pa.array(((place - first) * _LEAD + number).astype(np.int32)), pa.array(words, pa.binary())],
                ["route", "id", "key", "place", "shape", "words"],
            )

    return placed.select("id", "key", "text", "places", "hot").mapInArrow(cut_out, _SEGMENT)


class _Shard:
    """The automaton of one shard and its vocabulary; segments come in the order of the corpus."""

    def __init__(self, window: int) -> None:
        self.window, self.words = window, 0
        self.automaton, self.vocabulary = SuffixAutomaton(), {}

    def numbers(self, run: bytes) -> list[int]:
        found = self.vocabulary
        return [found.setdefault(w, len(found)) for w in run.split(b" ")]

    def earlier(self, run: list[int]) -> list[bool]:
        """For each window of the run, whether it was added before; then adds the run if it is new."""
        statistics = self.automaton.matching_statistics(run)
        known = [n >= self.window for n in statistics[self.window - 1 :]]
        if not all(known):
            self.add(run)
        return known

    def add(self, run: list[int]) -> None:
        self.automaton.add(run)
        self.words += len(run)


def _matched(segments: DataFrame, window: int, shard_words: int) -> DataFrame:
    """``id, key, first, last`` of spans of words (both included) that occur earlier.

    Segments without words are repeats already. Those of one route are met in corpus order: the
    first is only held, and an automaton is used from the second different one on.
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(window)
        route, held, seen, document = None, None, {}, {}
        for batch in groups(batches):
            ids, keys, first, last = [], [], [], []
            columns = [batch[name].to_pylist() for name in ("route", "id", "key", "place", "shape", "words")]
            for at, id, key, place, shape, run in zip(*columns, strict=True):
                lead, windows = divmod(shape, _LEAD)
                start = place - lead
                if run is None:
                    known = [True] * windows
                else:
                    if at != route:
                        route, held, seen = at, None, {}
                        if shard.words > shard_words:
                            shard = _Shard(window)
                    owner = seen.get(run)
                    if owner == (id, key, place):  # the same row once more
                        known = document[run]
                    elif owner is not None:
                        known = [True] * windows
                    elif not seen:
                        held, known = run, [False] * windows
                        seen[run], document = (id, key, place), {run: known}
                    else:
                        if held is not None:
                            shard.add(shard.numbers(held))
                            held = None
                        known = shard.earlier(shard.numbers(run))
                        seen[run], document[run] = (id, key, place), known
                for k, repeated in enumerate(known):
                    if repeated and (k == 0 or not known[k - 1]):
                        ids.append(id)
                        keys.append(key)
                        first.append(start + k)
                    if repeated and (k + 1 == len(known) or not known[k + 1]):
                        last.append(start + k + window - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                ["id", "key", "first", "last"],
            )

    dealt = segments.repartition(
        F.when(F.col("words").isNull(), F.xxhash64("key", "place")).otherwise(F.col("route"))
    )
    in_order = dealt.sortWithinPartitions("route", F.col("id").asc_nulls_last(), "key", "place")
    return in_order.mapInArrow(match, "id bigint, key bigint, first int, last int")


def _split(text: str | None) -> list[bytes]:
    """The words between ASCII blanks, as UTF-8."""
    return (text or "").encode().split()


def _covered(number: int, spans: list[tuple[int, int]]) -> np.ndarray:
    steps = np.zeros(number + 1, np.int64)
    for first, last in spans:
        steps[first] += 1
        steps[last + 1] -= 1
    return np.cumsum(steps[:-1]) > 0


def _without(placed: DataFrame) -> DataFrame:
    """``id, n_words, n_removed, spans, kept`` from ``id, text`` and the spans to remove."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            number, removed, merged, kept = [], [], [], []
            for id, t, spans in zip(*(batch[k].to_pylist() for k in (0, 2, 3)), strict=True):
                words = _split(t)
                gone = _covered(len(words), [(s["first"], s["last"]) for s in spans or () if s["id"] == id])
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                merged.append([{"first": int(x), "last": int(y) - 1} for x, y in edges.reshape(-1, 2)])
                number.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(compress(words, ~gone) if len(edges) else words))
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(number, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(merged, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["id", "n_words", "n_removed", "spans", "kept"],
            )

    return placed.select("id", "key", "text", "spans").mapInArrow(
        remove, "id bigint, n_words bigint, n_removed bigint, spans array<struct<first:int,last:int>>, kept string"
    )


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    hot_anchor: int = HOT_ANCHOR,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``id, n_words, n_removed, spans, kept`` for every row of ``docs``.

    Words lie between ASCII blanks. A word goes if a window of ``window`` words over it also
    starts earlier: in a row with a smaller id, or further up the same text. ``spans`` are the
    maximal runs of such words (first and last, from 0), ``kept`` the others joined by one blank.
    Ids are integers; rows without one come after all others. Rows that share an id, or have
    none, follow each other in the order of a hash of id and text; rows that repeat both are one
    document. A null or empty text has no words and no rows give no rows. Texts are read whole,
    and other columns are ignored.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor has 1 to window words")
    if window >= _LEAD // 2:
        raise ValueError(f"a window has fewer than {_LEAD // 2} words")
    rows = _rows(docs, id, text)
    heavy = _heavy_anchors(rows, window, anchor)
    found = _anchor_rows(rows, window, anchor, heavy)
    repeated = found.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1")
    salts = F.when(F.col("hash").isin(*heavy), F.sequence(F.lit(0), F.lit(SALTS - 1))) if heavy else F.lit(None)
    repeated = repeated.withColumn("salt", F.explode(F.coalesce(salts, F.array(F.lit(0)))))
    candidates = found.join(repeated, ["hash", "salt"]).select("key", "place", (F.col("times") > hot_anchor).alias("hot"))
    places = candidates.groupBy("key").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("place"))).alias("places"),
        F.collect_set(F.when(F.col("hot"), F.col("place"))).alias("hot"),
    )
    places = store(places, "anchor-places")
    segments = _segments(rows.join(places, "key"), window, anchor)
    spans = _matched(segments, window, shard_words).groupBy("key").agg(
        F.collect_list(F.struct("id", "first", "last")).alias("spans")
    )
    return _without(rows.join(spans, "key", "left")).withColumnRenamed("id", id)


def remove_known(
    docs: DataFrame, reference: DataFrame, id: str = "doc_id", text: str = "text",
    reference_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``docs`` without the passages of ``window`` words or more that a small reference holds.

    Columns as in ``remove_repeats``; windows repeated only within ``docs`` stay. The reference is
    broadcast and every worker builds its automaton once; one of more than
    ``MAX_REFERENCE_WORDS`` words is an error. Null texts hold nothing.
    """
    spark = docs.sparkSession
    words = F.size(F.regexp_extract_all(reference_text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    total = reference.agg(F.sum(words.cast("bigint"))).first()[0] or 0
    if total > MAX_REFERENCE_WORDS:
        raise ValueError(f"a reference of {total} words is too long to broadcast")
    shared = spark.sparkContext.broadcast(
        [t for t in reference.select(reference_text).toArrow().column(0).to_pylist() if t]
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(window)
        for t in shared.value:
            shard.add([shard.vocabulary.setdefault(w, len(shard.vocabulary)) for w in _split(t)])
        for batch in groups(batches):
            spans = []
            for id, t in zip(batch[0].to_pylist(), batch[2].to_pylist(), strict=True):
                run = [shard.vocabulary.get(w, -1) for w in _split(t)]
                ends = [i for i, n in enumerate(shard.automaton.matching_statistics(run)) if n >= window]
                spans.append([{"id": id, "first": e - window + 1, "last": e} for e in ends])
            kind = pa.list_(pa.struct([("id", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], ["id", "key", "text", "spans"])

    found = _rows(docs, id, text).mapInArrow(
        match, "id bigint, key bigint, text string, spans array<struct<id:bigint,first:int,last:int>>"
    )
    return _without(found).withColumnRenamed("id", id)


def _digest(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def op13_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", _digest("kept").alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)
), repeats AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM repeats),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
