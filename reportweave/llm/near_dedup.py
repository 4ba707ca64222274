"""Near-duplicate documents by HyperMinHash sketches, with every link confirmed on full sets.

1. One pass turns each text into its shingle set's size, digest and sketch. Documents with equal
   sets form a class; from here on a class is one row.
2. Bands of compressed registers are the buckets in which similar classes meet.
3. Every class is compared with the most popular member of its buckets (its best leader by
   estimate), the pair is confirmed on full sets, and components are formed. This settles large
   groups of near copies with one comparison per member.
4. Only buckets that still hold several components are searched further: classes outside a
   bucket's main component are compared by sketch with the others, in blocks, which says which
   class may belong to which component; then its full set is compared with the full sets of that
   component's members, in blocks. Pairs are never listed: a block gives at most one row per
   class and component.

A link is missed only if all 48 bands differ, or its estimate is 4.5 standard deviations off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.llm import sketch
from reportweave.llm.batches import slices
from reportweave.llm.components import connected_components
from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

SIMILAR_PERCENT = 80
SHINGLE_WORDS = 5
BLOCK_ROWS = 4_096  # sketches in a block
BLOCK_SHINGLES = 100_000  # shingles of full sets in a block


# ---------------------------------------------------------------- sets and sketches


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """``id, n, digest, regs`` of ``docs (id, text)``; no digest and sketch for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                n, digests, regs = [], [], []
                for shingles in sketch.shingle_sets(batch[1].to_pylist(), width):
                    n.append(len(shingles))
                    digests.append(sketch.set_digest(shingles) if len(shingles) else None)
                    regs.append(sketch.registers(shingles).tobytes() if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch[0], pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(regs, pa.binary())],
                    ["id", "n", "digest", "regs"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n bigint, digest binary, regs binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``id, shingles`` of the documents in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1 << 20):
                sets = list(sketch.shingle_sets(batch[1].to_pylist(), width))
                bounds = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))
                yield pa.RecordBatch.from_arrays([batch[0], lists], ["id", "shingles"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.join(wanted, "id", "left_semi").mapInArrow(
        run, f"id {kind}, shingles array<bigint>"
    )


# ---------------------------------------------------------------- groups in a sorted partition


def _grouped(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            changed |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for begin, stop in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[begin] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(begin, stop - begin))
    if held:
        yield pa.Table.from_batches(held)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


# ---------------------------------------------------------------- buckets and leaders


def _buckets(reps: DataFrame) -> DataFrame:
    """``key, id``: buckets of two or more classes that share a band of registers."""
    band = F.explode(F.sequence(F.lit(0), F.lit(sketch.BANDS - 1))).alias("band")
    part = F.substring(
        F.col("regs"), F.col("band") * sketch.BAND_BYTES + 1, F.lit(sketch.BAND_BYTES)
    )
    keyed = reps.select("id", "regs", band).select(F.xxhash64("band", part).alias("key"), "id")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return keyed.join(sizes, "key")


def _leader_pairs(buckets: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: each class with the leader that its sketch says is most similar.

    The leader of a bucket is the member with the most company over all its buckets: near copies
    share more buckets with their common original than with each other.
    """
    popularity = buckets.groupBy("id").agg(F.sum("size").alias("company"))
    ranked = buckets.select("key", "id").join(popularity, "id")
    leaders = ranked.groupBy("key").agg(F.max_by("id", F.struct("company", -F.col("id"))).alias("b"))
    pairs = (
        buckets.select("key", F.col("id").alias("a")).join(leaders, "key")
        .where("a <> b").select("a", "b").distinct()
    )
    side = lambda s: reps.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold
    )

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            one, two = (_matrix(batch.column(c)) for c in ("regs_a", "regs_b"))
            found = sketch.estimated_jaccard((one == two).mean(axis=1), n, m)
            keep = found >= sketch.estimate_cut(n, m, threshold)
            columns = [batch.column("a"), batch.column("b"), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "estimate"]).filter(pa.array(keep))

    estimated = near.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(
        estimate, "a bigint, b bigint, estimate double"
    )
    best = F.max_by("b", F.struct("estimate", -F.col("b")))
    return estimated.groupBy("a").agg(best.alias("b"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Sketches as rows of a matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(-1, sketch.REGISTERS)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough; both joins may split a hot leader."""
    side = lambda s: sets.select(F.col("id").alias(s), F.col("shingles").alias(f"set_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"),
        F.size(F.array_intersect("set_a", "set_b")).alias("common"),
    )
    return both.where(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


# ---------------------------------------------------------------- what leaders did not settle


def _blocks(n: str, per_block: int) -> Column:
    return F.ceil(F.col(n) / per_block).cast("int")


def _suspects(buckets: DataFrame, reps: DataFrame, placed: DataFrame, threshold: float) -> DataFrame:
    """``id, target``: classes that may have a link into another component.

    ``placed`` (``id, comp, comp_size``) holds the classes of components so far; others are alone.
    """
    own = buckets.select("key", "id").join(placed, "id", "left").select(
        "key", "id",
        F.coalesce("comp", "id").alias("comp"),
        F.coalesce("comp_size", F.lit(1).cast("bigint")).alias("comp_size"),
    )
    own = store(own, "bucket-components")
    mixed = own.groupBy("key").agg(
        F.max(F.struct("comp_size", "comp")).alias("main"), F.min("comp").alias("low"),
        F.max("comp").alias("high"), F.count("*").alias("rows"),
    ).where("low <> high").select("key", F.col("main.comp").alias("main"), "rows")
    rows = own.join(mixed, "key").withColumn("stray", F.col("comp") != F.col("main"))
    strays = rows.where("stray").groupBy("key").agg(F.count("*").alias("strays"))
    rows = rows.join(strays, "key").join(reps.select("id", "n", "regs"), "id")
    # Block i of the strays meets block j of all rows of its bucket.
    i_of = F.pmod(F.xxhash64("id"), _blocks("strays", BLOCK_ROWS)).cast("int")
    j_of = F.pmod(F.xxhash64("id"), _blocks("rows", BLOCK_ROWS)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), _blocks(n, BLOCK_ROWS) - 1))
    fields = ["key", "id", "comp", "comp_size", "n", "regs"]
    asking = rows.where("stray").select(*fields, i_of.alias("i"), upto("rows").alias("j"), F.lit(1).alias("asks"))
    asked = rows.select(*fields, upto("strays").alias("i"), j_of.alias("j"), F.lit(0).alias("asks"))
    keys = ["key", "i", "j"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for table in _runs(batches, keys):
            seen |= _targets(table, threshold)
            if len(seen) > 50_000:
                yield _pair_batch(seen, ("id", "target"))
                seen = set()
        yield _pair_batch(seen, ("id", "target"))

    found = _grouped(asking.unionByName(asked), keys, ["asks"]).mapInArrow(
        search, "id bigint, target bigint"
    )
    return found.distinct()


def _pair_batch(pairs: set[tuple[int, int]], names: tuple[str, str]) -> pa.RecordBatch:
    one, two = zip(*sorted(pairs), strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names)


def _targets(table: pa.Table, threshold: float) -> set[tuple[int, int]]:
    """Of a block: the smaller component's class and the larger component it may belong to."""
    ids, comp, size, n, asks = (_numbers(table, c) for c in ("id", "comp", "comp_size", "n", "asks"))
    regs = _matrix(table.column("regs"))
    others = np.flatnonzero(asks == 0)
    out: set[tuple[int, int]] = set()
    for s in np.flatnonzero(asks == 1):
        rows = others[comp[others] != comp[s]]
        rows = rows[np.minimum(n[rows], n[s]) >= np.maximum(n[rows], n[s]) * threshold]
        if not len(rows):
            continue
        agree = (regs[rows] == regs[s]).mean(axis=1)
        close = sketch.estimated_jaccard(agree, n[rows], np.full(len(rows), n[s]))
        for r in rows[close >= sketch.estimate_cut(n[rows], np.full(len(rows), n[s]), threshold)]:
            larger = (size[r], comp[r]) > (size[s], comp[s])
            out.add((int(ids[s]), int(comp[r])) if larger else (int(ids[r]), int(comp[s])))
    return out


def _links_into(
    suspects: DataFrame, members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """``a, b``: for a suspect class and a block of its target component, a link if there is one.

    ``members`` (``comp, id, n, comp_shingles``) are the classes of the target components, and
    ``sizes`` (``id, n``) those of all. A component's members and the classes that ask are both
    cut into blocks of bounded size, and every block of one meets every block of the other.
    """
    by_comp = members.groupBy("comp").agg(F.max("comp_shingles").alias("comp_shingles"))
    asked_by = suspects.withColumnRenamed("target", "comp").join(sizes, "id")
    asked_by_comp = asked_by.groupBy("comp").agg(F.sum("n").alias("stray_shingles"))
    counts = by_comp.join(asked_by_comp, "comp").select(
        "comp",
        _blocks("comp_shingles", BLOCK_SHINGLES).alias("inner_blocks"),
        _blocks("stray_shingles", BLOCK_SHINGLES).alias("outer_blocks"),
    )
    one_of = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inside = members.select("comp", "id").join(counts, "comp").select(
        "comp", one_of("inner_blocks").alias("i"), each_of("outer_blocks").alias("j"), "id", F.lit(0).alias("asks")
    )
    asking = asked_by.join(counts, "comp").select(
        "comp", each_of("inner_blocks").alias("i"), one_of("outer_blocks").alias("j"), "id", F.lit(1).alias("asks")
    )
    rows = inside.unionByName(asking).join(sets, "id")
    keys = ["comp", "i", "j"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            yield _pair_batch(_block_links(table, percent), ("a", "b"))

    return _grouped(rows.select(*keys, "asks", "id", "shingles"), keys, ["asks"]).mapInArrow(
        search, "a bigint, b bigint"
    )


def _block_links(table: pa.Table, percent: int) -> set[tuple[int, int]]:
    """Exact comparison of each asking set with all member sets of a block, by shared shingles."""
    ids, asks = _numbers(table, "id"), _numbers(table, "asks")
    column = table.column("shingles").combine_chunks()
    values, bounds = column.values.to_numpy(), column.offsets.to_numpy()
    inside = np.flatnonzero(asks == 0)
    sizes = np.diff(bounds)[inside]
    owner = np.repeat(np.arange(len(inside)), sizes)
    shared = np.concatenate([values[bounds[r] : bounds[r + 1]] for r in inside] or [values[:0]])
    order = np.argsort(shared, kind="stable")
    shared, owner = shared[order], owner[order]
    out: set[tuple[int, int]] = set()
    for row in np.flatnonzero(asks == 1):
        own = values[bounds[row] : bounds[row + 1]]
        low, high = np.searchsorted(shared, own, "left"), np.searchsorted(shared, own, "right")
        width = high - low
        at = np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())
        common = np.bincount(owner[at], minlength=len(inside))
        hits = np.flatnonzero(100 * common >= percent * (sizes + len(own) - common))
        if len(hits):
            out.add((int(ids[row]), int(ids[inside[hits[0]]])))
    return out


# ---------------------------------------------------------------- the operator


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    percent: int = SIMILAR_PERCENT,
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are lower-cased A-Z runs between ASCII blanks. A document's set holds its distinct
    ``width``-word shingles; with fewer words it is the whole sequence. Documents are linked if
    100 times the intersection is at least ``percent`` times the union. ``component_id`` is the
    smallest id of the linked group, ``kept`` marks that document. Null, empty and blank texts
    have an empty set and are linked with nothing. Rows with a null id are linked with nothing,
    have no component and are kept. Rows that repeat an id count as one document. Ids are whole
    numbers; other columns are ignored. No rows give no rows.
    """
    threshold = percent / 100
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    known = rows.where(F.col("id").isNotNull())
    sketches = store(_sketches(rows, width), "sketches")
    filled = sketches.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    classes = store(filled.groupBy("digest").agg(F.min("id").alias("rep")), "set-classes")
    heads = classes.select(F.col("rep").alias("id"), "digest")
    reps = store(filled.join(heads, ["id", "digest"], "left_semi").select("id", "n", "regs"), "set-sketches")
    buckets = store(_buckets(reps), "band-buckets")

    pairs = store(_leader_pairs(buckets, reps, threshold), "leader-pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = store(_full_sets(known, wanted, width), "shingle-sets")
    links = store(_confirmed(pairs, sets, percent), "leader-links")
    found = connected_components(links)

    sized = found.groupBy("component").agg(F.count("*").alias("comp_size"))
    placed = store(
        found.join(sized, "component").select("id", F.col("component").alias("comp"), "comp_size"),
        "components",
    )
    suspects = store(_suspects(buckets, reps, placed, threshold), "suspects")
    if not suspects.isEmpty():
        targets = suspects.select(F.col("target").alias("comp")).distinct()
        alone = targets.join(placed.select("comp").distinct(), "comp", "left_anti")
        of_comp = placed.select("id", "comp").join(targets, "comp", "left_semi").union(
            alone.select(F.col("comp").alias("id"), "comp")
        )
        totals = of_comp.join(reps.select("id", "n"), "id")
        sums = totals.groupBy("comp").agg(F.sum("n").alias("comp_shingles"))
        members = store(totals.join(sums, "comp"), "target-members")
        wanted = members.select("id").union(suspects.select("id")).distinct()
        sets = store(_full_sets(known, wanted, width), "shingle-sets")
        more = store(_links_into(suspects, members, reps.select("id", "n"), sets, percent), "further-links")
        found = connected_components(links.union(more))

    named = sketches.select("id", "n", "digest").join(classes, "digest", "left")
    final = named.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "id")
    return final.select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text",
    width: int = SHINGLE_WORDS, percent: int = SIMILAR_PERCENT,
) -> DataFrame:
    """``docs`` without near duplicates: of every linked group the smallest id stays.

    A document is its id and its text: rows that share an id, or have none (they come last), are
    compared each, and rows that repeat both stay or go together. Texts without words stay. Two
    hashes of 64 bits stand for a document; ties between equal ids go by the second one. Columns
    may have any name; no rows give no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id).alias("id"), body.alias("text"),
        F.xxhash64(F.col(id), body).alias("key"), F.xxhash64(body, F.col(id)).alias("second"),
    )
    found = near_duplicates(keyed.select("key", "text"), "key", "text", width, percent)
    found = store(found.select(F.col("id").alias("key"), "component_id", "kept").distinct(), "near-components")
    copied = found.where(~F.col("kept")).select("component_id").distinct()
    members = found.join(copied, "component_id", "left_semi").select("key", "component_id")
    named = store(keyed.select("key", "second", "id").distinct().join(members, "key"), "near-members")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "second")
    firsts = named.groupBy("component_id").agg(F.min(order).alias("first"))
    # A key that two documents share by chance takes neither away.
    certain = named.groupBy("key").agg(F.min("second").alias("a"), F.max("second").alias("b")).where("a = b")
    gone = named.join(firsts, "component_id").where(order != F.col("first")).select("key").distinct()
    # Stored, so that Spark knows its size: where it is small the texts need not move.
    gone = store(gone.join(certain.select("key"), "key"), "near-gone")
    return keyed.select("row", "key").join(gone, "key", "left_anti").select("row.*")


def op3_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return near_duplicates(docs, width=2).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )
