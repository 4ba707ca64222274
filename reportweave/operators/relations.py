"""Dependency patterns, and relations between entities."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- patterns


Values = Mapping[str, np.ndarray]


def _link(op: str, a: Values, b: Values) -> list[np.ndarray]:
    """Conditions between a bound node A and a new node B; an equality wherever there is one."""
    child = [b["head"] == a["i"], b["i"] != a["i"]]
    parent = [b["i"] == a["head"], b["i"] != a["i"]]
    sibling = [b["head"] == a["head"], b["i"] != a["i"], a["head"] != a["i"], b["head"] != b["i"]]
    left, right = [b["i"] < a["i"]], [b["i"] > a["i"]]
    after, before = [b["i"] == a["i"] + 1], [b["i"] == a["i"] - 1]
    return {
        ">": child,
        "<": parent,
        ".": after,
        ";": before,
        ".*": right,
        ";*": left,
        "$+": after + sibling,
        "$-": before + sibling,
        "$++": sibling + right,
        "$--": sibling + left,
        ">++": child + right,
        ">--": child + left,
        "<++": parent + right,
        "<--": parent + left,
        ">+": child + after,
        ">-": child + before,
        "<+": parent + after,
        "<-": parent + before,
    }[op]


_TOKEN_TEXT = {"ORTH": "tok", "TEXT": "tok"}
_COMPARE = {
    "IN": lambda c, v: c.isin(list(v)),
    "NOT_IN": lambda c, v: ~c.isin(list(v)),
    "REGEX": lambda c, v: c.rlike(v),
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
}


def _fits(attributes: Mapping[str, object]) -> Column:
    """Whether a token fits a node.

    An attribute has a value or comparisons (``IN``, ``NOT_IN``, ``REGEX``, ``==`` and the like).
    ``LOWER`` and ``LENGTH`` are made from the token; others, such as ``POS``, ``DEP`` or
    ``ENT_TYPE``, are columns of that name in lower case. A null attribute fits nothing.
    """
    fits = F.lit(True)
    for name, wanted in attributes.items():
        known = name.upper()
        column = (
            F.lower("tok") if known == "LOWER"
            else F.length("tok") if known == "LENGTH"
            else F.col(_TOKEN_TEXT.get(known, name.lower()))
        )
        tests = wanted if isinstance(wanted, Mapping) else {"==": wanted}
        for op, value in tests.items():
            if op not in _COMPARE:
                raise ValueError(f"unknown comparison {op} of {name}")
            fits = fits & F.coalesce(_COMPARE[op](column, value), F.lit(False))
    return fits


#: Which equality a link gives: what of the bound node meets what of the new node.
_EQUALITY = {
    **dict.fromkeys((">", ">++", ">--", ">+", ">-"), (lambda a: a["i"], "head")),
    **dict.fromkeys(("<", "<++", "<--", "<+", "<-"), (lambda a: a["head"], "i")),
    **dict.fromkeys(("$+", "$-", "$++", "$--"), (lambda a: a["head"], "head")),
    ".": (lambda a: a["i"] + 1, "i"),
    ";": (lambda a: a["i"] - 1, "i"),
}
_ANCESTRY = (">>", "<<")
MAX_NODES = 60  # bits of one number
PAIRS = 100_000  # pairs of nodes that a task holds at once, beyond those of one node
_SORTED = ("doc", "sent", "i", "head", "fits")


def _holds(op: str, a: Values, b: Values) -> np.ndarray:
    """Whether the link ``op`` holds between bound nodes and new ones."""
    if op in _ANCESTRY:
        above, below = (a, b) if op == ">>" else (b, a)
        return (below["pre"] > above["pre"]) & (below["pre"] <= above["last"])
    return reduce(and_, _link(op, a, b))


Step = tuple[Mapping[str, object], int, str]  # attributes, place of the bound node, link


def _plans(patterns: Mapping[str, Sequence[Mapping[str, object]]]) -> list[list[Step]]:
    plans = []
    for title, pattern in patterns.items():
        names: list[str] = []
        steps: list[Step] = []
        for node in pattern:
            left, op = 0, ""
            if names:
                left, op = names.index(str(node["LEFT_ID"])), str(node["REL_OP"])
                if op not in _EQUALITY and op not in (".*", ";*", *_ANCESTRY):
                    raise ValueError(f"unknown link {op} in {title}")
            names.append(str(node["RIGHT_ID"]))
            steps.append((node.get("RIGHT_ATTRS", {}), left, op))
        if not steps:
            raise ValueError(f"pattern {title} has no node")
        plans.append(steps)
    if not plans:
        raise ValueError("no patterns")
    return plans


def _first_rows(batch: pa.RecordBatch) -> np.ndarray:
    """Rows where a sentence begins, in rows sorted by document and sentence; a null key is alone."""
    other = np.ones(batch.num_rows, bool)
    for name in ("doc", "sent"):
        key = batch.column(name)
        differs = pc.fill_null(pc.not_equal(key[1:], key[:-1]), True).to_numpy(zero_copy_only=False)
        other[1:] = differs if name == "doc" else other[1:] | differs
    return np.flatnonzero(other)


def _whole_sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, cut only between sentences."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # With the last row held, to see whether the sentence goes on.
        joint = pa.concat_batches([*(h.slice(h.num_rows - 1) for h in held[-1:]), batch])
        begins = int(_first_rows(joint)[-1]) - min(len(held), 1)
        if begins < 0 or (not held and begins == 0):
            held.append(batch)
            continue
        if held or begins:
            yield pa.concat_batches([*held, batch.slice(0, begins)])
        held = [batch.slice(begins)]
    if held:
        yield pa.concat_batches(held)


class _Tokens:
    """The tokens of whole sentences, and where those that fit a node meet a value."""

    def __init__(self, batch: pa.RecordBatch, asks: bool) -> None:
        starts = _first_rows(batch)
        values = {c: batch.column(c) for c in ("i", "head")}
        if asks and any(v.null_count for v in values.values()):
            raise ValueError("a token has no number or no head")
        # A null meets nothing.
        self.known = {c: v.is_valid().to_numpy(zero_copy_only=False) for c, v in values.items()}
        self.of = {c: pc.fill_null(v, 0).to_numpy().astype(np.int64) for c, v in values.items()}
        self.fits = batch.column("fits").to_numpy()
        self.sentence = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
        self.numbers = np.unique(np.concatenate(list(self.of.values())))
        if asks:
            parent = _parents(self.of["i"], self.of["head"], starts, lambda s: f"sentence {batch.column('doc')[int(starts[s])]}")
            self.of["pre"], self.of["last"], _ = _walk(parent, starts)

    def at(self, tokens: np.ndarray) -> Values:
        return {c: v[tokens] for c, v in self.of.items()}

    def fitting(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.fits >> n & 1)

    def _place(self, tokens: np.ndarray, value: np.ndarray, side: str = "left") -> np.ndarray:
        """A number that sorts by sentence, then by the place of the value among all ``i`` and ``head``."""
        return self.sentence[tokens] * (len(self.numbers) + 1) + np.searchsorted(self.numbers, value, side)

    def met(self, bound: np.ndarray, new: np.ndarray, op: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``new`` in an order in which those that may be linked to a bound node are a range, and the ranges."""
        linked = self.known["i"][bound]
        new = new[self.known["i"][new]]
        if op in _EQUALITY:
            wanted, column = _EQUALITY[op]
            new = new[self.known[column][new]]
            keys = self._place(new, self.of[column][new])
            value = wanted(self.at(bound))
            low, high = self._place(bound, value), self._place(bound, value, "right")
            if op[0] in "<$":
                linked = linked & self.known["head"][bound]
        elif op in (".*", ";*"):
            keys = self._place(new, self.of["i"][new])
            own, wide = self._place(bound, self.of["i"][bound]), len(self.numbers) + 1
            first = self.sentence[bound] * wide
            low, high = (own + 1, first + wide) if op == ".*" else (first, own)
        else:
            wide = len(self.sentence) + 1
            keys = self.sentence[new] * wide + self.of["pre"][new]
            first, pre = self.sentence[bound] * wide, self.of["pre"][bound]
            low, high = (first + pre + 1, first + self.of["last"][bound] + 1) if op == ">>" else (first, first + pre)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        low, high = np.searchsorted(keys, low), np.searchsorted(keys, high)
        return new[order], low, np.where(linked, high - low, 0)


def _parts(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of nodes with ``PAIRS`` pairs together, or one node that has more."""
    ends, start = np.cumsum(counts), 0
    while start < len(counts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        yield start, stop
        start = stop


def _grown(
    tokens: _Tokens, steps: Sequence[Step], first_bit: int, k: int, nodes: Sequence[np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First and last tokens of the matches that begin with ``nodes``, one array per bound node."""
    if k == len(steps):
        yield nodes[0], nodes[-1]
        return
    _, left, op = steps[k]
    new, low, counts = tokens.met(nodes[left], tokens.fitting(first_bit + k), op)
    some = np.flatnonzero(counts)
    for start, stop in _parts(counts[some]):
        at = some[start:stop]
        number = counts[at]
        ends = np.cumsum(number)
        found = new[np.repeat(low[at] - ends + number, number) + np.arange(ends[-1])]
        before = [np.repeat(n[at], number) for n in nodes]
        held = _holds(op, tokens.at(before[left]), tokens.at(found))
        yield from _grown(tokens, steps, first_bit, k + 1, [*(n[held] for n in before), found[held]])


def _matches(
    tokens: DataFrame,
    patterns: Mapping[str, Sequence[Mapping[str, object]]],
    doc_id: str = "doc_id",
) -> DataFrame:
    """``pattern, doc_id, tok_i, tok_j``: first and last node of every match of all patterns.

    ``tokens``: ``doc_id, sent, i, head, tok, dep, pos`` and other attributes. A pattern is a list
    of nodes with ``RIGHT_ID`` and ``RIGHT_ATTRS``; all but the first name a bound node
    (``LEFT_ID``) and a link (``REL_OP``). Which nodes of all patterns a token fits is one number,
    worked out where the token is read. Only that number, its place and its head are shuffled,
    once, by document and sentence. Sorted by them, the sentences of a batch are matched together
    with numpy: a node meets the next ones by a search for the equality of the link, or for the
    range of numbers that a link without one asks for. Pairs of nodes are held in parts. Ancestry is a
    comparison of two intervals (``_walk``), which are computed only where a pattern asks for it.
    """
    plans = _plans(patterns)
    asks = any(op in _ANCESTRY for steps in plans for _, _, op in steps)
    nodes = [attributes for steps in plans for attributes, _, _ in steps]
    if len(nodes) > MAX_NODES:
        raise ValueError(f"{len(nodes)} nodes in one pass; match at most {MAX_NODES} together")
    # One bit per node that a token fits.
    fits = F.lit(0).cast("bigint")
    for n, attributes in enumerate(nodes):
        fits = fits + F.when(_fits(attributes), F.lit(1 << n).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    i, head = F.col("i").cast("bigint"), F.col("head").cast("bigint")
    rows = tokens.select(F.col(doc_id).alias("doc"), "sent", i.alias("i"), head.alias("head"), fits.alias("fits"))
    if not asks:
        rows = rows.where("fits <> 0")
    keyless = F.col("doc").isNull() | F.col("sent").isNull()
    keys = [F.col("doc"), F.col("sent")]
    if all(len(steps) > 1 for steps in plans):
        rows = rows.where(~keyless)  # without both keys a token is linked with nothing
    else:
        keys.append(F.when(keyless, F.xxhash64("i", "head", "fits")))
        rows = rows.withColumn("head", F.when(keyless, F.col("i")).otherwise(F.col("head")))
    sentences = rows.repartition(*keys).sortWithinPartitions(*_SORTED)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_sentences(batches):
            known = _Tokens(batch, asks)
            bit = 0
            for p, steps in enumerate(plans):
                for first, last in _grown(known, steps, bit, 1, [known.fitting(bit)]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), p, np.int32)),
                         *(batch.column(c).take(pa.array(x)) for c, x in (("doc", first), ("i", first), ("i", last)))],
                        ["p", "doc", "tok_i", "tok_j"],
                    )
                bit += len(steps)

    kinds = dict(tokens.dtypes)
    found = sentences.mapInArrow(match, f"p int, doc {kinds[doc_id]}, tok_i bigint, tok_j bigint")
    titles = F.element_at(F.array(*[F.lit(title) for title in patterns]), F.col("p") + 1)
    return found.select(
        titles.alias("pattern"), F.col("doc").alias(doc_id),
        *(F.col(c).cast(kinds["i"]).alias(c) for c in ("tok_i", "tok_j")),
    )


def match_patterns(
    tokens: DataFrame,
    patterns: Mapping[str, Sequence[Mapping[str, object]]],
    doc_id: str = "doc_id",
) -> DataFrame:
    """Distinct ``pattern, doc_id, tok_i, tok_j``: first and last node of the matches, as ``_matches``."""
    return _matches(tokens, patterns, doc_id).distinct()


def match_pattern(
    tokens: DataFrame, pattern: Sequence[Mapping[str, object]], doc_id: str = "doc_id"
) -> DataFrame:
    """Distinct ``doc_id, tok_i, tok_j`` of the matches of one pattern, as ``match_patterns``."""
    return match_patterns(tokens, {"pattern": pattern}, doc_id).drop("pattern")


def dep_match(
    tokens: DataFrame,
    patterns: Mapping[str, Sequence[Mapping[str, object]]],
    doc_id: str = "doc_id",
) -> DataFrame:
    """Distinct first and last tokens of the matches of all patterns."""
    return _matches(tokens, patterns, doc_id).drop("pattern").distinct()


# ---------------------------------------------------------------- trees


def _sentences(deps: DataFrame, doc_id: str) -> DataFrame:
    """One row per sentence: its tokens in order, with all their columns but the sentence's own."""
    own = ["i", "head", *[c for c in deps.columns if c not in (doc_id, "sent", "i", "head")]]
    return deps.groupBy(doc_id, "sent").agg(
        F.sort_array(F.collect_list(F.struct("i", F.struct(*own).alias("t")))).alias("rows")
    )


def _parents(ids: np.ndarray, heads: np.ndarray, starts: np.ndarray, names: Callable[[int], str]) -> np.ndarray:
    """Places of the heads among all tokens; ``ids`` are sorted in each sentence, which begin at ``starts``."""
    sizes = np.diff(np.append(starts, len(ids)))
    first = np.repeat(ids[starts], sizes)
    widths = ids[starts + sizes - 1] - ids[starts] + 1
    base = np.repeat(np.cumsum(widths) - widths, sizes)
    keys, wanted = base + ids - first, base + heads - first
    inside = (heads >= first) & (heads - first < np.repeat(widths, sizes))
    at = np.minimum(np.searchsorted(keys, wanted), len(ids) - 1)
    bad = ~inside | (keys[at] != wanted)
    if bad.any():
        sentence = np.searchsorted(starts, int(np.flatnonzero(bad)[0]), "right") - 1
        raise ValueError(f"head without a token in {names(sentence)}")
    return at


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable[[int], str], np.ndarray]:
    """Ids, places of heads and starts of the sentences of ``doc, sent, ids, heads`` rows."""
    ids, heads = (batch[c].flatten().to_numpy().astype(np.int64) for c in (2, 3))
    sizes = batch[2].value_lengths().to_numpy()
    starts = np.cumsum(sizes) - sizes
    names = lambda row: f"sentence {batch[0][row].as_py()} {batch[1][row].as_py()}"
    return ids, _parents(ids, heads, starts, names), starts, names, np.repeat(np.arange(len(sizes)), sizes)


def _walk(parent: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pre``, ``last`` and ``depth`` of the tokens of many sentences, level by level for all together."""
    token = np.arange(len(parent))
    roots = token[parent == token]
    # Children beside each other under their parent, in the order of the sentence.
    children = token[parent != token]
    children = children[np.argsort(parent[children], kind="stable")]
    number = np.bincount(parent[children], minlength=len(parent))
    first = np.cumsum(number) - number
    levels = [roots]
    while len(levels[-1]):
        above = levels[-1]
        width = number[above]
        ends = np.cumsum(width)
        levels.append(children[np.repeat(first[above] - ends + width, width) + np.arange(ends[-1])])
    depth = np.full(len(parent), -1)
    for d, level in enumerate(levels):
        depth[level] = d
    if (depth < 0).any():
        sentence = np.searchsorted(starts, int(np.flatnonzero(depth < 0)[0]), "right") - 1
        size = int(np.append(starts, len(parent))[sentence + 1] - starts[sentence])
        raise ValueError(f"heads in a cycle in a sentence of {size} tokens")
    below = np.ones(len(parent), np.int64)
    for level in reversed(levels[1:]):
        np.add.at(below, parent[level], below[level])

    def before(tokens: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Tokens in the trees of earlier siblings; ``firsts`` are the places of the eldest."""
        sums = np.cumsum(below[tokens]) - below[tokens]
        return sums - sums[firsts]

    pre = np.zeros(len(parent), np.int64)
    of = np.searchsorted(starts, roots, "right")
    pre[roots] = before(roots, np.searchsorted(of, of))
    pre[children] = before(children, first[parent[children]])
    for level in levels[1:]:
        pre[level] += pre[parent[level]] + 1
    return pre, pre + below - 1, depth


def tree_numbers(deps: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The token rows with ``pre``, ``last`` and ``depth``: their places in a walk over the tree.

    A token comes before its children and these in the order of the sentence; ``last`` is the
    largest number below a token. So x is an ancestor of y where ``pre(x) < pre(y) <= last(x)``,
    and no pair of them is ever listed. Linear in the sentence, however deep: the sentences of an
    Arrow batch are numbered together, level by level. Roots are their own heads; tokens may be
    numbered with gaps, and trees of one sentence follow each other. A head that is no
    token of the sentence, or a cycle, is an error.
    """
    sentences = _sentences(deps, doc_id)

    @F.arrow_udf("pre array<int>, last array<int>, depth array<int>")
    def numbers(ids: pa.Array, heads: pa.Array) -> pa.Array:
        sizes = ids.value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        i, head = (a.flatten().to_numpy().astype(np.int64) for a in (ids, heads))
        found = (np.zeros(0, int),) * 3
        if len(i):
            found = _walk(_parents(i, head, starts, lambda _: "a sentence"), starts)
        offsets = pa.array(np.append(starts, len(i)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in found]
        return pa.StructArray.from_arrays(lists, ["pre", "last", "depth"])

    arrays = numbers(F.col("rows.t.i"), F.col("rows.t.head"))
    numbered = sentences.select(doc_id, "sent", F.col("rows.t").alias("t"), arrays.alias("n"))
    exploded = numbered.select(
        doc_id, "sent", F.explode(F.arrays_zip("t", "n.pre", "n.last", "n.depth")).alias("r")
    )
    return exploded.select(doc_id, "sent", "r.t.*", "r.pre", "r.last", "r.depth")


def ancestor_closure(deps: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, sent, i, anc, depth``: every token with every ancestor in its sentence.

    The tokens of many sentences climb together, one level per round, until the last has passed
    its root; each level leaves as rows, so that nothing but the heads is held. Roots are tokens
    that are their own head. Tokens may be numbered with gaps. A head that is no token of the
    sentence, or a cycle, is an error. Where only the test is wanted, use ``tree_numbers``.
    """
    rows = _sentences(deps.select(doc_id, "sent", "i", "head"), doc_id).select(
        doc_id, "sent", F.col("rows.t.i").alias("ids"), F.col("rows.t.head").alias("heads")
    )
    kind = dict(deps.select(doc_id, "sent").dtypes)

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, parent, starts, names, of = _flat(batch)
            longest = int(np.diff(np.append(starts, len(ids))).max())
            token, above = np.arange(len(ids)), parent
            depth = 1
            while True:
                going = above != (token if depth == 1 else previous)
                token, above = token[going], above[going]
                if not len(token):
                    break
                if depth > longest:
                    raise ValueError(f"heads in a cycle in {names(int(of[token[0]]))}")
                row = pa.array(of[token])
                yield pa.RecordBatch.from_arrays(
                    [batch[0].take(row), batch[1].take(row), pa.array(ids[token]), pa.array(ids[above]),
                     pa.array(np.full(len(token), depth, np.int64))],
                    ["doc", "sent", "i", "anc", "depth"],
                )
                previous, above = above, parent[above]
                depth += 1

    found = rows.mapInArrow(climb, f"doc {kind[doc_id]}, sent {kind['sent']}, i bigint, anc bigint, depth bigint")
    return found.withColumnRenamed("doc", doc_id)


# ---------------------------------------------------------------- entity pairs


def entity_relations(
    relations: DataFrame, mentions: DataFrame, doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, ent_pos, entity_group, target_pos, target_group``.

    A relation between tokens links the mentions that hold them; several links to one target
    count once. ``mentions`` needs ``ent_pos, entity_group, tok_start, tok_end``.
    """
    covered = mentions.select(
        doc_id,
        "ent_pos",
        "entity_group",
        F.explode(F.sequence(F.col("tok_start"), F.col("tok_end") - 1)).alias("_tok"),
    )
    ends = relations.select(
        doc_id,
        "tok_i",
        "tok_j",
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("_source"), F.col("tok_i").alias("_tok")),
                F.struct(F.lit(False).alias("_source"), F.col("tok_j").alias("_tok")),
            )
        ),
    )
    # Both ends of a relation in one join: entities are disjoint, so a token has one at most.
    mention = F.struct("ent_pos", "entity_group")
    pairs = (
        ends.join(covered, [doc_id, "_tok"])
        .groupBy(doc_id, "tok_i", "tok_j")
        .agg(
            F.max(F.when(F.col("_source"), mention)).alias("s"),
            F.max(F.when(~F.col("_source"), mention)).alias("t"),
        )
        .where("s is not null and t is not null")
    )
    return pairs.select(
        doc_id,
        F.col("s.ent_pos").alias("ent_pos"),
        F.col("s.entity_group").alias("entity_group"),
        F.col("t.ent_pos").alias("target_pos"),
        F.col("t.entity_group").alias("target_group"),
    ).distinct()
