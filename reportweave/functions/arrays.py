"""Array helpers for work that stays inside one row.

A row holds one report, so folding over its arrays needs neither a shuffle nor Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``.

    Projections may be merged by the optimizer; a column used inside a lambda would then be
    computed again for every element. A lambda variable is never inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(value: Column, name: str) -> Column:
    """``value`` as a generated column, for use in ``select``.

    A filter on a plain column is pushed below the projection that computes it, with the whole
    expression copied into the filter. A filter on a generated column stays above.
    """
    return F.explode_outer(F.array(value)).alias(name)


def running_flags(
    values: Column,
    start: Column,
    step: Callable[[Column, Column], Column],
    flag: Callable[[Column, Column], Column],
) -> Column:
    """One boolean per element of a left fold: ``flag(state before, element)``.

    ``step(state, element)`` gives the next state. The flags of 32 elements are kept as the
    bits of one number, so the array that grows during the fold has one entry per block.
    """
    state_and_bits = F.struct(start.alias("state"), F.lit(0).cast("bigint").alias("bits"))

    def fold_block(state: Column, block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(state.alias("state"), F.lit(0).cast("bigint").alias("bits")),
            lambda acc, v: F.struct(
                step(acc["state"], v).alias("state"),
                (acc["bits"] * 2 + flag(acc["state"], v).cast("bigint")).alias("bits"),
            ),
        )

    def fold(arr: Column) -> Column:
        last_block = F.shiftright(F.greatest(F.size(arr) - 1, F.lit(0)), 5)
        per_block = F.aggregate(
            F.sequence(F.lit(0), last_block),
            F.array(state_and_bits),
            lambda acc, b: F.array_append(
                acc,
                fold_block(F.element_at(acc, -1)["state"], F.slice(arr, b * 32 + 1, F.lit(32))),
            ),
        )

        def bit_of(blocks: Column, i: Column) -> Column:
            block = F.shiftright(i, 5)
            in_block = F.least(F.size(arr) - block * 32, F.lit(32))
            # entry 0 is the start state
            place = in_block - 1 - i.bitwiseAND(31)
            return F.call_function("bit_get", F.get(blocks, block + 1)["bits"], place) == 1

        return bind(
            per_block, lambda blocks: F.transform(arr, lambda _, i: bit_of(blocks, i))
        )

    return bind(values, fold)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` over all prefixes of an array; ``join`` is associative and takes null for nothing.

    Doubling scan: round k joins the element 2^k places to the left, so log2(n) rounds of
    plain element access do, with no array grown element by element.
    """

    def round_(done: Column, k: Column) -> Column:
        left = lambda i: F.get(done, i - F.call_function("shiftleft", F.lit(1), k))
        return F.transform(done, lambda v, i: join(v, left(i)))

    def scan(arr: Column) -> Column:
        rounds = F.ceil(F.log2(F.size(arr))).cast("int")
        return F.when(F.size(arr) < 2, arr).otherwise(
            F.aggregate(F.sequence(F.lit(0), rounds - 1), arr, round_)
        )

    return bind(values, scan)


SUM_BLOCK = 16


def running_sum(values: Column) -> Column:
    """Sums of all prefixes of an integer array; nulls do not count.

    Blocks are summed one by one, then moved by the sum of all blocks before. Only the sums of whole
    blocks are scanned by doubling, so nearly all of the work is linear in the array.
    """
    or_zero = lambda v: F.coalesce(v, F.lit(0))

    def within(block: Column) -> Column:
        add = lambda sums, v: F.array_append(sums, or_zero(v) + or_zero(F.get(sums, F.size(sums) - 1)))
        return F.aggregate(block, F.slice(block, F.lit(1), F.lit(0)), add)

    def moved(blocks: Column, totals: Column) -> Column:
        move = lambda block, done: F.transform(block, lambda v: v + done)
        return F.flatten(
            F.transform(
                blocks, lambda block, b: bind(or_zero(F.get(totals, b - 1)), lambda done: move(block, done))
            )
        )

    def scan(arr: Column) -> Column:
        last_block = F.floor((F.size(arr) - 1) / SUM_BLOCK).cast("int")
        block = lambda b: bind(F.slice(arr, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK)), within)
        summed = bind(
            F.transform(F.sequence(F.lit(0), last_block), block),
            lambda blocks: bind(
                _running(
                    F.transform(blocks, lambda sums: F.element_at(sums, -1)),
                    lambda v, left: v + or_zero(left),
                ),
                lambda totals: moved(blocks, totals),
            ),
        )
        return F.when(F.size(arr) < 1, arr).otherwise(summed)

    return bind(values, scan)


def running_max(values: Column) -> Column:
    """Greatest elements of all prefixes; nulls do not count."""
    return _running(values, F.greatest)


def first_not(values: Column, below: Callable[[Column], Column]) -> Column:
    """Index of the first element for which ``below`` is not true, the size if there is none.

    ``below`` holds for a prefix of the array, so log2(n) looks are enough.
    """

    def look(found: Column, k: Column) -> Column:
        further = found + F.call_function("shiftleft", F.lit(1), k)
        inside = further <= F.size(values)
        return F.when(inside & below(F.get(values, further - 1)), further).otherwise(found)

    rounds = F.floor(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    return F.aggregate(F.sequence(rounds, F.lit(0)), F.lit(0), look)


FOLD_BLOCK = 128


def running_states(
    values: Column, start: Column, step: Callable[[Column, Column], Column]
) -> Column:
    """The states of a left fold after every element: ``step(state before, element)``.

    States are gathered in blocks, so no array that grows by one is longer than a block or the
    number of blocks. An empty array gives an empty one.
    """
    grow = lambda states, v: F.array_append(states, step(F.element_at(states, -1), v))
    rest = lambda states: F.slice(states, F.lit(2), F.size(states))

    def fold(arr: Column) -> Column:
        last_block = F.floor(F.greatest(F.size(arr) - 1, F.lit(0)) / FOLD_BLOCK).cast("int")
        blocks = F.aggregate(
            F.sequence(F.lit(0), last_block),
            F.array(F.array(start)),
            lambda done, b: F.array_append(
                done,
                F.aggregate(
                    F.slice(arr, b * FOLD_BLOCK + 1, F.lit(FOLD_BLOCK)),
                    F.array(F.element_at(F.element_at(done, -1), -1)),
                    grow,
                ),
            ),
        )
        return F.flatten(F.transform(rest(blocks), rest))

    return bind(values, fold)
