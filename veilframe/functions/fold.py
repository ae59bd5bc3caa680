"""Array folds that stay linear: evaluate once, append in blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 32  # an append copies its block, a block the list of blocks


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often body uses it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan(items: Column, zero: Column, carry: list[str], out_type, step, finish=None) -> Column:
    """Fold over `items` that collects an array.

    zero and the result of step(state, item) are structs of the `carry` fields and `out`, an array
    that step appends to. Outputs are collected per block of items, so appending does not copy the
    whole result each time. finish(last_state) may give a final array to append.
    """
    empty = F.array().cast(out_type).alias("out")

    def run(a):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(a), F.lit(1)) - 1) / _BLOCK).cast("int")),
                             lambda b: F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK)))

        def block(acc, items_):
            last = F.element_at(acc, -1)
            start = F.struct(*[last[c].alias(c) for c in carry], empty)
            return F.concat(acc, F.array(F.aggregate(items_, start, step)))

        states = F.aggregate(blocks, F.array(zero), block)
        return let(states, lambda s: F.concat(
            F.flatten(F.transform(s, lambda x: x["out"])),
            finish(F.element_at(s, -1)) if finish else F.array().cast(out_type)))

    return let(items, run)
