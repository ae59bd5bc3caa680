"""Token-array functions: pad, truncate, mask, window, assemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions.fold import let


def take(arr: Column, n: Column) -> Column:
    return F.slice(arr, F.lit(1), F.greatest(n, F.lit(0)))


def take_last(arr: Column, n: Column) -> Column:
    n = F.least(F.greatest(n, F.lit(0)), F.size(arr))
    return F.slice(arr, F.size(arr) - n + 1, n)


def pad(arr: Column, width: Column, value, left: bool = False) -> Column:
    fill = F.array_repeat(F.lit(value), F.greatest(width - F.size(arr), F.lit(0)))
    return F.concat(fill, arr) if left else F.concat(arr, fill)


def round_up(n: Column, multiple: int) -> Column:
    return (F.ceil(n / F.lit(multiple)) * multiple).cast("int")


def pad_batch(df: DataFrame, batch: str, fields: dict[str, object], multiple: int = 1,
              left: bool = False, masks: bool = False) -> DataFrame:
    """Pad array fields to the longest of their batch, rounded up to a multiple.

    The batch maxima are one pre-aggregated row per batch, joined back.
    """
    width = df.groupBy(batch).agg(*[F.max(F.size(f)).alias(f"_w_{f}") for f in fields])
    out = df.join(width, batch)
    for f, value in fields.items():
        w = round_up(F.col(f"_w_{f}"), multiple)
        n = F.size(f)
        if masks:
            out = out.withColumn(f"{f}_mask", pad(F.array_repeat(F.lit(1), n), w, 0, left))
        out = out.withColumn(f"{f}_len", n).withColumn(f, pad(F.col(f), w, value, left))
    return out.drop(*[f"_w_{f}" for f in fields])


def valid_mask(length: Column, width: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: (i < length).cast("int"))


def eos_mask(ids: Column, eos_ids: list[int]) -> Column:
    """1 up to and including the first end token, 0 behind it; all 1 without one."""
    places = F.array(*[F.nullif(F.array_position(ids, F.lit(e)), F.lit(0)) for e in eos_ids])
    first = F.coalesce(F.array_min(places), F.size(ids).cast("long"))
    return let(first, lambda f: F.transform(ids, lambda x, i: (i < f).cast("int")))


def strip_padding(ids: Column, pad_id: int) -> Column:
    return F.array_remove(ids, pad_id)


def strip_edges(ids: Column, pad_id: int) -> Column:
    """Drop leading and trailing padding only."""
    kept = F.filter(F.transform(ids, lambda x, i: F.when(x != pad_id, i)), lambda i: i.isNotNull())
    first, last = F.array_min(kept), F.array_max(kept)
    return F.when(F.size(kept) == 0, F.slice(ids, 1, 0)).otherwise(F.slice(ids, first + 1, last - first + 1))


def strip_right_keep_eos(ids: Column, eos_id: int) -> Column:
    """Drop trailing end tokens used as padding, keeping one."""
    others = F.filter(F.transform(ids, lambda x, i: F.when(x != eos_id, i)), lambda i: i.isNotNull())
    last = F.coalesce(F.array_max(others), F.lit(-1))
    return F.slice(ids, F.lit(1), F.least(last + 2, F.size(ids)))


def truncate_pair(a: Column, b: Column, remove: Column, strategy: str, left: bool = False,
                  stride: int = 0) -> tuple[Column, Column, Column]:
    """Remove `remove` tokens from a pair; returns (a, b, overflow).

    longest_first trims the longer one token at a time (the second on ties), in closed form: first
    the longer is cut to the shorter, then both shrink in turn, the second first.
    """
    remove = F.greatest(remove, F.lit(0))
    cut = take_last if left else take
    none = F.slice(a, F.lit(1), F.lit(0))
    la, lb = F.size(a), F.size(b)

    def overflow(x, n, ok):
        window = F.least(F.size(x), n + stride)
        return F.when(ok & (n > 0), (take if left else take_last)(x, window)).otherwise(none)

    if strategy == "only_first":
        ok = la > remove
        return F.when(ok, cut(a, la - remove)).otherwise(a), b, overflow(a, remove, ok)
    if strategy == "only_second":
        ok = lb > remove
        return a, F.when(ok, cut(b, lb - remove)).otherwise(b), overflow(b, remove, ok)
    if strategy != "longest_first":
        raise ValueError(f"unknown truncation strategy {strategy}")
    gap_a = F.least(remove, F.greatest(la - lb, F.lit(0)))
    gap_b = F.least(remove, F.greatest(lb - la, F.lit(0)))
    rest = remove - gap_a - gap_b
    from_b = gap_b + F.ceil(rest / F.lit(2)).cast("int")
    from_a = gap_a + F.floor(rest / F.lit(2)).cast("int")
    return cut(a, la - from_a), cut(b, lb - from_b), none


def part_budgets(lengths: Column, fixed: list[bool], max_length: int) -> Column:
    """Length limit per part: null when nothing must be cut or the part is fixed.

    Parts no longer than the average share keep their length; the others share the rest equally.
    """
    n = len(fixed)
    item = [F.get(lengths, F.lit(i)) for i in range(n)]
    budget = F.lit(max_length)
    for i in range(n):
        if fixed[i]:
            budget = budget - item[i]
    free = [i for i in range(n) if not fixed[i]]
    if not free:
        return F.array(*[F.lit(None).cast("int")] * n)
    ordered = F.array_sort(F.array(*[item[i] for i in free]))
    k = len(free)
    # in ascending order a part keeps its length while it fits the average of what is left
    state = F.struct(budget.alias("left"), F.lit(k).alias("open"), F.lit(-1).alias("kept"))

    def step(acc, x):
        fits = (acc["open"] > 0) & (x <= F.floor(acc["left"] / F.greatest(acc["open"], F.lit(1))))
        return F.struct(
            F.when(fits, acc["left"] - x).otherwise(acc["left"]).cast("int").alias("left"),
            F.when(fits, acc["open"] - 1).otherwise(acc["open"]).alias("open"),
            F.when(fits, x).otherwise(acc["kept"]).alias("kept"))

    end = F.aggregate(ordered, state, step)
    share = F.floor(end["left"] / F.greatest(end["open"], F.lit(1))).cast("int")
    total = F.aggregate(lengths, F.lit(0), lambda acc, x: acc + x)
    limits = [F.lit(None).cast("int") if fixed[i] else
              F.when(item[i] <= end["kept"], item[i]).otherwise(F.least(share, item[i])) for i in range(n)]
    return F.when(total <= max_length, F.array(*[F.lit(None).cast("int")] * n)).otherwise(F.array(*limits))


def window_starts(n: Column, width: Column, stride: int) -> Column:
    """Starts of overlapping windows: advance by min(width, stride) until the end is covered."""
    step = F.least(F.lit(stride), width)
    return F.sequence(F.lit(0), F.greatest(F.ceil((n - width) / step) * step, F.lit(0)).cast("int"), step)


def window_chunks(df: DataFrame, key: str, first: str, second: str, max_len: int, specials: int,
                  stride: int) -> DataFrame:
    """Chunks of the second sequence beside the whole first one; chunk -> row key is kept."""
    width = (F.lit(max_len - specials) - F.size(first)).cast("int")
    return (df.withColumn("_w", width)
            .select(key, first, second, "_w", F.posexplode(
                window_starts(F.size(second), F.col("_w"), stride)).alias("chunk", "start"))
            .select(key, "chunk", "start", first,
                    F.slice(F.col(second), F.col("start") + 1, F.col("_w")).alias(second)))


def with_affixes(ids: Column, prefix: list[int], suffix: list[int], max_len: int) -> Column:
    """Fixed prefix and suffix ids around ids cut to the remaining room."""
    lits = lambda xs: F.array(*[F.lit(x) for x in xs]) if xs else F.slice(ids, F.lit(1), F.lit(0))
    room = max_len - len(prefix) - len(suffix)
    return F.concat(lits(prefix), F.slice(ids, F.lit(1), F.lit(room)), lits(suffix))


def preference_sequence(prompt: Column, chosen: Column, rejected: Column, turns: Column, eos: int,
                        max_len: int, max_prompt: int) -> Column:
    """Prompt and two responses as one sequence with positions and shifted labels.

    When the three exceed max_len the prompt keeps its last max_prompt tokens, then the responses
    share the remaining room in proportion. turns (array of token arrays, oldest first) are put in
    front from the newest on, until the first that does not fit.
    """
    total = lambda p, a, b: F.size(p) + F.size(a) + F.size(b)
    p = F.when(total(prompt, chosen, rejected) > max_len, take_last(prompt, F.lit(max_prompt))).otherwise(prompt)
    over = total(p, chosen, rejected) > max_len
    room = F.lit(max_len) - F.size(p)
    n0 = F.floor(F.size(chosen) / F.greatest(F.size(chosen) + F.size(rejected), F.lit(1)) * room).cast("int")
    a = F.when(over, take(chosen, n0)).otherwise(chosen)
    b = F.when(over, take(rejected, room - n0)).otherwise(rejected)

    zero = F.struct(total(p, a, b).alias("used"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(acc, t):
        fits = acc["open"] & (F.size(t) <= F.lit(max_len) - acc["used"])
        return F.struct(F.when(fits, acc["used"] + F.size(t)).otherwise(acc["used"]).alias("used"),
                        (acc["n"] + fits.cast("int")).alias("n"), fits.alias("open"))

    kept = F.aggregate(F.reverse(turns), zero, step)["n"]
    full = F.concat(F.flatten(take_last(turns, kept)), p)
    n_p, n_a, n_b = F.size(full), F.size(a), F.size(b)
    zeros = lambda n: F.array_repeat(F.lit(0), n)
    shifted = lambda r: F.concat(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), F.array(F.lit(eos)))
    upto = lambda lo, n: F.when(n > 0, F.sequence(lo, lo + n - 1)).otherwise(F.array().cast("array<int>"))
    return F.struct(
        F.concat(full, a, b).alias("input_ids"),
        F.concat(upto(F.lit(0), n_p), upto(n_p, n_a), upto(n_p, n_b)).alias("position_ids"),
        F.concat(zeros(n_p), shifted(a), zeros(n_b)).alias("chosen_labels"),
        F.concat(zeros(n_p), zeros(n_a), shifted(b)).alias("rejected_labels"),
        F.array(n_p, n_p + n_a, n_p + n_a + n_b).alias("bounds"),
        F.concat(F.array_repeat(n_p + n_a + n_b, n_p), F.array_repeat(n_p + n_a, n_a),
                 F.array_repeat(n_p + n_a + n_b, n_b)).alias("mask_end_rows"))
