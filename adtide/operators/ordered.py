"""Exact ordered aggregates for groups of any size: running totals, quantiles, histograms.

An exact rank needs the order of a whole group, and a window over a group that holds a third of
all rows would put them into one task. Sketches are used to divide the work instead: at cut points
for running totals, around the wanted ranks for quantiles. The results do not depend on them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..sources.files import stage

#: Size of a quantile sketch; its rank error is about 0.13 percent of the rows.
SKETCH = 4096
#: A sketch is read at so many even steps; a cut goes MARGIN steps past the wanted rank.
GRID = 1000
MARGIN = 3
#: Different values of one group that are put in order by one task.
BOUND = 100_000


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, on: list[str], tasks: int) -> list[Row]:
    """Keys with more rows (``_rows``) than an even share of ``tasks``, and in how many ``_copies``
    their rows should be dealt. Each holds over 1/tasks of all rows, so there are fewer than ``tasks``
    of them, and all copies together are at most twice as many."""
    total = counts.agg(F.sum("_rows")).scalar()
    share = F.col("_rows") * tasks / total
    return counts.where(share > 1).select(*on, F.ceil(share).cast("int").alias("_copies")).collect()


def skew_join(
    big: DataFrame, small: DataFrame, on: list[str], spread_by: list[str], how: str = "inner", counts: DataFrame | None = None
) -> DataFrame:
    """Equi-join where ``small`` has one row per key and a key of ``big`` may be hot.

    ``counts`` has the rows of ``big`` for each key as ``_rows``; by default they are counted, which
    merges in the tasks that scan. Without a hot key this is the plain join. Otherwise the rows of
    a hot key are dealt by ``spread_by`` over as many copies of its small row as it has even shares,
    and all other keys keep the one row they have. The copies are stored, so that the planner knows
    their true size when it chooses how to join; the list of hot keys is shorter than the number of
    shuffle partitions and is broadcast.
    """
    if counts is None:
        counts = big.groupBy(*on).agg(F.count("*").alias("_rows"))
    hot = hot_keys(counts, on, partitions(big))
    if not hot:
        return big.join(small, on, how)
    schema = counts.select(*on, F.lit(0).alias("_copies")).schema
    listed = F.broadcast(big.sparkSession.createDataFrame(hot, schema))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_copies")), F.lit(0)).cast("int")
    dealt = big.join(listed, on, "left").withColumn("_salt", salt).drop("_copies")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    copies = stage(small.join(listed, on, "left").withColumn("_salt", each).drop("_copies"), "copies")
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def running_totals(
    df: DataFrame, keys: list[str], value: str, sums: list[str], splits: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """One row per (keys, value) with ``s``, ``s_cum`` and ``s_total`` for each column in ``sums``.

    ``s_cum`` includes the row's own value. Equal values are merged first; the distinct values are
    cut into ranges at approximate quantiles, every range is summed on its own, and the sums of
    the ranges before it are added. The merged rows are read three times (cuts, range sums, final
    window) from one shuffle: all three readers keep the same columns, which lets Spark reuse the
    exchange. With keys they are stored first, since the sizes of the groups decide the next plan.
    """
    splits = splits or max(16, 2 * partitions(df))
    merged = df.groupBy(*keys, value).agg(*[F.sum(s).alias(s) for s in sums])
    present = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in sums])
    probs = [i / splits for i in range(1, splits)]
    cut = F.percentile_approx(F.when(present, F.col(value)), probs, 20 * splits).alias("_cuts")
    if keys:
        merged = stage(merged, "merged")
        cuts = stage(merged.groupBy(*keys).agg(cut, F.count("*").alias("_rows")), "cuts")
        placed = skew_join(merged, cuts.drop("_rows"), keys, [value], counts=cuts)
    else:
        placed = merged.withColumn("_cuts", merged.agg(cut).scalar())
    # never null, or Catalyst would test the join key for null below the aggregate, on raw rows
    cuts_below = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(value))), F.lit(0))
    placed = placed.withColumn("_range", -cuts_below if descending else cuts_below).drop("_cuts")

    ranges = placed.groupBy(*keys, "_range").agg(*[F.sum(s).alias(s) for s in sums])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = ranges.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_{s}_before") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = (
        Window.partitionBy(*keys, "_range").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return placed.join(offsets, [*keys, "_range"]).select(
        *keys,
        value,
        *sums,
        *[(F.col(f"_{s}_before") + F.sum(s).over(inside)).alias(f"{s}_cum") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def _targets(p: float) -> tuple[Column, Column]:
    """The two ranks (from 0) between which the quantile is interpolated."""
    pos = F.lit(p) * (F.col("_rows") - 1)
    return F.floor(pos), F.ceil(pos)


def _enclosures(present: DataFrame, large: DataFrame, keys: list[str], value: str, probs: list[float], bound: int) -> DataFrame:
    """(keys, lo_i, hi_i, before_i): for each probability a closed interval that holds its ranks,
    with at most ``bound`` rows strictly inside, and the number of rows below it.

    A round cuts every interval that is too wide by a sketch of the rows inside, around the wanted
    ranks, counts what the cut holds, and takes it when it is shown to hold them; else the next cut
    is wider. Ranks that fall on equal values at an end close the interval onto that value. Stored
    after each half of a round, so that all readers see the same sketch.
    """
    v = F.col(value).cast("double")
    each = range(len(probs))
    c = lambda name, i: F.col(f"{name}_{i}")
    lowest, highest = F.lit(float("-inf")), F.lit(float("inf"))
    zero = F.lit(0).cast("bigint")
    state = large.select(
        *keys, "_rows",
        *[x.alias(f"{n}_{i}") for i in each for n, x in (("lo", lowest), ("hi", highest), ("before", zero), ("low", zero), ("open", F.col("_rows")))],
    )
    counts, margin = large.select(*keys, "_rows"), MARGIN
    ranks = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    for turn in range(40):
        wide = [c("open", i) > bound for i in each]
        if turn and state.where(reduce(lambda a, b: a | b, wide)).isEmpty():
            break
        rows = skew_join(present, state.drop("_rows"), keys, [value], counts=counts)
        inside = [(v > c("lo", i)) & (v < c("hi", i)) for i in each]
        # at first all intervals are the same
        sketched = {i: F.kll_sketch_agg_double(F.when(wide[i] & inside[i], v), F.lit(SKETCH)) for i in (each if turn else [0])}
        sketches = rows.groupBy(*keys).agg(*[x.alias(f"s_{i}") for i, x in sketched.items()])
        proposed = []
        for i, p in enumerate(probs):
            first, last = _targets(p)
            grid = F.kll_sketch_get_quantile_double(F.col(f"s_{i if turn else 0}"), ranks)
            place = lambda rank, i=i: (rank - c("before", i) - c("low", i)) / c("open", i) * GRID
            cut = lambda at, grid=grid: F.get(grid, F.least(F.greatest(at, F.lit(0)), F.lit(GRID)).cast("int"))
            keeps_lo = ~wide[i] | (first < c("before", i) + c("low", i))
            keeps_hi = ~wide[i] | (last >= c("before", i) + c("low", i) + c("open", i))
            proposed += [
                F.when(keeps_lo, c("lo", i)).otherwise(cut(F.floor(place(first) - margin))).alias(f"newlo_{i}"),
                F.when(keeps_hi, c("hi", i)).otherwise(cut(F.ceil(place(last) + margin))).alias(f"newhi_{i}"),
            ]
        tried = stage(state.join(sketches, keys).select(*state.columns, *proposed), "cuts")
        ends = tried.select(*keys, *[f"{n}_{i}" for i in each for n in ("newlo", "newhi")])
        tests = {"below": lambda lo, hi: v < lo, "low": lambda lo, hi: v == lo, "open": lambda lo, hi: (v > lo) & (v < hi), "high": lambda lo, hi: (v == hi) & (lo < hi)}
        counted = skew_join(present, ends, keys, [value], counts=counts).groupBy(*keys).agg(
            *[F.count_if(test(c("newlo", i), c("newhi", i))).alias(f"new{n}_{i}") for i in each for n, test in tests.items()]
        )
        next_ = []
        for i, p in enumerate(probs):
            first, last = _targets(p)
            below, low, open_, high = (c(f"new{n}", i) for n in tests)
            holds = (below <= first) & (last < below + low + open_ + high)
            on_low = holds & (last < below + low)
            on_high = holds & (first >= below + low + open_)
            new = {
                "lo": (c("newlo", i), c("newlo", i), c("newhi", i)), "hi": (c("newhi", i), c("newlo", i), c("newhi", i)),
                "before": (below, below, below + low + open_), "low": (low, low, high), "open": (open_, zero, zero),
            }
            next_ += [
                F.when(on_low, b).when(on_high, t).when(holds, a).otherwise(c(n, i)).alias(f"{n}_{i}") for n, (a, b, t) in new.items()
            ]
        before = state
        state = stage(tried.join(counted, keys).select(*keys, "_rows", *next_), "enclosed")
        opened = lambda s: s.agg(F.sum(sum((c("open", i) for i in each), zero))).first()[0]
        if opened(state) >= opened(before):
            margin *= 4
    return state.select(*keys, *[f"{n}_{i}" for i in each for n in ("lo", "hi", "before")])


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], totals: list[str] | None = None, bound: int = BOUND
) -> DataFrame:
    """Linear-interpolation quantiles per group, plus ``mean``, ``n`` and the sums of ``totals``.

    ``probs`` maps an output name to a probability. A group of up to ``bound`` rows is put in order
    as a whole. In a larger one, rounds of sketching and counting enclose the wanted ranks until at
    most ``bound`` rows lie inside each enclosure; only those, merged when equal, are put in order.
    So no task orders more than ``bound`` values of a group and two ends, whatever its size. Null
    values are left out. The input is read twice, and twice more for each round where there are
    large groups; stage it where it is expensive.
    """
    totals = totals or []
    kept = [*keys, value, *[t for t in totals if t not in (*keys, value)]]
    present = df.where(F.col(value).isNotNull()).select(*kept)
    sizes = stage(
        present.groupBy(*keys).agg(
            F.count("*").alias("_rows"), (F.sum(value) / F.count("*")).alias("_mean"), *[F.sum(t).alias(f"_total_{t}") for t in totals]
        ),
        "sizes",
    )
    large = sizes.where(F.col("_rows") > bound).select(*keys, "_rows")
    values = present.select(*keys, value)
    if large.isEmpty():
        chosen = values.select("*", F.lit(-1).alias("_of"), F.lit(0).cast("bigint").alias("_before"))
    else:
        cuts = _enclosures(values, large, keys, value, list(probs.values()), bound)
        every = sizes.select(*keys).join(cuts, keys, "left")
        rows = skew_join(values, every, keys, [value], counts=sizes.select(*keys, "_rows"))
        v = F.col(value).cast("double")
        inside = [
            F.when((v >= F.col(f"lo_{i}")) & (v <= F.col(f"hi_{i}")), F.struct(F.lit(i).alias("of"), F.col(f"before_{i}").alias("before")))
            for i in range(len(probs))
        ]
        whole = F.array(F.struct(F.lit(-1).alias("of"), F.lit(0).cast("bigint").alias("before")))
        of = F.explode(F.when(F.col("lo_0").isNull(), whole).otherwise(F.array_compact(F.array(*inside))))
        chosen = rows.select(*keys, value, of.alias("_w")).select(*keys, value, F.col("_w.of").alias("_of"), F.col("_w.before").alias("_before"))
    merged = chosen.groupBy(*keys, "_of", "_before", value).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*keys, "_of").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumn("_upto", F.col("_before") + F.sum("_n").over(order)).join(sizes.select(*keys, "_rows"), keys)

    def at(i: int, rank: Column) -> Column:
        holds = F.col("_of").isin(-1, i) & (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(holds, F.col(value)))

    picked = ranked.groupBy(*keys).agg(
        *[at(i, rank).alias(f"_{end}_{i}") for i, p in enumerate(probs.values()) for end, rank in zip(("lo", "hi"), _targets(p))]
    )
    out = [*keys, F.col("_rows").alias("n"), F.col("_mean").alias("mean"), *[F.col(f"_total_{t}").alias(t) for t in totals]]
    for i, (name, p) in enumerate(probs.items()):
        lo, hi = F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
        pos = F.lit(p) * (F.col("_rows") - 1)
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return sizes.join(picked, keys).select(*out)


def credible_interval(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean and the central 90 percent interval per group."""
    return exact_quantiles(df, keys, value, {"lo": 0.05, "hi": 0.95})


def equal_width_histogram(
    df: DataFrame, keys: list[str], value: str, bins: int, spread_by: list[str]
) -> DataFrame:
    """Counts in ``bins`` equal bins between each group's min and max, last bin closed.

    Adds the bin edges and ``density`` (counts scaled to area 1). A group with a single value is
    one bin of width 1 around it.
    """
    ends = df.groupBy(*keys).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count("*").alias("n_total")
    )
    flat = F.col("_lo") == F.col("_hi")
    ends = stage(ends, "ends").select(
        *keys,
        "n_total",
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo")) / bins).alias("width"),
    )
    slot = F.least(F.floor((F.col(value) - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    counted = (
        skew_join(df, ends, keys, spread_by, counts=ends.select(*keys, F.col("n_total").alias("_rows")))
        .groupBy(*keys, slot.cast("int").alias("bin"), "lo", "width", "n_total")
        .agg(F.count("*").alias("n"))
    )
    return counted.select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("right_edge"),
        "n",
        (F.col("n") / (F.col("n_total") * F.col("width"))).alias("density"),
    )
