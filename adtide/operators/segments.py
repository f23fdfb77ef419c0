"""Scans along series of any length: recursive sums and lags, cut into segments of time.

A series is cut at fixed multiples of its step number, so a long one is worked on by as many tasks
as it has segments. A recursive sum ``y_t = decay * y_{t-1} + x_t`` over a segment of n steps acts on
the value before it as the affine map ``y -> decay^n * y + local``. Maps are combined in order, in
groups of ``FAN``, level by level, until one group is left; then every segment is given the value
that enters it. No task holds more than a segment, or ``FAN`` maps, of a series.

Steps are numbered from 0 without gaps, as a filled calendar numbers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import stage
from .carryover import recursive_sum

SEGMENT = 4096
FAN = 1024


def _segment(step: str, size: int) -> Column:
    return F.floor(F.col(step) / size).cast("bigint").alias("_seg")


def segmented_lag(df: DataFrame, keys: list[str], step: str, value: str, name: str, size: int = SEGMENT) -> DataFrame:
    """``df`` with the value of the step before as ``name``, null at the start of a series.

    Rows are read and shuffled once, by series and segment; the last row of a segment also travels
    with the next one, where only its value is taken.
    """
    own, edge = F.struct(_segment(step, size), F.lit(False).alias("_edge")), F.struct((_segment(step, size) + 1).alias("_seg"), F.lit(True).alias("_edge"))
    ends = F.pmod(F.col(step), F.lit(size)) == size - 1
    rows = df.select("*", F.inline(F.when(ends, F.array(own, edge)).otherwise(F.array(own))))
    inside = Window.partitionBy(*keys, "_seg").orderBy(step)
    return rows.withColumn(name, F.lag(value).over(inside)).where(~F.col("_edge")).drop("_seg", "_edge")


def _entering(maps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _seg, _enter): the value that enters each segment, from the maps (_a, _b) before it."""
    groups = maps.withColumn("_group", F.floor(F.col("_seg") / FAN).cast("bigint")).groupBy(*keys, "_group").agg(
        F.sort_array(F.collect_list(F.struct("_seg", "_a", "_b"))).alias("_maps")
    )
    ident = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))

    def then(done: Column, m: Column) -> Column:
        last = F.element_at(done, -1)
        return F.concat(done, F.array(F.struct((last["a"] * m["_a"]).alias("a"), (m["_a"] * last["b"] + m["_b"]).alias("b"))))

    groups = stage(groups.select(*keys, "_group", F.col("_maps._seg").alias("_segs"), F.aggregate("_maps", F.array(ident), then).alias("_so_far")), "maps")
    if groups.where(F.col("_group") > 0).isEmpty():
        groups = groups.withColumn("_enter", F.lit(0.0))
    else:
        whole = F.element_at("_so_far", -1)
        above = _entering(groups.select(*keys, F.col("_group").alias("_seg"), whole["a"].alias("_a"), whole["b"].alias("_b")), keys)
        groups = groups.join(above.withColumnRenamed("_seg", "_group"), [*keys, "_group"])
    each = F.explode(F.arrays_zip(F.col("_segs").alias("seg"), F.slice("_so_far", F.lit(1), F.size("_segs")).alias("map"))).alias("_e")
    return groups.select(*keys, "_enter", each).select(
        *keys, F.col("_e.seg").alias("_seg"), (F.col("_e.map.a") * F.col("_enter") + F.col("_e.map.b")).alias("_enter")
    )


def segmented_sum(
    df: DataFrame, keys: list[str], step: str, x: str, decay: str, name: str, size: int = SEGMENT
) -> DataFrame:
    """``df`` with ``name``, the recursive sum of ``x`` along each series; ``decay`` is constant in a series."""
    rest = [c for c in df.columns if c not in (*keys, decay)]
    packed = df.groupBy(*keys, decay, _segment(step, size)).agg(
        F.sort_array(F.collect_list(F.struct(step, *[c for c in rest if c != step]))).alias("_points")
    )
    packed = stage(packed.withColumn("_local", recursive_sum(F.col(f"_points.{x}"), F.col(decay))), "segments")
    maps = packed.select(
        *keys, "_seg", F.pow(F.col(decay), F.size("_local").cast("double")).alias("_a"), F.element_at("_local", -1).alias("_b")
    )
    joined = packed.join(_entering(maps, keys), [*keys, "_seg"])
    whole = F.transform("_local", lambda v, i: v + F.pow(F.col(decay), (i + 1).cast("double")) * F.col("_enter"))
    each = F.explode(F.arrays_zip("_points", whole.alias("_sum"))).alias("_e")
    return joined.select(*keys, decay, each).select(
        *[F.col(c) if c in (*keys, decay) else F.col(f"_e._points.{c}").alias(c) for c in df.columns], F.col("_e._sum").alias(name)
    )
