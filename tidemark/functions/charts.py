"""The arithmetic of charts as column functions, so that a plan can return what is drawn."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps between ticks, times a power of ten.
STEPS = (1.0, 2.0, 2.5, 5.0, 10.0)


def nice_ticks(most: Column, count: int = 4) -> Column:
    """Round values from 0 up to the first that is no less than most; 0 and 1 of nothing."""
    raw = most.cast("double") / count
    scale = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    step = F.array_min(F.filter(F.array(*(scale * s for s in STEPS)), lambda s: s >= raw))
    ticks = F.transform(F.sequence(F.lit(0).cast("long"), F.ceil(most / step)), lambda k: F.round(k * step, 9))
    return F.when(most > 0, ticks).otherwise(F.array(F.lit(0.0), F.lit(1.0)))


def linear(value: Column, domain: tuple[Column, Column], target: tuple[float, float]) -> Column:
    """value of the domain on the target range; a domain of no width counts as 1 wide."""
    low, high = domain
    width = F.when(high == low, F.lit(1.0)).otherwise((high - low).cast("double"))
    return F.lit(float(target[0])) + (value - low) / width * (target[1] - target[0])


def nearest_index(xs: Column, x: Column) -> Column:
    """The place of the value nearest to x, of equals the first; -1 of none."""
    far = F.transform(xs, lambda v: F.abs(v - x))
    return F.when(F.size(xs) > 0, F.array_position(far, F.array_min(far)) - 1).otherwise(F.lit(-1)).cast("int")


def tick_indexes(length: Column, wanted: int = 6) -> Column:
    """At most wanted even places among length, the last always one of them."""
    step = F.when(length <= wanted, 1).otherwise(F.ceil((length - 1) / (wanted - 1))).cast("int")
    return F.when(length > 0, F.reverse(F.sequence((length - 1).cast("int"), F.lit(0), -step))).otherwise(F.array().cast("array<int>"))


def line_path(points: Column) -> Column:
    """An SVG path through points, an array of structs x and y."""
    place = lambda p: F.format_string("%.1f,%.1f", p["x"].cast("double"), p["y"].cast("double"))
    return F.array_join(F.transform(points, lambda p, i: F.concat(F.when(i == 0, "M").otherwise("L"), place(p))), "")


def area_path(points: Column, baseline: int) -> Column:
    """The closed area between the points' line and a baseline; empty without points."""
    first, last = F.get(points, F.lit(0))["x"].cast("double"), F.element_at(points, -1)["x"].cast("double")
    close = F.format_string(f"L%.1f,{baseline}L%.1f,{baseline}Z", last, first)
    return F.when(F.size(points) > 0, F.concat(line_path(points), close)).otherwise(F.lit(""))
