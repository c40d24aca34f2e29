"""Expressions over arrays of points (x, y, z): no shuffle and no Python, one element at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Axes = tuple[str, ...]
SPACE, PLANE = ("x", "y", "z"), ("x", "y")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def distance(a: Column, b: Column, axes: Axes = SPACE) -> Column:
    """Distance of two points."""
    total = F.lit(0.0)
    for c in axes:
        total = total + (b[c] - a[c]) * (b[c] - a[c])
    return F.sqrt(total)


def between(a: Column, b: Column, share: Column) -> Column:
    """The point at a share of the way from a to b."""
    return F.struct(*((a[c] + (b[c] - a[c]) * share).alias(c) for c in SPACE))


def steps(points: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """``body`` (a, b, number) of each pair of neighbours; empty under two points."""
    return F.when(F.size(points) >= 2, F.transform(F.slice(points, 2, F.size(points)), lambda b, i: body(F.get(points, i), b, i)))


def lengths(points: Column, axes: Axes = SPACE) -> Column:
    """Lengths of the segments."""
    return F.coalesce(steps(points, lambda a, b, _: distance(a, b, axes)), F.array().cast("array<double>"))


def length(points: Column, axes: Axes = SPACE) -> Column:
    """Length of the line, 0 under two points."""
    return F.aggregate(lengths(points, axes), F.lit(0.0), lambda acc, x: acc + x)


def arc(points: Column, axes: Axes = SPACE) -> Column:
    """Length of the line up to each point; zeros under two points, null for null."""
    run = F.aggregate(lengths(points, axes), F.array(F.lit(0.0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return F.when(F.size(points) == 0, F.array().cast("array<double>")).when(points.isNotNull(), run)


def distinct_steps(points: Column, tolerance: float = 1e-9) -> Column:
    """Points at least ``tolerance`` from the original point before."""
    return F.filter(points, lambda p, i: (i == 0) | (distance(F.get(points, F.greatest(i - 1, F.lit(0))), p) >= tolerance))


def densify(points: Column, longest: float, axes: Axes = SPACE) -> Column:
    """Each segment in equal parts of at most ``longest`` (measured over ``axes``), and the last point."""

    def parts(a: Column, b: Column, _: Column) -> Column:
        n = F.greatest(F.ceil(distance(a, b, axes) / longest), F.lit(1)).cast("int")
        return let(n, lambda n: F.transform(F.sequence(F.lit(0), n - 1), lambda k: between(a, b, k / n)))

    return F.when(F.size(points) >= 2, F.concat(F.flatten(steps(points, parts)), F.slice(points, -1, 1))).otherwise(points)


def closed(points: Column) -> Column:
    """The ring with its first point again at the end, unless it is there already (within 1e-8 and 1e-5 of its size)."""
    first, last = F.get(points, F.lit(0)), F.element_at(points, -1)
    same = F.lit(True)
    for c in SPACE:
        same = same & (F.abs(first[c] - last[c]) <= 1e-8 + 1e-5 * F.abs(last[c]))
    return F.when(F.size(points) == 0, points).when(same, points).otherwise(F.concat(points, F.slice(points, 1, 1)))


def ring(points: Column, spacing: float = 5.0) -> Column:
    """The closed ring in planar parts of at most ``spacing``; null gives an empty ring."""
    some = F.coalesce(points, F.array().cast("array<struct<x:double,y:double,z:double>>"))
    return let(let(some, closed), lambda p: densify(p, spacing, PLANE))


def foot(a: Column, b: Column, p: Column, small: float = 0.0) -> Column:
    """The share of the segment a to b at which it is nearest to p in the plane, 0 for a point."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    l2 = dx * dx + dy * dy
    return F.when(l2 > small, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / l2))).otherwise(0.0)


def to_line(points: Column, p: Column) -> Column:
    """Planar distance of a point to a line, null under two points."""
    near = lambda a, b, _: let(foot(a, b, p), lambda u: distance(p, between(a, b, u), PLANE))
    return F.array_min(steps(points, near))


def direction(a: Column, b: Column) -> Column:
    """Heading of the segment from a to b."""
    return F.atan2(b["y"] - a["y"], b["x"] - a["x"])
