"""Column functions over arrays of doubles, and scalar helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column | str) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)


def minus(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))


def plus(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") + y.cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column | str, b: Column | str) -> Column:
    """0 where the product of the norms is next to nothing."""
    size = norm(a) * norm(b)
    return F.when(size > 1e-8, dot(a, b) / size).otherwise(0.0)


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.least(F.greatest(x, as_column(low)), as_column(high))


def valid_vector(v: Column, size: int) -> Column:
    """Whether v has the size and only finite components; a null vector isn't valid."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == size) & finite, F.lit(False))


def rejection(v: Column, size: int) -> Column:
    """Why v isn't valid: missing, size or values; null if it is."""
    return F.when(v.isNull(), "missing").when(F.size(v) != size, "size").when(~valid_vector(v, size), "values")


def normalize_from_limits(v: Column, limits: Sequence[tuple[float, float] | None]) -> Column:
    """Values mapped from their limits to [-1, 1] and cut there; without limits as they are. Not finite: an error."""

    def one(i: int, bounds: tuple[float, float] | None) -> Column:
        x = F.element_at(v, i + 1).cast("double")
        fine = F.assert_true(~F.isnan(x) & (F.abs(x) < float("inf")), "joint values must be finite").isNull()
        mapped = x if bounds is None else clip(2 * (x - bounds[0]) / (bounds[1] - bounds[0]) - 1, -1, 1)
        return F.when(fine, mapped)

    return F.array(*(one(i, b) for i, b in enumerate(limits)))


def remap_gripper(x: Column, from_closed: float, from_open: float, to_closed: float, to_open: float) -> Column:
    """A gripper's opening as a share of one range, cut to [0, 1], in another range."""
    return to_closed + clip((x - from_closed) / (from_open - from_closed), 0, 1) * (to_open - to_closed)


def residual_bounds(ranges: Sequence[tuple[float, float]], most: float, share: float, grippers: Sequence[int]) -> list[float]:
    """Per joint the lesser of `most` and a share of its range; 0 for grippers."""
    return [0.0 if i in set(grippers) else min(most, share * (high - low)) for i, (low, high) in enumerate(ranges)]


def corrected(base: Column, correction: Column, bounds: Sequence[float], ranges: Sequence[tuple[float, float]]) -> Column:
    """base + correction, the correction cut to its bounds and the result to the joints' ranges."""
    at = lambda v, i: F.element_at(v, i + 1).cast("double")
    return F.array(*(clip(at(base, i) + clip(at(correction, i), -b, b), low, high) for i, (b, (low, high)) in enumerate(zip(bounds, ranges, strict=True))))


def standardized(x: Column, mean: Column, std: Column) -> Column:
    return (x - mean) / std


def quantile_scaled(x: Column, q01: Column, q99: Column) -> Column:
    return 2 * (x - q01) / (q99 - q01) - 1


def to_seconds(x: Column) -> Column:
    """A number as seconds: beyond a million it counts nanoseconds."""
    return F.when(F.abs(x) > 1e6, x / 1e9).otherwise(x.cast("double"))


def duration_text(seconds: Column) -> Column:
    """Like 5.0s, 1m 5.0s or 1h 1m 5s."""
    hours, minutes = F.floor(seconds / 3600).cast("int"), F.floor(F.pmod(seconds, F.lit(3600.0)) / 60).cast("int")
    rest = F.pmod(seconds, F.lit(60.0))
    short = F.format_string("%.1fs", seconds)
    return F.when(seconds < 60, short).when(seconds < 3600, F.format_string("%dm %.1fs", minutes, rest)).otherwise(F.format_string("%dh %dm %.0fs", hours, minutes, rest))


def smooth_l1(x: Column, beta: float) -> Column:
    """Quadratic below beta, linear above."""
    return F.when(F.abs(x) < beta, 0.5 * x * x / beta).otherwise(F.abs(x) - 0.5 * beta)


def geodesic_degrees(predicted: Column, truth: Column) -> Column:
    """The angle between two rotations given as nine numbers, row by row."""
    trace = dot(predicted, truth)  # the trace of the one's transpose times the other
    return F.degrees(F.acos(clip((trace - 1) / 2, -1, 1)))
