"""Rates, reactivities and their standard errors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(mutations: Column, depth: Column) -> Column:
    """Mutations over depth; null at depth 0."""
    return F.try_divide(mutations.cast("double"), depth.cast("double"))


def rate_stderr(mutations: Column, depth: Column) -> Column:
    return F.try_divide(F.sqrt(rate(mutations, depth)), F.sqrt(depth.cast("double")))


def reactivity(modified, untreated=None, denatured=None) -> tuple[Column, Column]:
    """(reactivity, standard error) from (mutations, depth) of one, two or three samples; null where not finite."""
    rx, sx = rate(*modified), rate_stderr(*modified)
    if untreated is None:
        return rx, sx
    bg, sb = rate(*untreated), rate_stderr(*untreated)
    diff = rx - bg
    if denatured is None:
        return diff, F.sqrt(sx * sx + sb * sb)
    dc, sd = rate(*denatured), rate_stderr(*denatured)
    parts = [F.try_divide(sx, dc), F.try_divide(sb, dc), F.try_divide(sd * diff, dc * dc)]
    return F.try_divide(diff, dc), F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def good_nucleotide(nt: Column, background: Column | None, depths: list[Column], max_background: float, min_depth: int) -> Column:
    """Uppercase A, C, G or U, background rate in bounds (null passes), and depth enough in every sample."""
    out = nt.isin("A", "C", "G", "U")
    if background is not None:
        out &= F.coalesce(background <= max_background, F.lit(True))
    for d in depths:
        out &= F.coalesce(d, F.lit(0)) >= min_depth
    return out


def n7_log(factor: Column, value: Column) -> Column:
    """log2(factor / value); 3.32 for negative values."""
    return F.when(value < 0, F.lit(3.32)).otherwise(F.log2(F.try_divide(factor, value)))


# fixed values: how much more reactive each base is to a reagent
REAGENTS = {
    "5NIA": {"A": 0.474700, "U": 0.122603, "G": 0.272967, "C": 0.129731},
    "1M7": {"A": 0.301910, "U": 0.269965, "G": 0.265406, "C": 0.162718},
}


def rescale(nt: Column, value: Column, reagent: str, how: str = "down") -> Column:
    """``value`` over its base's reactivity; the largest factor is 1 for ``down``, the least for ``up``. Other bases stay."""
    inverse = {b: 1 / f for b, f in REAGENTS[reagent].items()}
    unit = {"down": max, "up": min}[how](inverse.values())
    factor = F.element_at(F.create_map(*[F.lit(x) for b, f in inverse.items() for x in (b, f / unit)]), nt)
    return value * F.coalesce(factor, F.lit(1.0))
