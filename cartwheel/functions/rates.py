"""Conversion-rate arithmetic and its text forms (X7-X11), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def conversion_rate(purchases, views, scale: int = 4, precision: int = 24) -> Column:
    """``round(purchases / views, scale)``, 0 when there are no views.

    Exact decimal arithmetic with HALF_UP rounding (for non-negative counts the
    same as half away from zero); NULLIF guards the division under ANSI mode.
    """
    p = _col(purchases).cast("decimal(20,0)")
    v = F.nullif(_col(views), F.lit(0)).cast("decimal(20,0)")
    rate = F.round(p / v, scale).cast(f"decimal({precision},{scale})")
    return F.when(_col(views) == 0, F.lit(0).cast(f"decimal({precision},{scale})")).otherwise(rate)


def percent_points(rate_4: Column, scale: int = 2) -> Column:
    """A 4-place rate as percent with 2 places, exactly (rate x 100)."""
    return (rate_4 * F.lit(100)).cast(f"decimal(20,{scale})")


def decimal_percent_text(rate_4: Column) -> Column:
    """``{rate:.2%}`` of a 4-place decimal: exact, no rounding needed."""
    return F.concat(percent_points(rate_4).cast("string"), F.lit("%"))


def fixed4_text(rate_4: Column) -> Column:
    """``{rate:.4f}`` of a 4-place decimal (X11)."""
    return rate_4.cast("decimal(24,4)").cast("string")


def _round_half_even_exact(x: Column, factor: float) -> Column:
    """Nearest integer to the exact value of ``x * factor`` (a double), ties to even.

    ``x * factor`` is split into hi + lo without error (Veltkamp/Dekker two-product,
    ``factor`` has few bits), so the rounding decision uses the exact binary value
    as C-library ``%.Nf`` formatting does.
    """
    splitter = F.lit(134217729.0)  # 2^27 + 1
    c = splitter * x
    x_hi = c - (c - x)
    x_lo = x - x_hi
    f = F.lit(float(factor))
    hi = x * f
    lo = ((x_hi * f - hi) + x_lo * f)
    base = F.floor(hi)
    frac = hi - base  # exact; the true fraction is frac + lo, with |lo| <= ulp(hi) / 2
    tie_up = (lo > 0) | ((lo == 0) & (F.pmod(base, F.lit(2)) == 1))
    up = (frac > 0.5) | ((frac == 0.5) & tie_up)
    return F.when(up, base + 1).otherwise(base)


def double_percent_text(purchases, views) -> Column:
    """``{p / v:.2%}`` of the binary-float ratio, 0 when no views.

    The float ratio ``p / v`` is multiplied by 100 in double arithmetic, then
    rounded to 2 places on its exact binary value with ties to even: 1/32 -> 3.12%.
    """
    p = _col(purchases).cast("double")
    v = _col(views).cast("double")
    pct = (p / F.nullif(v, F.lit(0.0))) * F.lit(100.0)
    hundredths = _round_half_even_exact(pct, 100.0)
    text = F.concat((hundredths.cast("decimal(30,0)") / F.lit(100)).cast("decimal(30,2)")
                    .cast("string"), F.lit("%"))
    return F.when(_col(views) == 0, F.lit("0.00%")).otherwise(text)
