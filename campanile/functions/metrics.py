"""Arithmetic of campaign metrics.

Money is summed exactly.  Events are summed as 64-bit micro-units, which stay
inside generated code; stored statistics are ``DECIMAL(18, 6)`` and are summed
as decimals, because there are far fewer of them and totals may be larger.
Ratios are taken in double precision, after summing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000


def micros(amount: str) -> Column:
    """A money amount as whole micro-units, rounded as a cast to ``DECIMAL(18, 6)``.

    Scaling in double precision is exact enough unless the amount is large or
    close to a tie; those few go through the decimal.  NaN and amounts beyond the
    money type raise (ANSI) instead of vanishing from a sum.
    """
    scaled = f"{amount} * {MICROS}.0D"
    return F.expr(
        f"CASE WHEN abs({amount}) < 1e12D AND (abs({amount}) >= 1e8D OR abs({scaled} - rint({scaled})) >= 0.48D) "
        f"THEN CAST(CAST({amount} AS DECIMAL(18,6)) * {MICROS} AS BIGINT) "
        f"ELSE CAST(rint({scaled}) AS BIGINT) END"
    )


def sum_money(amount: str) -> Column:
    """Exact sum of event amounts in micro-units, 0 when there is none."""
    return F.coalesce(F.sum(micros(amount)), F.lit(0))


def from_micros(total: Column) -> Column:
    """Micro-units back to ``DECIMAL(18, 6)``, exactly."""
    return (total.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that is NULL when the denominator is 0 or NULL."""
    numerator, denominator = _col(numerator), _col(denominator)
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def safe_div(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale``, 0 unless the denominator is positive."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        times = f" * {float(scale)}D" if scale != 1 else ""
        return F.expr(
            f"CASE WHEN {denominator} > 0 "
            f"THEN CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE){times} ELSE 0.0D END"
        )
    numerator, denominator = _col(numerator), _col(denominator)
    quotient = numerator.cast("double") / denominator.cast("double")
    if scale != 1:
        quotient = quotient * F.lit(float(scale))
    return F.when(denominator > 0, quotient).otherwise(F.lit(0.0))


def rounded_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Quotient rounded half away from zero, in whole numbers.

    A double may lie on the wrong side of a tie.  Arguments are counts, or both
    money with at most six places.  NULL unless the denominator is positive.
    """
    def whole(value: Column) -> Column:
        return (value.cast("decimal(38,6)") * F.lit(MICROS)).cast("decimal(38,0)")

    n, d, unit = whole(numerator), whole(denominator), 10 ** places
    half = F.sign(n).cast("int") * d
    scaled = (n * F.lit(2 * unit) + half).cast("decimal(38,0)")
    quotient = F.call_function("div", scaled, (d * F.lit(2)).cast("decimal(38,0)"))
    return F.when(d > 0, quotient.cast("double") / F.lit(float(unit)))


def count_where(condition: Column) -> Column:
    """Number of rows meeting the condition, 0 on empty input."""
    return F.count_if(condition)


def pivot_count(event_type: str) -> Column:
    """Events of one type; 0 when the group has none of that type."""
    return F.expr(f"sum(CASE WHEN event_type = '{event_type}' THEN event_count ELSE 0 END)")


def pivot_count_or_null(event_type: str) -> Column:
    """Events of one type; NULL when the group has none (``FILTER`` semantics)."""
    return F.expr(f"sum(event_count) FILTER (WHERE event_type = '{event_type}')")


def performance_score(ctr: Column, conversion_rate: Column, spend: Column, conversions: Column) -> Column:
    """Weighted score of a campaign, rounded to 4 places.

    The cost term is capped at 100.  ``least`` skips NULL, so a campaign without
    conversions scores the cap; this matches the established report.
    """
    cost = F.least(ratio(spend, conversions), F.lit(100.0))
    # ``round`` sees the value in decimal form, so ties round half up.
    score = ctr * F.lit(0.4) + conversion_rate * F.lit(0.4) + cost * F.lit(0.2)
    return F.round(score.cast("decimal(28,12)"), 4).cast("double")


def in_thousands(amount: Column) -> Column:
    """Amount shown in thousands with two places."""
    return rounded_ratio(amount, F.lit(1000), 2)


def in_percent(fraction: Column) -> Column:
    return fraction * F.lit(100.0)
