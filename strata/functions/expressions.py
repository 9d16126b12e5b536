"""Column expressions. All built-in, codegen-friendly."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nullif_zero(x) -> Column:
    """``nullif(x, 0)``: a zero denominator gives NULL, not an error/∞."""
    x = _c(x)
    return F.when(x != 0, x)


def rate_per(num, den, scale: float = 1000.0) -> Column:
    """``num / nullif(den, 0) * scale``."""
    return _c(num) / nullif_zero(den) * F.lit(scale)


def pct_change(cur, prev, digits: int = 2) -> Column:
    """``round((cur − prev) / nullif(prev, 0) × 100, digits)``.

    NULL when either side is NULL or ``prev`` is 0. The explicit
    ``cur is not null and prev is not null`` guards of the marts are the
    same as NULL propagation, so they need no extra branch.
    """
    cur, prev = _c(cur), _c(prev)
    return F.round((cur - prev) / nullif_zero(prev) * F.lit(100), digits)


def decimal_mean(x, over=None) -> Column:
    """Mean computed in ``decimal(30,12)``: exact sums, so the result does
    not depend on how rows are split across tasks (a double ``avg`` can
    differ in the last bit between runs, which flips ``round`` at ties)."""
    m = F.avg(_c(x).cast("decimal(30,12)"))
    return m.over(over) if over is not None else m


def rounded_mean(x, digits: int, over=None) -> Column:
    """``round(avg(x), digits)`` as a double, order-independent."""
    return F.round(decimal_mean(x, over), digits).cast("double")


def share_pct(part, total, digits: int = 2) -> Column:
    """``round(part / nullif(total, 0) × 100, digits)`` (concentration)."""
    return F.round(_c(part) / nullif_zero(total) * F.lit(100), digits)


def classify_tier(rules: Sequence[tuple[str, Column]], default: str) -> Column:
    """First-match ladder: the label of the first rule whose condition is TRUE.

    Conditions follow SQL three-valued logic — a NULL comparison is not TRUE
    and falls through to the next rule — exactly like ``CASE WHEN``.
    """
    expr = None
    for label, cond in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def between_flag(t, lo: str, hi: str) -> Column:
    """1 when ``lo <= t <= hi`` (both inclusive), else 0; dates as ISO text."""
    t = _c(t)
    return t.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")).cast("int")


def cycle_features(t, period: int = 4, digits: int | None = None) -> dict[str, Column]:
    """Month number and its sine/cosine with the given period.

    The original pipeline calls the *month* number ``quarter`` and uses
    period 4, so the encoding cycles every four months; kept as is.
    """
    m = F.month(_c(t))
    ang = F.lit(2 * math.pi) * m / F.lit(period)
    s, c = F.sin(ang), F.cos(ang)
    if digits is not None:
        s, c = F.round(s, digits), F.round(c, digits)
    return {"quarter": m, "quarter_sin": s, "quarter_cos": c}


def months_back(as_of: str, months: int) -> Column:
    """``add_months(as_of, -months)`` as a date literal expression."""
    return F.add_months(F.lit(as_of).cast("date"), -months)


def recent_flag(t, as_of: str, months: int = 24) -> Column:
    """TRUE when ``t >= add_months(as_of, -months)``."""
    return _c(t) >= months_back(as_of, months)


def nan_to_null(x) -> Column:
    """Convert NaN to NULL once (Spark sorts NaN largest; NULLs are skipped)."""
    x = _c(x)
    return F.nanvl(x, F.lit(None).cast("double"))
