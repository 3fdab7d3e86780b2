"""Row-level feature expressions, all as JVM-side ``Column`` builders.

Each helper returns a ``Column`` so it composes inside ``select`` /
``withColumns`` and stays inside whole-stage codegen.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the reference's semantics depend on.
EMPLOYMENT_SENTINEL = 365243          # "days employed" placeholder for no employment
DAYS_PER_YEAR = 365
RISK_BAND_EDGES = (0.3, 0.7)          # low < .3 <= moderate < .7 <= high
RISK_BAND_LABELS = ("Low Risk", "Moderate Risk", "High Risk")
FN_COST, FP_COST = 10, 1              # business cost = 10 * FN + 1 * FP


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num, den, fill: float | Column = 0.0) -> Column:
    """a / b; a zero or missing denominator (pandas: inf or NaN) becomes ``fill``.

    ANSI mode makes plain ``/`` raise on 0, so ``try_divide`` is used.
    """
    fill_col = fill if isinstance(fill, Column) else F.lit(float(fill))
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), fill_col)


def raw_ratio(num, den) -> Column:
    """a / b with NULL where pandas would produce inf or NaN."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def clamp_min_keep_null(x, low: float = 0.0) -> Column:
    """``max(x, low)`` where a missing x stays missing (Python ``max`` on NaN)."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(x, F.lit(low)))


def positive_flag(x) -> Column:
    """1 if x > 0, 0 otherwise, also 0 when x is missing."""
    return F.coalesce(_c(x) > 0, F.lit(False)).cast("int")


def indicator(x, value) -> Column:
    """1 where x equals value, 0 otherwise (missing → 0)."""
    return F.coalesce(_c(x) == F.lit(value), F.lit(False)).cast("int")


def days_to_years(days) -> Column:
    return _c(days).cast("double") / F.lit(float(DAYS_PER_YEAR))


def whole_years(days) -> Column:
    return F.floor(_c(days) / F.lit(DAYS_PER_YEAR))


def sentinel_flag(x, sentinel: int = EMPLOYMENT_SENTINEL) -> Column:
    return F.coalesce(_c(x) == F.lit(sentinel), F.lit(False))


def null_if_sentinel(x, sentinel: int = EMPLOYMENT_SENTINEL) -> Column:
    x = _c(x)
    return F.when(x == F.lit(sentinel), F.lit(None)).otherwise(x)


def abs_widened(x, integral: bool = True) -> Column:
    """abs() after widening ints to long: ANSI abs(-128 tinyint) raises."""
    return F.abs(_c(x).cast("long")) if integral else F.abs(_c(x))


def threshold_label(p, t: float | Column = 0.5) -> Column:
    tt = t if isinstance(t, Column) else F.lit(float(t))
    return (_c(p) >= tt).cast("int")


def risk_band(p) -> Column:
    p = _c(p)
    lo, hi = RISK_BAND_EDGES
    return (F.when(p < lo, F.lit(RISK_BAND_LABELS[0]))
             .when(p < hi, F.lit(RISK_BAND_LABELS[1]))
             .when(p.isNotNull(), F.lit(RISK_BAND_LABELS[2])))


def percent_score(p, digits: int = 1) -> Column:
    return F.round(_c(p) * F.lit(100.0), digits)


def l2_distance(cols: list[str], probe: dict[str, float] | dict[str, Column]) -> Column:
    """Euclidean distance of each row to a probe point (no row lambda)."""
    terms = []
    for c in cols:
        pv = probe[c]
        pv = pv if isinstance(pv, Column) else F.lit(float(pv))
        d = F.col(c).cast("double") - pv
        terms.append(d * d)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.sqrt(total)


def missing_tokens_to_null(x, tokens=("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None",
                                      "#N/A", "-NaN", "-nan", "<NA>", "n/a", "#NA", "#N/A N/A",
                                      "-1.#IND", "-1.#QNAN", "1.#IND", "1.#QNAN")) -> Column:
    """CSV missing tokens → NULL (``nullValue`` takes only one token)."""
    x = _c(x)
    return F.when(F.trim(x).isin(list(dict.fromkeys(tokens))), F.lit(None)).otherwise(x)
