"""Domain normalisation and reject reasons as ``Column -> Column`` rules.

These are plain Catalyst expressions (no UDF), so they stay inside
whole-stage codegen and are shared by the accept and the reject side of a
split: both sides call the same function, so they cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# --- fixed values (must equal the source contract) -------------------------
# Priority contract: integers 1..4. Since the format change the source sends
# labels instead; meaning is unchanged: urgent=1, high=2, medium=3, low=4.
PRIORITY_MIN = 1
PRIORITY_MAX = 4
PRIORITY_LABELS = {"urgent": 1, "high": 2, "medium": 3, "low": 4}

# Reject reasons, checked in this order: NULL, empty, a number outside the
# range, any other string.
REASON_NULL = "priority NULL"
REASON_EMPTY = "priority empty"
REASON_OUT_OF_RANGE = "priority is a number outside 1..4"
REASON_UNKNOWN = "priority is an unknown string, not in the label map"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# An integer: optional sign and digits, spaces around.
INT_PATTERN = r"^ *[+-]?[0-9]+ *$"


def strict_int(c: Column | str) -> Column:
    """Integer reading of a string (``' 3 '`` and ``'+2'`` yes; ``'3.7'``,
    ``'1e0'``, ``'0x3'`` no), NULL otherwise.

    The pattern test comes first: ``try_cast`` alone gives the same values
    but pays for a thrown and caught exception on every non-numeric row (a
    label like ``'urgent'``), about ten times the cost of the test.
    ``try_cast`` still guards overflow of long digit strings.
    """
    raw = _col(c)
    return F.when(raw.rlike(INT_PATTERN), raw.try_cast("int"))


def normalize_domain(c: Column | str, lo: int = PRIORITY_MIN, hi: int = PRIORITY_MAX,
                     labels: Mapping[str, int] = PRIORITY_LABELS) -> Column:
    """Three groups: in-range integers kept; known labels (any case, trimmed)
    mapped; everything else NULL. NULL is the reject signal."""
    raw = _col(c)
    num = strict_int(raw)
    key = F.lower(F.trim(raw))
    out = F.when(num.between(lo, hi), num)
    for label, value in labels.items():
        out = out.when(key == F.lit(label), F.lit(value))
    return out.otherwise(F.lit(None).cast("int"))


def reject_reason(c: Column | str, lo: int = PRIORITY_MIN, hi: int = PRIORITY_MAX,
                  labels: Mapping[str, int] = PRIORITY_LABELS) -> Column:
    """Why a value is rejected; NULL when ``normalize_domain`` accepts it."""
    raw = _col(c)
    return (
        F.when(normalize_domain(raw, lo, hi, labels).isNotNull(), F.lit(None).cast("string"))
        .when(raw.isNull(), F.lit(REASON_NULL))
        .when(F.trim(raw) == "", F.lit(REASON_EMPTY))
        .when(strict_int(raw).isNotNull(), F.lit(REASON_OUT_OF_RANGE))
        .otherwise(F.lit(REASON_UNKNOWN))
    )
