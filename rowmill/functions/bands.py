"""Named bands for percentages and test statistics. Labels can be replaced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits in percent of the first three bands, and the labels of all four.
MISSING_LIMITS = [1.0, 5.0, 15.0]
MISSING_LABELS = ["trivial", "manageable", "sophisticated", "harmful"]

# As above; the first label is for exactly 0 percent.
OUTLIER_LIMITS = [1.0, 5.0, 15.0]
OUTLIER_LABELS = ["none", "mild", "moderate", "high", "critical"]

# Lower limits of W, best first, and the labels of all four bands.
CLOSENESS_LIMITS = [0.99, 0.95, 0.90]
CLOSENESS_LABELS = ["very close", "close", "similar", "not normal"]

NORMAL_P_VALUE = 0.05


def below_limits(x: Column, limits: Sequence[float], labels: Sequence[str]) -> Column:
    band = F.lit(labels[-1])
    for limit, label in reversed(list(zip(limits, labels))):
        band = F.when(x < limit, F.lit(label)).otherwise(band)
    return F.when(x.isNotNull(), band)


def missing_band(pct: Column, labels: Sequence[str] = MISSING_LABELS) -> Column:
    return below_limits(pct, MISSING_LIMITS, labels)


def outlier_band(pct: Column, labels: Sequence[str] = OUTLIER_LABELS) -> Column:
    rest = below_limits(pct, OUTLIER_LIMITS, labels[1:])
    return F.when(pct == 0, F.lit(labels[0])).otherwise(rest)


def closeness_band(w: Column, labels: Sequence[str] = CLOSENESS_LABELS) -> Column:
    band = F.lit(labels[-1])
    for limit, label in reversed(list(zip(CLOSENESS_LIMITS, labels))):
        band = F.when(w >= limit, F.lit(label)).otherwise(band)
    return F.when(w.isNotNull(), band)


def normal_verdict(p: Column) -> Column:
    return F.when(p > NORMAL_P_VALUE, F.lit("yes")).otherwise(F.lit("no"))
