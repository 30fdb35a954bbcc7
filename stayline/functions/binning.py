"""Interval binning and rule chains as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")

# --- Fixed values: the four tenure binnings and the risk cut points ---
TENURE_BINS = {
    # name: (edges, labels, right-closed, lowest edge included)
    "prepared": ([0, 12, 24, 48, 72], ["0-12", "13-24", "25-48", "49-72"], True, True),
    "model": ([0, 12, 24, 36, 48, 60, INF], ["0-12", "12-24", "24-36", "36-48", "48-60", "60+"], True, False),
    "category": ([0, 12, 24, 48, 60, INF], ["Short-term", "Mid-term", "Long-term", "Very-long-term", "Loyal"], True, False),
    "left": ([0, 12, 24, 36, 48, 60, 72], ["1-12", "13-24", "25-36", "37-48", "49-60", "61-72"], False, False),
}
RISK_EDGES, RISK_LABELS = [0.0, 0.3, 0.7, 1.0], ["Low", "Medium", "High"]
# --- End of fixed values ---


def cut(col: Column | str, edges: Sequence[float], labels: Sequence[str], right: bool = True,
        include_lowest: bool = False) -> Column:
    """Label the interval that holds the value; null when none does.

    ``right=True`` closes intervals on the right ``(a, b]``, otherwise on the left ``[a, b)``.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) - 1} labels, got {len(labels)}")
    x = F.col(col) if isinstance(col, str) else col

    def inside(i: int) -> Column:
        lo, hi = float(edges[i]), float(edges[i + 1])
        if right:
            low = (x >= lo) if include_lowest and i == 0 else (x > lo)
            return low & (x <= hi)
        high = (x <= hi) if include_lowest and i == len(labels) - 1 else (x < hi)
        return (x >= lo) & high

    # A NaN compares as larger than everything, so it has to be shut out explicitly.
    chain = reduce(lambda acc, i: acc.when(inside(i), labels[i]), range(1, len(labels)), F.when(inside(0), labels[0]))
    return F.when(~F.isnan(x.cast("double")), chain)


def tenure_bin(col: Column | str, version: str) -> Column:
    edges, labels, right, lowest = TENURE_BINS[version]
    return cut(col, edges, labels, right, lowest)


def risk_level(p: Column | str) -> Column:
    """Low below 0.3, Medium below 0.7, else High."""
    x = F.col(p) if isinstance(p, str) else p
    low, high = RISK_EDGES[1:3]
    return F.when(x < low, RISK_LABELS[0]).when(x < high, RISK_LABELS[1]).when(x.isNotNull(), RISK_LABELS[2])


def risk_level_cut(p: Column | str) -> Column:
    """The right-closed form: a probability of exactly 0 has no level."""
    return cut(p, RISK_EDGES, RISK_LABELS)
