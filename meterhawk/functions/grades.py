"""Verdict bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: band edges and names. ----------------------------------------------------------

F1_BANDS = [(0.8, "Strong"), (0.6, "Moderate")]
F1_ELSE = "Weak"
GENERIC_BANDS = [(0.80, "EXCELLENT"), (0.60, "GOOD"), (0.40, "FAIR")]
GENERIC_ELSE = "POOR"
SEPARATION_BANDS = [(1.5, "EXCELLENT"), (0.8, "GOOD"), (0.5, "FAIR")]
SEPARATION_ELSE = "POOR"
STABILITY_STABLE_BELOW = 0.3
STABILITY_MODERATE_BELOW = 0.6
COVERAGE_DIVERSE_REASONS = 4
COVERAGE_LIMITED_REASONS = 2
COVERAGE_FALLBACK_SHARE = 0.85
OVERLAP_BANDS = [(0.40, "HIGH OVERLAP"), (0.20, "PARTIAL")]
OVERLAP_ELSE = "LOW OVERLAP"
GAP_BIMODAL_ABOVE = 0.05
GAP_SLIGHT_ABOVE = 0.01

# --------------------------------------------------------------------------------------------------


def grade(value: Column | str, bands: list[tuple[float, str]], otherwise: str) -> Column:
    """Name of the first band whose lower edge the value reaches."""
    value = F.col(value) if isinstance(value, str) else value
    chain = F
    for edge, name in bands:
        chain = chain.when(value >= edge, F.lit(name))
    return chain.otherwise(F.lit(otherwise))


def f1_grade(value: Column | str) -> Column:
    return grade(value, F1_BANDS, F1_ELSE)


def generic_grade(value: Column | str) -> Column:
    return grade(value, GENERIC_BANDS, GENERIC_ELSE)


def separation_verdict(effect: Column) -> Column:
    return grade(effect, SEPARATION_BANDS, SEPARATION_ELSE)


def stability_verdict(variation: Column) -> Column:
    return (
        F.when(variation < STABILITY_STABLE_BELOW, "STABLE")
        .when(variation < STABILITY_MODERATE_BELOW, "MODERATE")
        .otherwise("UNSTABLE")
    )


def coverage_verdict(distinct: Column, fallback_share: Column) -> Column:
    diverse = (distinct >= COVERAGE_DIVERSE_REASONS) & (fallback_share < COVERAGE_FALLBACK_SHARE)
    return (
        F.when(diverse, "DIVERSE").when(distinct >= COVERAGE_LIMITED_REASONS, "LIMITED").otherwise("NARROW")
    )


def overlap_verdict(share: Column) -> Column:
    return grade(share, OVERLAP_BANDS, OVERLAP_ELSE)


def gap_verdict(gap: Column) -> Column:
    return (
        F.when(gap > GAP_BIMODAL_ABOVE, "BIMODAL").when(gap > GAP_SLIGHT_ABOVE, "SLIGHT GAP").otherwise("NO GAP")
    )
