"""Banded severity scores and their logistic transform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortspark.functions.predicates import holds
from cohortspark.functions.scalars import band_points, logistic


def gcs_total(eyes: str = "gcs_e", motor: str = "gcs_m", verbal: str = "gcs_v") -> Column:
    """Sum of the three coma-scale parts, NULL when one is unknown."""
    return F.col(eyes) + F.col(motor) + F.col(verbal)


def banded_score(bands: dict[str, dict], first_true: list[tuple[str, int]] | None = None) -> Column:
    """Sum of points over columns.

    bands: column -> {"bands": [(exclusive upper limit, points)…], "above": points, "missing": points}.
    first_true: flag columns in order of precedence; only the first that is 1 counts.
    """
    total = F.lit(0)
    for name, rule in bands.items():
        total = total + band_points(name, rule["bands"], rule["above"], rule.get("missing", 0))
    chronic = F.lit(0)
    for name, points in reversed(first_true or []):
        chronic = F.when(holds(F.col(name) == 1), F.lit(points)).otherwise(chronic)
    return total + chronic


def mortality(score: Column, coefficients: tuple[float, float, float]) -> Column:
    """Logistic transform of a·1 + b·score + c·ln(score + 1)."""
    a, b, c = coefficients
    return logistic(F.lit(a) + F.lit(b) * score + F.lit(c) * F.ln(score + F.lit(1)))


def severity(
    df: DataFrame,
    bands: dict[str, dict],
    first_true: list[tuple[str, int]] | None,
    coefficients: tuple[float, float, float],
    score: str = "score",
    probability: str = "mortality",
) -> DataFrame:
    """Add score and probability in a single pass."""
    return df.withColumn(score, banded_score(bands, first_true)).withColumn(
        probability, mortality(F.col(score), coefficients)
    )
