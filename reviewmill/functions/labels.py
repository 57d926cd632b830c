"""Label and ranking expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.text import _col
from reviewmill.schemas import LABELS, UNKNOWN_LABEL

# Severity order of alert levels; any other level sorts last.
LEVEL_ORDER = {"critical": 0, "high": 1, "medium": 2, "low": 3}
OTHER_LEVEL = 9


def _by_stars(rating: Column) -> Column:
    return (
        F.when(rating <= 2, F.lit("negative"))
        .when(rating == 3, F.lit("neutral"))
        .when(rating >= 4, F.lit("positive"))
    )


def weak_label(c: Column | str) -> Column:
    """Label implied by the stars; values between the steps are unknown."""
    return F.coalesce(_by_stars(_col(c)), F.lit(UNKNOWN_LABEL))


def weak_label_in_range(c: Column | str) -> Column:
    """As :func:`weak_label`, but null unless the rating lies in 1..5 on a step."""
    rating = _col(c)
    return F.when(rating.between(1, 5), _by_stars(rating))


def level_rank(c: Column | str) -> Column:
    level = F.lower(_col(c))
    ranked = F.lit(None).cast("int")
    for name, order in LEVEL_ORDER.items():
        ranked = F.when(level == name, F.lit(order)).otherwise(ranked)
    return F.coalesce(ranked, F.lit(OTHER_LEVEL))


def is_label(c: Column | str) -> Column:
    """True for the three labels; false (never null) for anything else."""
    return F.coalesce(_col(c).isin(*LABELS), F.lit(False))
