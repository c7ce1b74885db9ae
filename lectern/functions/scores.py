"""Score expressions shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Pass marks of the current and the older marts.
PASS_MARK = 4
PASS_MARK_V1 = 5

# Exact carrier for 4-point scores, so sums do not depend on the order of rows.
SCORE_4 = "decimal(12,6)"


def passed(score: str, mark: float = PASS_MARK) -> Column:
    return F.when(F.col(score) >= mark, 1).otherwise(0)


def pass_rate(n_passed: Column, n_students: Column) -> Column:
    """Percentage as decimal(38,14); NULL where there are no students."""
    return F.try_divide(n_passed * F.lit("100.0").cast("decimal(4,1)"), n_students)


def mean(total: Column, count: Column) -> Column:
    """Average from partial sums; NULL where nothing was counted."""
    return F.try_divide(total, count)


def grade_point_average(weighted: Column, credits: Column) -> Column:
    """Credit-weighted mean rounded half up to two digits, once, from the exact sums; 0
    where no credit counts.  Scores and credits are not negative."""
    millionths = (weighted * 1_000_000).cast("decimal(38,0)")
    count = credits.cast("decimal(38,0)")
    hundredths = F.call_function(
        "div", millionths * 200 + count * 1_000_000, F.nullif(count, F.lit(0)) * 2_000_000)
    return F.coalesce(hundredths, F.lit(0)).cast("double") / 100.0


def score_range(score: str) -> Column:
    """Four unit ranges up to 4; everything else, NULL included, is Unknown."""
    value = F.col(score)
    return (
        F.when(value.between(0, 1), "0-1")
        .when((value > 1) & (value <= 2), "1-2")
        .when((value > 2) & (value <= 3), "2-3")
        .when((value > 3) & (value <= 4), "3-4")
        .otherwise("Unknown")
    )
