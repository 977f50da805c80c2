"""Month arithmetic on ``YYYY-MM`` strings and the feature windows."""

from __future__ import annotations

from dataclasses import dataclass

# Months back of each trailing window, and of the newest month of
# each season; a season spans three months.
TRAILING_MONTHS = (1, 2, 3, 5, 7, 12, 20, 23)
SEASON_MONTHS = (1, 12)
SEASON_LENGTH = 3


def month_number(month: str) -> int:
    """Months since year 0."""
    return int(month[:4]) * 12 + int(month[5:]) - 1


def month_number_sql(column: str) -> str:
    return f"(int(substring({column}, 1, 4)) * 12 + int(substring({column}, 6, 2)) - 1)"


def shift_month(month: str, months: int) -> str:
    year, number = divmod(month_number(month) + months, 12)
    return f"{year:04d}-{number + 1:02d}"


@dataclass(frozen=True)
class MonthRange:
    """Months ``first <= m < until``; ``first=None`` means all history."""

    name: str
    first: str | None
    until: str


def cutoffs(month: str) -> dict[str, str]:
    """Cutoff of each split: the test split labels the target month, the train
    split the month before it."""
    return {"train": shift_month(month, -1), "test": month}


def trailing_windows(cutoff: str) -> list[MonthRange]:
    return [
        MonthRange(str(i), shift_month(cutoff, -back), cutoff)
        for i, back in enumerate(TRAILING_MONTHS)
    ]


def seasons(cutoff: str) -> list[MonthRange]:
    return [
        MonthRange(
            f"season{i}",
            shift_month(cutoff, -(back + SEASON_LENGTH - 1)),
            shift_month(cutoff, 1 - back),
        )
        for i, back in enumerate(SEASON_MONTHS)
    ]
