"""Outlier removal with sequential interquartile fences.

Each column's quartiles are taken over the rows that passed the fences before it, so the bounds
cost one pass per column. The bounds are a handful of numbers; they
return to the driver and become literals, which the scan can push down. Give these operators a
stored or staged table, because they read it once per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators import quantiles as q

# The fenced columns in order, and the fence width in interquartile ranges.
FENCE_COLUMNS = ("trip_distance_miles", "fare_amount", "trip_duration_minutes", "avg_speed_mph")
FENCE_WIDTH = 1.5


@dataclass(frozen=True)
class Fence:
    """Bounds of one column, and the rows that reached it. No bounds: nothing is removed."""

    column: str
    rows_before: int
    q1: float | None = None
    q3: float | None = None

    @property
    def active(self) -> bool:
        return self.q1 is not None

    @property
    def lower(self) -> float | None:
        return self.q1 - FENCE_WIDTH * (self.q3 - self.q1) if self.active else None

    @property
    def upper(self) -> float | None:
        return self.q3 + FENCE_WIDTH * (self.q3 - self.q1) if self.active else None


def apply_fences(table: DataFrame, fences: Sequence[Fence]) -> DataFrame:
    """Keep rows inside every fence, bounds included; null and NaN fall outside."""
    for fence in fences:
        if fence.active:
            table = table.where(F.col(fence.column).between(fence.lower, fence.upper))
    return table


def compute_fences(
    table: DataFrame,
    columns: Sequence[str] = FENCE_COLUMNS,
    mode: str = "approx",
    relative_error: float = 0.01,
) -> list[Fence]:
    """Fences in column order, each over the remainder of the previous ones.

    ``approx`` uses a sketch with the given relative error, ``exact`` the discrete quartiles.
    A column without any usable value gets no bounds.
    """
    if mode not in ("approx", "exact"):
        raise ValueError(f"mode must be 'approx' or 'exact', not {mode!r}")
    narrow = table.select(*columns)
    fences: list[Fence] = []
    for column in columns:
        rest = apply_fences(narrow, fences)
        if mode == "exact":
            found = q.exact_quantiles(rest, column)
        else:
            found = q.approx_quantiles(rest, column, relative_error=relative_error)
        fences.append(Fence(column, found.rows, *found.values))
    return fences


def remove_outliers(
    table: DataFrame,
    columns: Sequence[str] = FENCE_COLUMNS,
    mode: str = "approx",
    relative_error: float = 0.01,
) -> DataFrame:
    return apply_fences(table, compute_fences(table, columns, mode, relative_error))


def quartile_table(
    table: DataFrame, columns: Sequence[str] = FENCE_COLUMNS, mode: str = "exact"
) -> DataFrame:
    """Quartiles of each column over the whole table, without any fence: all columns at once."""
    compute = q.exact_quantiles_of if mode == "exact" else q.approx_quantiles_of
    found = compute(table, columns)
    rows = [(column, *(found[column].values or (None, None))) for column in columns]
    return table.sparkSession.createDataFrame(rows, "column_name string, q1 double, q3 double")


def outlier_report(
    table: DataFrame, columns: Sequence[str] = FENCE_COLUMNS, mode: str = "approx"
) -> DataFrame:
    """One row per fence: bounds and the rows before it, after it and removed by it."""
    fences = compute_fences(table, columns, mode)
    left = apply_fences(table, fences).count()
    before = [fence.rows_before for fence in fences] + [left]
    rows = [
        (
            position + 1,
            fence.column,
            fence.lower,
            fence.upper,
            before[position],
            before[position + 1],
            before[position] - before[position + 1],
        )
        for position, fence in enumerate(fences)
    ]
    return table.sparkSession.createDataFrame(
        rows,
        "fence_order int, column_name string, lower_bound double, upper_bound double, "
        "rows_before bigint, rows_after bigint, rows_removed bigint",
    )
