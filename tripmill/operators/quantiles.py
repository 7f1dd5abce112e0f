"""Discrete quantiles, approximate or exact, of one or several columns.

Both modes return values that occur in the data and ignore null and NaN. The exact value for
probability p is the least one whose cumulative share reaches p.

The exact mode selects by digits of an order-preserving 64-bit key (the bits of the double). A pass counts
the rows of each leading digit; the running counts tell which digit holds a rank, and the next pass looks at
that digit's rows only. A digit whose rows have one value ends the search, so values with few decimals take one or
two passes and no column takes more than ``SHIFTS``. Each pass is one aggregate with map-side partial counts:
nothing is sorted or staged, a hot value is one row a task, and what returns to the driver is bounded by
the number of digits (2**16 for each rank, 2**20 in the first pass).
"""

from __future__ import annotations

import functools
import math
import operator
import struct
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.75)
#: Low bits that each pass leaves open: digits of 20, 16, 16 and 12 bits.
SHIFTS = (44, 28, 12, 0)
#: Beyond every key.
FULL = 1 << 63


@dataclass(frozen=True)
class ColumnQuantiles:
    """``values`` is empty when the column has no usable value; ``rows`` counts all rows."""

    rows: int
    values: tuple[float, ...]


def usable(column: str) -> Column:
    """The value, or null for NaN."""
    return F.when(~F.isnan(F.col(column)), F.col(column).cast("double"))


def approx_quantiles_of(
    table: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    relative_error: float = 0.01,
) -> dict[str, ColumnQuantiles]:
    """Sketched quantiles of all columns in one aggregate."""
    accuracy = math.ceil(1 / relative_error)
    sketches = [
        F.percentile_approx(usable(name), list(probabilities), accuracy).alias(f"q{n}")
        for n, name in enumerate(columns)
    ]
    found = table.agg(F.count(F.lit(1)).alias("rows"), *sketches).first()
    return {
        name: ColumnQuantiles(found["rows"], tuple(found[f"q{n}"] or ()))
        for n, name in enumerate(columns)
    }


def approx_quantiles(
    table: DataFrame,
    column: str,
    probabilities: Sequence[float] = QUARTILES,
    relative_error: float = 0.01,
) -> ColumnQuantiles:
    return approx_quantiles_of(table, [column], probabilities, relative_error)[column]


def order_keys(table: DataFrame, x: str, key: str = "key") -> DataFrame:
    """Adds a bigint that orders like the double and is its bits (negated for negative values); null for NaN.

    Every step is exact: powers of two, divisions by them, and a logarithm that may miss by one. Each is
    a projection of its own, so that none is written out several times in the generated code.
    """
    size, rough, part = F.col("key_size"), F.col("key_rough"), F.col("key_part")
    near = F.greatest(F.least(F.floor(F.log2("key_size")), F.lit(1023)), F.lit(-1022))
    unit = float(1 << 52)
    normal = (
        F.when(part >= 2, (rough + 1023) * (1 << 52) + (part / 2 * unit).cast("bigint"))
        .when(part < 1, (rough + 1021) * (1 << 52) + (part * 2 * unit).cast("bigint"))
        .otherwise((rough + 1022) * (1 << 52) + (part * unit).cast("bigint"))
    )
    bits = (
        F.when(size == float("inf"), F.lit(2047 << 52))
        .when(size < 2.0**-1022, (size * unit / F.lit(2.0**-1022)).cast("bigint"))
        .otherwise(normal)
    )
    steps = table.withColumn("key_size", F.when(~F.isnan(x), F.abs(x)))
    steps = steps.withColumn("key_rough", near)
    steps = steps.withColumn("key_part", F.when(size < float("inf"), size / F.pow(F.lit(2.0), rough)))
    steps = steps.withColumn("key_bits", bits)
    signed = F.when(F.col(x) < 0, -F.col("key_bits")).otherwise(F.col("key_bits"))
    return steps.withColumn(key, signed).drop("key_size", "key_rough", "key_part", "key_bits")


def value_of(key: int) -> float:
    """The double of a key."""
    size = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -size if key < 0 else size


def exact_quantiles_of(
    table: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = QUARTILES
) -> dict[str, ColumnQuantiles]:
    """Exact quantiles of all columns, a digit of all of them in each pass."""
    # With one column, bounds on its value reach the scan.
    pairs = [F.struct(F.lit(n).alias("number"), F.col(name).cast("double").alias("x")) for n, name in enumerate(columns)]
    if len(pairs) > 1:
        values = table.select(F.inline(F.array(*pairs)))
    else:
        values = table.select(F.lit(0).alias("number"), F.col(columns[0]).cast("double").alias("x"))
    rows: dict[int, int] = {}
    found: dict[tuple[int, int], float] = {}  # (column, probability) -> value
    # (column, probability) -> least and greatest key that are left, and the rank among their rows
    open_ranks: dict[tuple[int, int], tuple[int, int, int]] = {}
    for step, shift in enumerate(SHIFTS):
        left = values
        if step:
            held = sorted({(number, low, high) for (number, _), (low, high, _) in open_ranks.items()})
            left = values.where(
                _any((F.col("number") == n) & F.col("x").between(value_of(low), value_of(high)) for n, low, high in held)
            )
        digits = (
            order_keys(left, "x").groupBy("number", F.shiftright("key", shift).alias("digit"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .toArrow()
            .to_pylist()
        )
        digits.sort(key=lambda row: (row["number"], row["digit"] is not None, row["digit"]))
        if not step:
            for number in range(len(columns)):
                own = [row for row in digits if row["number"] == number]
                rows[number] = sum(row["n"] for row in own)
                size = sum(row["n"] for row in own if row["digit"] is not None)
                for p, probability in enumerate(probabilities if size else ()):
                    open_ranks[number, p] = (-FULL, FULL, max(1, math.ceil(probability * size)))
        for (number, p), (low, high, rank) in list(open_ranks.items()):
            for row in digits:
                if row["number"] != number or row["digit"] is None or row["high"] < low or row["low"] > high:
                    continue
                if rank > row["n"]:
                    rank -= row["n"]
                    continue
                if row["low"] == row["high"]:
                    found[number, p] = value_of(row["low"])
                    del open_ranks[number, p]
                else:
                    open_ranks[number, p] = (row["low"], row["high"], rank)
                break
        if not open_ranks:
            break
    return {
        name: ColumnQuantiles(
            rows[number], tuple(found[number, p] for p in range(len(probabilities)) if (number, p) in found)
        )
        for number, name in enumerate(columns)
    }


def _any(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, conditions)


def exact_quantiles(
    table: DataFrame, column: str, probabilities: Sequence[float] = QUARTILES
) -> ColumnQuantiles:
    return exact_quantiles_of(table, [column], probabilities)[column]
