"""Exact, interpolated quantiles of columns that are too large for one task.

The built-in exact ``percentile`` gathers every distinct value of a group in one buffer.  Here the input
is scanned twice.  The first scan keeps a mergeable rank sketch per column, whose rank error is at most
one in ``ACCURACY``, and takes from it two values around each wanted rank.  The second scan counts the
rows below these brackets and, value by value, those inside: about four in ``ACCURACY`` rows, stored as
(value, count).  On that small table each rank is closed in on by counting: the values between the
known ends are counted in ``BINS`` equal bins, and the bin that holds the rank gives the next ends.
A rank that its bracket does not hold, whatever the sketch promised, gets the whole range instead.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritill.functions import number
from veritill.session import scratch_dir

BINS = 4096
#: One in so many rows is the rank error of the sketch, and its size per task.
ACCURACY = 10_000


class _Search(NamedTuple):
    column: str
    rank: int
    low: float
    high: float
    below: int


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Place of a value between two ends; halves where the width would not be finite."""
    first, last = max(low, -sys.float_info.max), min(high, sys.float_info.max)
    part = 1 if math.isfinite(last - first) else 2
    share = (value / part - first / part) / (last / part - first / part)
    place = F.greatest(F.lit(0), F.least(F.floor(share * bins), F.lit(bins - 1)))
    # the ends themselves stay apart, so that the range always shrinks
    return F.when(value <= low, F.lit(0)).when(value >= high, F.lit(bins - 1)).otherwise(place)


def _narrowed(numbers: DataFrame, open_: list[_Search], bins: int) -> list[_Search]:
    """One pass over counted values: for each search the bin with its rank becomes the new range."""
    places = []
    for i, search in enumerate(open_):
        value = F.col("value")
        inside = (F.col("column") == search.column) & (value >= search.low) & (value <= search.high)
        place = _bin(value, search.low, search.high, bins)
        places.append(F.when(inside, F.struct(F.lit(i).alias("i"), place.cast("int").alias("bin"))))
    counted = (
        numbers.select("value", "n", F.explode(F.array_compact(F.array(*places))).alias("p"))
        .groupBy("p.i", "p.bin")
        .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    per_search: dict[int, list] = {}
    for row in counted.collect():  # at most BINS rows for each wanted rank
        per_search.setdefault(row["i"], []).append(row)
    found = []
    for i, search in enumerate(open_):
        below = search.below
        for row in sorted(per_search[i], key=lambda r: r["bin"]):
            if search.rank < below + row["n"]:
                found.append(search._replace(low=row["low"], high=row["high"], below=below))
                break
            below += row["n"]
    return found


class Sketch(NamedTuple):
    """First scan of a column: rows, ends, and for each quantile a value below and one above it."""

    n: int
    low: float | None
    high: float | None
    brackets: list[tuple[float, float]]
    #: Further aggregates that were asked for, by name.
    others: dict


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[number(F.col(f"`{c}`"), text=False).alias(c) for c in columns])


def sketched(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float], others: Mapping[str, Callable[[Column], Column]] | None = None
) -> dict[str, Sketch]:
    """The first scan; ``others`` names further aggregates of each column to take from it."""
    margin = 2 / ACCURACY
    ends = [edge for q in quantiles for edge in (max(0.0, q - margin), min(1.0, q + margin))]
    functions = {**_ENDS, **(others or {})}
    aggregates = []
    for i, column in enumerate(columns):
        x = F.col(f"`{column}`")
        aggregates += [f(x).alias(f"{i} {name}") for name, f in functions.items()]
        aggregates.append(F.percentile_approx(x, ends, ACCURACY).alias(f"{i} edges"))
    row = _numbers(df, columns).agg(*aggregates).first()
    found = {}
    for i, column in enumerate(columns):
        low, high, edges = row[f"{i} low"], row[f"{i} high"], row[f"{i} edges"] or []
        # at the outermost ranks the ends themselves
        edges = [low if end == 0 else high if end == 1 else edge for end, edge in zip(ends, edges)]
        rest = {name: row[f"{i} {name}"] for name in others or {}}
        found[column] = Sketch(row[f"{i} n"], low, high, list(zip(edges[::2], edges[1::2])), rest)
    return found


def _inside(df: DataFrame, searches: list[_Search]) -> tuple[DataFrame, dict[_Search, int]]:
    """The second scan: counted values inside the ranges, stored, and the rows below each range."""
    ranges = list(dict.fromkeys((s.column, s.low, s.high) for s in searches))
    columns = list(dict.fromkeys(column for column, *_ in ranges))
    places = []
    for i, (column, low, high) in enumerate(ranges):
        value, mark = F.col(f"`{column}`"), F.lit(i).alias("i")
        # rows below count under no value
        under = F.when(value < low, F.struct(mark, F.lit(None).cast("double").alias("value")))
        places.append(under.when(value <= high, F.struct(mark, value.alias("value"))))
    counted = (
        _numbers(df, columns).select(F.explode(F.array_compact(F.array(*places))).alias("p"))
        .groupBy("p.i", "p.value").agg(F.count(F.lit(1)).alias("n"))
    )
    folder = scratch_dir(df.sparkSession, "quantiles")
    counted.write.parquet(folder)
    stored = df.sparkSession.read.schema(counted.schema).parquet(folder)
    below = {row["i"]: row["n"] for row in stored.where(F.col("value").isNull()).collect()}
    name = F.element_at(F.array(*[F.lit(column) for column, *_ in ranges]), F.col("i") + 1)
    # brackets of one column may overlap: a value is counted once for the column
    values = stored.where(F.col("value").isNotNull()).groupBy(name.alias("column"), "value").agg(F.max("n").alias("n"))
    order = {bounds: i for i, bounds in enumerate(ranges)}
    return values, {s: below.get(order[s.column, s.low, s.high], 0) for s in searches}


def _exact(df: DataFrame, searches: list[_Search], bins: int) -> tuple[dict[tuple[str, int], float], list[_Search]]:
    """Values at the ranks that lie in their ranges, and the searches whose do not."""
    if not searches:
        return {}, []
    values, below = _inside(df, searches)
    tally = F.struct(*[
        F.coalesce(F.sum(F.when((F.col("column") == s.column) & F.col("value").between(s.low, s.high), F.col("n"))), F.lit(0)).alias(str(i))
        for i, s in enumerate(searches)
    ])
    held = values.agg(tally.alias("t")).first()["t"]
    missed = [s for i, s in enumerate(searches) if not below[s] <= s.rank < below[s] + held[str(i)]]
    open_, exact = [s._replace(below=below[s]) for s in searches if s not in missed], {}
    while open_:
        exact.update({(s.column, s.rank): s.low for s in open_ if s.low == s.high})
        open_ = [s for s in open_ if s.low != s.high]
        open_ = _narrowed(values, open_, bins) if open_ else []
    return exact, missed


def quantile_values(
    df: DataFrame, quantiles: Sequence[float], sketches: dict[str, Sketch], bins: int = BINS
) -> dict[tuple[str, float], float]:
    """Value of each column and quantile, from the second scan on."""
    searches, wanted = [], []
    for column, sketch in sketches.items():
        for q, (low, high) in zip(quantiles, sketch.brackets):
            position = q * (sketch.n - 1)
            wanted.append((column, q, position))
            searches += [_Search(column, rank, low, high, 0) for rank in (math.floor(position), math.ceil(position))]
    exact, missed = _exact(df, list(dict.fromkeys(searches)), bins)
    whole = {s: (sketches[s.column].low, sketches[s.column].high) for s in missed}
    exact.update(_exact(df, [s._replace(low=low, high=high) for s, (low, high) in whole.items()], bins)[0])
    found = {}
    for column, q, position in wanted:
        down, up = exact[column, math.floor(position)], exact[column, math.ceil(position)]
        found[column, q] = down if down == up else down + (up - down) * (position - math.floor(position))
    return found


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float], bins: int = BINS
) -> DataFrame:
    """Rows ``(column, quantile, value)``; nulls and NaN are ignored, a column without values has no rows."""
    quantiles = [float(q) for q in quantiles]
    sketches = {c: found for c, found in sketched(df, list(columns), quantiles).items() if found.n}
    values = quantile_values(df, quantiles, sketches, bins)
    rows = [(column, q, value) for (column, q), value in values.items()]
    return df.sparkSession.createDataFrame(rows, "column string, quantile double, value double")


_ENDS = {"n": F.count, "low": F.min, "high": F.max}
