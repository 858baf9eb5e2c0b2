"""Check compiler: a list of rules becomes a handful of aggregates over one table.

All row, null and count rules of a table share **one** aggregation pass.  Uniqueness rules
share one chain of pre-aggregated groupings per family of nested keys.  Reference rules become
anti joins on pre-aggregated keys.  The result is a lazy DataFrame with one row per rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritill.functions import as_timestamp
from veritill.model import RESULTS
from veritill.operators.enrich import orphan_count


@dataclass(frozen=True)
class Verdict:
    """How a rule reads its measures; plain values become literals."""

    passed: Column | bool
    severity: Column | str
    message: Column | str
    rows: Column | int = 0
    metric: Column | float | None = None
    threshold: float | None = None
    details: Mapping[str, Column | str] = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    """One check: ``judge`` gets the total rows and the rule's measures as columns."""

    check: str
    table: str
    judge: Callable[[Column, Mapping[str, Column]], Verdict]
    measures: Mapping[str, Column] = field(default_factory=dict)
    #: Uniqueness rules: key columns whose surplus rows are measured as ``surplus``.
    unique: tuple[str, ...] = ()
    #: Reference rules: (dimension, fact key, dimension key), measured as ``orphans``.
    reference: tuple[DataFrame, str, str] | None = None
    #: Text of a passing and a failing result.
    labels: tuple[str, str] = ("PASS", "FAIL")


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _details(details: Mapping[str, Column | str]) -> Column:
    pairs = [c for k, v in details.items() for c in (F.lit(k), _col(v).cast("string"))]
    return F.create_map(*pairs).cast("map<string,string>")


def result_struct(position: int, stage: str, rule: Rule, verdict: Verdict, run_date, as_of) -> Column:
    """A result row as a struct of exactly the fields of ``RESULTS``."""
    passed = _col(verdict.passed)
    values = {
        "run_date": _col(run_date),
        "stage": F.lit(stage),
        "position": F.lit(position),
        "table": F.lit(rule.table),
        "check": F.lit(rule.check),
        "status": F.when(passed, F.lit(rule.labels[0])).otherwise(F.lit(rule.labels[1])),
        "passed": passed,
        "severity": _col(verdict.severity),
        "message": _col(verdict.message),
        "rows_affected": _col(verdict.rows),
        "metric_value": _col(verdict.metric),
        "threshold": _col(verdict.threshold),
        "details": _details(verdict.details),
        "checked_at": as_timestamp(as_of),
    }
    fields = [part for f in RESULTS.fields for part in (F.lit(f.name), values[f.name])]
    return F.named_struct(*fields).cast(RESULTS)


def _rows(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*structs)))


def surplus_rows(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """One row with ``surplus_0..n``: rows beyond the first per key, nulls equal to each other.

    ``keys`` run from the longest to the shortest and each holds the next, so every grouping
    reads the previous one's groups instead of the table.
    """
    count = F.count(F.lit(1))
    level = df.groupBy(*keys[0]).agg(count.alias("_n"))
    for i in range(1, len(keys)):
        # rows of the longer key beyond its first, carried along as a sum per shorter key
        carried = [c for c in level.columns if c.startswith("_surplus")]
        level = level.groupBy(*keys[i]).agg(
            F.sum("_n").alias("_n"),
            *[F.sum(c).alias(c) for c in carried],
            F.sum(F.col("_n") - 1).alias(f"_surplus{i - 1}"),
        )
    last = len(keys) - 1
    totals = [F.coalesce(F.sum(f"_surplus{i}"), F.lit(0)).alias(f"surplus_{i}") for i in range(last)]
    return level.agg(*totals, F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(f"surplus_{last}"))


def _key_chains(rules: Iterable[tuple[int, Rule]]) -> list[list[tuple[int, Rule]]]:
    """Group uniqueness rules into chains of nested keys, longest first."""
    chains: list[list[tuple[int, Rule]]] = []
    for item in sorted(rules, key=lambda r: -len(r[1].unique)):
        keys = set(item[1].unique)
        home = next((c for c in chains if keys <= set(c[-1][1].unique)), None)
        if home is None:
            chains.append([item])
        else:
            home.append(item)
    return chains


def run_rules(df: DataFrame, rules: Sequence[Rule], stage: str, as_of, run_date=None, offset: int = 0) -> DataFrame:
    """Results of ``rules`` over ``df`` under the ``RESULTS`` schema, one row per rule."""
    placed = list(enumerate(rules, start=offset))
    parts: list[DataFrame] = []

    fused = [(i, r) for i, r in placed if not r.unique and r.reference is None]
    if fused:
        measures = [
            expr.alias(f"m{i}_{name}") for i, rule in fused for name, expr in rule.measures.items()
        ]
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), *measures)
        structs = []
        for i, rule in fused:
            seen = {name: F.col(f"m{i}_{name}") for name in rule.measures}
            structs.append(result_struct(i, stage, rule, rule.judge(F.col("n_rows"), seen), run_date, as_of))
        parts.append(_rows(one, structs))

    for chain in _key_chains([(i, r) for i, r in placed if r.unique]):
        one = surplus_rows(df, [rule.unique for _, rule in chain])
        structs = [
            result_struct(
                i, stage, rule, rule.judge(F.lit(None), {"surplus": F.col(f"surplus_{n}")}), run_date, as_of
            )
            for n, (i, rule) in enumerate(chain)
        ]
        parts.append(_rows(one, structs))

    for i, rule in placed:
        if rule.reference is not None:
            dim, key, dim_key = rule.reference
            one = orphan_count(df, dim, key, dim_key)
            verdict = rule.judge(F.lit(None), {"orphans": F.col("orphan_count")})
            parts.append(_rows(one, [result_struct(i, stage, rule, verdict, run_date, as_of)]))

    return union_results(parts)


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    return results


# --------------------------------------------------------------------------- result tables
def validation_table(results: DataFrame) -> DataFrame:
    """The flat table of validation results."""
    return results.select("run_date", "check", "status", "severity", "message", "rows_affected", "checked_at")


def dq_table(results: DataFrame) -> DataFrame:
    """Q9: the flat table of quality results, as kept in the history."""
    return results.select(
        "run_date", "table", "check", "status", "severity", "message", "rows_affected", "checked_at"
    )


def anomaly_table(results: DataFrame) -> DataFrame:
    """The flat table of detector results."""
    return results.select(
        "run_date",
        F.col("check").alias("detector"),
        F.col("status").alias("label"),
        (~F.col("passed")).alias("triggered"),
        "severity",
        "message",
        "metric_value",
        "threshold",
        F.col("checked_at").alias("detected_at"),
    )
