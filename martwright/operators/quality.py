"""Data-quality checks that return violations as rows."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``name`` with one of: a row predicate, a unique key, or a foreign key."""

    name: str
    check: Column | None = None
    unique: tuple[str, ...] = ()
    foreign: tuple[str, DataFrame, str] | None = None
    severity: str = "FAIL"


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"{c}_not_null", F.col(c).isNotNull()) for c in columns]


def in_range(column: str, low=None, high=None) -> Rule:
    tests = []
    if low is not None:
        tests.append(F.col(column) >= low)
    if high is not None:
        tests.append(F.col(column) <= high)
    return Rule(f"{column}_check", functools.reduce(lambda a, b: a & b, tests))


def max_length(column: str, size: int) -> Rule:
    return Rule(f"{column}_length", F.char_length(F.col(column)) <= size)


class QualityError(ValueError):
    """A FAIL rule has violations."""


def check_constraints(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, severity, violations)`` for every rule.

    Row predicates are counted together in one pass. As in SQL a CHECK that
    evaluates to NULL passes.
    """
    row_rules = [r for r in rules if r.check is not None]
    parts = []
    if row_rules:
        counted = df.agg(
            *[F.count(F.when(~r.check, 1)).alias(f"_{i}") for i, r in enumerate(row_rules)]
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.lit(r.severity).alias("severity"),
                    F.col(f"_{i}").alias("violations"),
                )
                for i, r in enumerate(row_rules)
            ]
        )
        parts.append(counted.select(F.inline(rows)))
    for rule in rules:
        if rule.unique:
            repeated = df.groupBy(*rule.unique).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            parts.append(_count(repeated, rule))
        elif rule.foreign:
            column, parent, parent_key = rule.foreign
            keys = parent.select(F.col(parent_key).alias(column))
            orphans = df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")
            parts.append(_count(orphans, rule))
    return functools.reduce(DataFrame.unionByName, parts)


def _count(violating: DataFrame, rule: Rule) -> DataFrame:
    return violating.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"), "violations"
    )


def enforce(report: DataFrame) -> DataFrame:
    """Raise if a FAIL rule of a constraint report is violated; return the report otherwise."""
    failed = report.where("severity = 'FAIL' AND violations > 0").collect()
    if failed:
        raise QualityError("; ".join(f"{r['rule']}: {r['violations']}" for r in failed))
    return report
