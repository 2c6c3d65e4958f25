"""Null profiles and SQL rules, all columns and all rules in one pass over the data.

``null_profile`` and ``rule_report`` give DataFrames with one row per column or rule and scan whatever
frame they are given. ``quality_metrics``, ``validation_report`` and ``inspect`` run at once and
return dicts; by default they look at a small sample.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from typing import Any, NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit.functions.rules import Rule, breaks, percentage, tests_membership, usable_rules
from stratakit.operators.membership import Membership, as_membership, mark_members
from stratakit.operators.sampling import SAMPLE_LIMIT, SAMPLE_RATIO, sample_bernoulli
from stratakit.sources.tables import TableStore

HIGH_NULL_PERCENT = 5

Rules = Iterable[Mapping[str, str]] | None


class Counts(NamedTuple):
    rows: int
    nulls: list[int]
    failing: list[int]
    unknown: list[int]


# ---- one row of counts ---------------------------------------------------------------------------


def _flags(
    df: DataFrame, rules: list[Rule], nulls: bool, marks: Mapping[Rule, Membership]
) -> tuple[DataFrame, list[Column]]:
    """The frame under positional names, and boolean columns: nulls, failing rules, unknown rules.

    Positional names keep dotted, back-quoted and repeated column names out of the way. Rules that test a membership
    are mark joins, on top of the one scan that gives all columns and the other rules.
    """
    width = len(df.columns)
    outcomes = [marks[r].value if r in marks else F.expr(r.condition) for r in rules]
    frame = df.select("*", *[o.alias("rule") for o in outcomes]) if rules else df
    frame = frame.toDF(*[f"c{i}" for i in range(width)], *[f"r{i}" for i in range(len(rules))])
    for i, rule in enumerate(rules):
        if rule in marks:
            frame = mark_members(frame, f"r{i}", marks[rule].members, negated=marks[rule].negated)
    flags = [F.col(f"c{i}").isNull() for i in range(width)] if nulls else []
    flags += [~F.col(f"r{i}") for i in range(len(rules))]
    flags += [F.col(f"r{i}").isNull() for i in range(len(rules))]
    return frame, flags


def _by_price(df: DataFrame, rules: list[Rule]) -> tuple[list[Rule], dict[Rule, Membership]]:
    """The rules that one scan can answer together, and those of them that are memberships."""
    together, marks = [], {}
    for rule in rules:
        if not tests_membership(df, rule):
            together.append(rule)
        elif (mark := as_membership(df, rule.condition)) is not None:
            together.append(rule)
            marks[rule] = mark
    return together, marks


def flagged(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, list[Column]]:
    """The frame under the names c0, c1 and so on, and a column for each rule that is true where a row breaks it."""
    together, marks = _by_price(df, rules)
    if other := [rule.name for rule in rules if rule not in together]:
        raise ValueError(f"rules {other} hold a subquery amid other tests, which only a filter answers")
    frame, flags = _flags(df, rules, False, marks)
    return frame, flags[: len(rules)]


def _totals(
    df: DataFrame, rules: list[Rule], nulls: bool, limit: int | None = None, marks: Mapping[Rule, Membership] | None = None
) -> DataFrame:
    """One row: ``n`` and one count per flag, ``f0``, ``f1`` and so on.

    A limit applies to the booleans, so no row of the data has to pass it.
    """
    frame, flags = _flags(df, rules, nulls, marks or {})
    frame = frame.select(*[flag.alias(f"f{i}") for i, flag in enumerate(flags)])
    if limit is not None:
        frame = frame.limit(limit)
    counts = [F.count_if(F.col(f"f{i}")).alias(f"f{i}") for i in range(len(flags))]
    return frame.agg(F.count(F.lit(1)).alias("n"), *counts)


def _membership_totals(df: DataFrame, rule: Rule) -> DataFrame:
    """The same row as ``_totals`` for one rule with ``IN (<subquery>)`` amid other tests, which only filters treat right."""
    seen = (
        df.select(F.lit("row").alias("kind"))
        .unionAll(df.where(breaks(rule.condition)).select(F.lit("failing")))
        .unionAll(df.where(F.expr(rule.condition)).select(F.lit("passing")))
    )
    n, failing, passing = (F.count_if(F.col("kind") == k) for k in ("row", "failing", "passing"))
    return seen.agg(n.alias("n"), failing.alias("f0"), (n - failing - passing).alias("f1"))


def _count(
    df: DataFrame, rules: list[Rule], nulls: bool, sample_ratio: float | None, limit: int | None
) -> Counts:
    sampled = df if sample_ratio is None else sample_bernoulli(df, sample_ratio)
    capped = sample_ratio is not None and limit is not None
    width = len(df.columns) if nulls else 0
    plain, marks = _by_price(df, rules)
    # Several jobs have to see the same capped sample, also if an executor is lost in between.
    reused = capped and len(plain) < len(rules)
    if reused:
        sampled, limit = sampled.limit(limit).persist(StorageLevel.MEMORY_AND_DISK_2), None
    try:
        size, *counts = _totals(sampled, plain, nulls, limit if capped else None, marks).first()
        split = width + len(plain)
        failing = dict(zip(plain, counts[width:split]))
        unknown = dict(zip(plain, counts[split:]))
        for rule in rules:
            if rule not in failing:
                _, failing[rule], unknown[rule] = _membership_totals(sampled, rule).first()
    finally:
        if reused:
            sampled.unpersist()
    return Counts(size, counts[:width], [failing[r] for r in rules], [unknown[r] for r in rules])


# ---- DataFrame reports ---------------------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, rows looked at, nulls and null percentage."""
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.col("n").alias("sample_size"),
            F.col(f"f{i}").alias("null_count"),
        )
        for i, name in enumerate(df.columns)
    ]
    profile = _totals(df, [], nulls=True).select(F.inline(F.array(*entries)))
    return profile.withColumn("null_pct", percentage(F.col("null_count"), F.col("sample_size")))


def stored_null_profile(store: TableStore, table: str, version: int | None = None) -> DataFrame:
    """The null profile of a stored version, from the counts that its writes have kept: no scan of the data.

    Counts of nulls add up over writes, so an append costs a small file more and nothing else.
    """
    profile = store.null_counts(table, version).select(
        "position", "column_name", F.col("rows").alias("sample_size"), F.col("nulls").alias("null_count")
    )
    return profile.withColumn("null_pct", percentage(F.col("null_count"), F.col("sample_size")))


def high_null_columns(profile: DataFrame, threshold: float = HIGH_NULL_PERCENT) -> DataFrame:
    """Rows of a null profile above the threshold (strictly)."""
    return profile.where(F.col("null_pct") > threshold)


def _rule_rows(totals: DataFrame, rules: list[Rule]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(rule.name).alias("rule_name"),
            F.lit(rule.description).alias("description"),
            F.col("n").alias("sample_size"),
            F.col(f"f{i}").alias("failing_count"),
            F.col(f"f{i + len(rules)}").alias("unknown_count"),
        )
        for i, rule in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*entries)))


def rule_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule. Rows whose condition is NULL pass, and are counted apart as unknown."""
    usable = usable_rules(rules)
    if not usable:
        return df.sparkSession.createDataFrame(
            [],
            "rule_name string, description string, sample_size long, failing_count long,"
            " unknown_count long, failing_pct double, passed boolean",
        )
    together, marks = _by_price(df, usable)
    reports = [_rule_rows(_totals(df, together, nulls=False, marks=marks), together)] if together else []
    reports += [_rule_rows(_membership_totals(df, rule), [rule]) for rule in usable if rule not in together]
    report = reduce(DataFrame.unionAll, reports)
    return report.withColumns(
        {
            "failing_pct": percentage(F.col("failing_count"), F.col("sample_size")),
            "passed": F.col("failing_count") == 0,
        }
    )


def rules_all_passed(report: DataFrame) -> DataFrame:
    """One row: whether every rule passed. True when there are no rules."""
    return report.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"))


def failing_rows(df: DataFrame, condition: str) -> DataFrame:
    return df.where(breaks(condition))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.count(F.lit(1)).alias("row_count"),
    )


def approx_shape(df: DataFrame, timeout_seconds: float = 10.0, confidence: float = 0.95) -> DataFrame:
    """One row: the columns and, after so many seconds at most, the rows, with bounds and whether the count is exact.

    No column is read, so a plain Parquet scan only looks at footers and mostly ends in time. If time runs out, the
    tasks that are done by then give an estimate and an interval of the given confidence, and the rest is cancelled.
    """
    session = df.sparkSession
    context, tag = session.sparkContext, f"shape-{uuid.uuid4().hex}"
    context.addJobTag(tag)
    try:
        rows = df.select()._jdf.queryExecution().toRdd()
        result = rows.countApprox(int(timeout_seconds * 1000), confidence)
        exact, found = result.isInitialValueFinal(), result.initialValue()
        if not exact:
            context.cancelJobsWithTag(tag)
    finally:
        context.removeJobTag(tag)
    # Without any finished task the interval has no upper end.
    mean, low, high = (x if math.isfinite(x) else None for x in (found.mean(), found.low(), found.high()))
    values = [len(df.columns), *[None if x is None else round(x) for x in (mean, low, high)], exact]
    return session.createDataFrame([values], "column_count long, row_count long, low long, high long, is_exact boolean")


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, whether it may be NULL, and how many values it has.

    The values are counted in one scan, all columns at once.
    """
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(field.nullable).alias("nullable"),
            (F.col("n") - F.col(f"f{i}")).alias("value_count"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return _totals(df, [], nulls=True).select(F.inline(F.array(*entries)))


# ---- dict reports --------------------------------------------------------------------------------


def _percent(part: int, total: int) -> float:
    return part / total * 100 if total > 0 else 0.0


def _quality_dict(
    df: DataFrame, layer_name: str, counts: Counts, row_count: int, sample_ratio: float | None, limit: int | None
) -> dict[str, Any]:
    shares = {c: _percent(n, counts.rows) for c, n in zip(df.columns, counts.nulls)}
    return {
        "layer": layer_name,
        "shape": f"[{len(df.columns)},{row_count}]",
        "column_count": len(df.columns),
        "row_count": row_count,
        "schema": df.schema.simpleString(),
        "sample_size": counts.rows,
        "null_percentages": shares,
        "high_null_columns": {c: p for c, p in shares.items() if p > HIGH_NULL_PERCENT},
        **_sampling(counts, sample_ratio, limit),
        "timestamp": datetime.now().isoformat(),
    }


def _sampling(counts: Counts, sample_ratio: float | None, limit: int | None) -> dict[str, Any]:
    """What the counts rest on: all rows, or a sample that its cap may have cut."""
    limit = None if sample_ratio is None else limit
    return {"sample_ratio": sample_ratio, "sample_limit": limit, "cap_reached": limit is not None and counts.rows >= limit}


def _validation_dict(
    rules: list[Rule], counts: Counts, sample_ratio: float | None, limit: int | None
) -> dict[str, Any]:
    results = {
        rule.name: {
            "description": rule.description,
            "failing_count": failing,
            "failing_percentage": _percent(failing, counts.rows),
            "unknown_count": unknown,
            "passed": failing == 0,
        }
        for rule, failing, unknown in zip(rules, counts.failing, counts.unknown)
    }
    return {
        "validation_results": results,
        "sample_size": counts.rows,
        **_sampling(counts, sample_ratio, limit),
        "timestamp": datetime.now().isoformat(),
        "all_passed": all(result["passed"] for result in results.values()),
    }


def _row_count(df: DataFrame, counts: Counts, sample_ratio: float | None, known: int | None) -> int:
    if known is not None:
        return known
    return counts.rows if sample_ratio is None else df.count()


def quality_metrics(
    df: DataFrame,
    layer_name: str,
    sample_ratio: float | None = SAMPLE_RATIO,
    limit_sample_size: int | None = SAMPLE_LIMIT,
    row_count: int | None = None,
) -> dict[str, Any]:
    """Null percentages of a sample; of all rows if ``sample_ratio`` is None.

    ``row_count`` is the size of the frame if the caller knows it; else it is counted.
    """
    counts = _count(df, [], True, sample_ratio, limit_sample_size)
    rows = _row_count(df, counts, sample_ratio, row_count)
    return _quality_dict(df, layer_name, counts, rows, sample_ratio, limit_sample_size)


def validation_report(
    df: DataFrame,
    rules: Rules,
    sample_ratio: float | None = SAMPLE_RATIO,
    limit_sample_size: int | None = SAMPLE_LIMIT,
) -> dict[str, Any]:
    """Failing rows per rule in a sample; in all rows if ``sample_ratio`` is None."""
    usable = usable_rules(rules)
    counts = _count(df, usable, False, sample_ratio, limit_sample_size)
    return _validation_dict(usable, counts, sample_ratio, limit_sample_size)


def inspect(
    df: DataFrame,
    layer_name: str,
    rules: Rules,
    sample_ratio: float | None = SAMPLE_RATIO,
    limit_sample_size: int | None = SAMPLE_LIMIT,
    row_count: int | None = None,
) -> tuple[dict[str, Any], dict[str, Any]]:
    """Null percentages and rule results from the same rows, in one job."""
    usable = usable_rules(rules)
    counts = _count(df, usable, True, sample_ratio, limit_sample_size)
    rows = _row_count(df, counts, sample_ratio, row_count)
    return (
        _quality_dict(df, layer_name, counts, rows, sample_ratio, limit_sample_size),
        _validation_dict(usable, counts, sample_ratio, limit_sample_size),
    )
