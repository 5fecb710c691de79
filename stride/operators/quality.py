"""Data-quality rules, suites and gates (QLT-1..18).

Every row-level rule of a suite is a conditional count, and all of them are
computed in ONE aggregate pass over the table (partial aggregation per task,
one row shuffled per task).  Rules that need a grouping (unique) or another
table (foreign key) add one aggregate each.  The report has one row per rule:
``(suite, rule, column_name, element_count, unexpected_count, success)``.

NULL policy: like a SQL CHECK, value rules ignore NULL (only ``not_null``
counts it); a pair rule ignores a row where either side is NULL.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


class QualityError(RuntimeError):
    """A suite or gate failed."""


class ConstraintError(QualityError):
    """Rows that break a table's constraints; they were not published."""

    def __init__(self, table: str, broken: Sequence[tuple]):
        self.table, self.broken = table, list(broken)
        super().__init__(f"{table}: " + ", ".join(f"{rule}({column}): {n} rows" for rule, column, n in broken))


@dataclass(frozen=True)
class Rule:
    """One expectation.  ``kind`` is one of the constructors below."""

    kind: str
    column: str
    args: tuple = ()
    name: str = ""
    parent: DataFrame | None = field(default=None, compare=False, hash=False)

    @property
    def label(self) -> str:
        return self.name or self.kind


# -- constructors ------------------------------------------------------------

def not_null(col: str) -> Rule:                                  # QLT-1
    return Rule("not_null", col)


def unique(*cols: str) -> Rule:                                   # QLT-2 / QLT-16
    return Rule("unique", ",".join(cols), tuple(cols))


def between(col: str, lo, hi) -> Rule:                           # QLT-3
    return Rule("between", col, (lo, hi))


def in_set(col: str, values: Sequence) -> Rule:                   # QLT-4 / QLT-15
    return Rule("in_set", col, tuple(values))


def pair_ge(a: str, b: str) -> Rule:                              # QLT-5
    return Rule("pair_ge", f"{a},{b}", (a, b))


def max_between(col: str, lo, hi) -> Rule:                       # QLT-6
    return Rule("max_between", col, (lo, hi))


def check(name: str, col: str, predicate: Column) -> Rule:        # QLT-13 / QLT-14
    """A CHECK constraint: rows where ``predicate`` is FALSE fail; NULL passes."""
    return Rule("check", col, (predicate,), name=name)


def primary_key(*cols: str) -> list[Rule]:                        # QLT-16
    """Not null and unique, from one grouping on the key (the table is read once)."""
    return [Rule("primary_key", ",".join(cols), tuple(cols))]


def foreign_key(col: str, parent: DataFrame, parent_col: str) -> Rule:   # QLT-17
    return Rule("foreign_key", col, (parent_col,), parent=parent)


# -- evaluation ----------------------------------------------------------------

def _lit(v) -> Column:
    return F.lit(v)


def _violation(r: Rule) -> Column | None:
    """Per-row failure predicate of a row-level rule (TRUE = unexpected)."""
    c = F.col(r.column) if r.kind in ("not_null", "between", "in_set", "max_between", "check") else None
    if r.kind == "not_null":
        return c.isNull()
    if r.kind == "between":
        lo, hi = r.args
        return c.isNotNull() & ~c.between(_lit(lo), _lit(hi))
    if r.kind == "in_set":
        return c.isNotNull() & ~c.isin(*r.args)
    if r.kind == "pair_ge":
        a, b = (F.col(x) for x in r.args)
        return a.isNotNull() & b.isNotNull() & (a < b)
    if r.kind == "check":
        return F.coalesce(~r.args[0], F.lit(False))
    return None


def _element(r: Rule) -> Column:
    """Rows a rule looks at (GE counts all rows for not-null, non-NULL ones otherwise)."""
    if r.kind in ("not_null", "check"):
        return F.count(F.lit(1))
    if r.kind == "pair_ge":
        a, b = r.args
        return F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull())
    return F.count(F.col(r.column))


# -- constraints on write (QLT-13..17) ---------------------------------------------

KEY_KINDS = ("unique", "foreign_key", "primary_key")


def row_measures(rules: Sequence[Rule]) -> list[Column]:
    """Measures for ``DataFrame.observe``: the rows and, for each row rule, its violations."""
    return [F.count(F.lit(1)).alias("n"), *[F.count_if(_violation(r)).alias(f"u{i}") for i, r in enumerate(rules)
                                            if r.kind not in KEY_KINDS]]


def broken_rows(observed: Mapping[str, int], rules: Sequence[Rule]) -> list[tuple]:
    """(rule, column, rows) of the row rules that an observation counted violations of."""
    return [(r.label, r.column, observed[f"u{i}"]) for i, r in enumerate(rules)
            if r.kind not in KEY_KINDS and observed[f"u{i}"]]


def enforced(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """``df`` whose first row that breaks a row rule raises (for plain appends)."""
    keep = F.lit(True)
    for r in rules:
        if r.kind not in KEY_KINDS:
            bad = F.raise_error(F.lit(f"{table}: {r.label}({r.column})")).cast("boolean")
            keep = F.when(_violation(r), bad).otherwise(keep)
    return df.filter(keep) if rules else df


def evaluate(df: DataFrame, rules: Sequence[Rule], suite: str) -> DataFrame:
    """Report rows for ``rules`` over ``df`` (lazy; nothing is collected)."""
    parts: list[DataFrame] = []
    row_rules = [r for r in rules if r.kind not in ("unique", "foreign_key", "primary_key")]
    if row_rules:
        aggs = []
        for i, r in enumerate(row_rules):
            aggs.append(_element(r).alias(f"e{i}"))
            if r.kind == "max_between":
                lo, hi = r.args
                mx = F.max(F.col(r.column))
                aggs.append(F.when(mx.isNull() | mx.between(_lit(lo), _lit(hi)), F.lit(0))
                            .otherwise(F.lit(1)).cast("bigint").alias(f"u{i}"))
            else:
                aggs.append(F.count_if(_violation(r)).alias(f"u{i}"))
        one = df.agg(*aggs)
        entries = [F.struct(F.lit(r.label).alias("rule"), F.lit(r.column).alias("column_name"),
                            F.col(f"e{i}").cast("bigint").alias("element_count"),
                            F.col(f"u{i}").cast("bigint").alias("unexpected_count"))
                   for i, r in enumerate(row_rules)]
        parts.append(one.select(F.inline(F.array(*entries))))
    for r in rules:
        if r.kind == "unique":
            cols = list(r.args)
            present = df.select(*cols).dropna(subset=cols)
            dup = (present.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
                   .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("u"),
                        F.coalesce(F.sum("_n"), F.lit(0)).alias("e")))
            parts.append(dup.select(F.lit(r.label).alias("rule"), F.lit(r.column).alias("column_name"),
                                    F.col("e").cast("bigint").alias("element_count"),
                                    F.col("u").cast("bigint").alias("unexpected_count")))
        elif r.kind == "primary_key":
            cols = list(r.args)
            some = [F.col(c).isNull() for c in cols]
            whole = F.lit(True)
            for null in some:
                whole = whole & ~null
            total = lambda when: F.coalesce(F.sum(F.when(when, F.col("_n"))), F.lit(0)).cast("bigint")
            one = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).agg(
                total(F.lit(True)).alias("e"), total(whole).alias("e_whole"),
                total(whole & (F.col("_n") > 1)).alias("twice"), *[total(null).alias(f"n{i}") for i, null in enumerate(some)])
            entry = lambda rule, col, e, u: F.struct(
                F.lit(rule).alias("rule"), F.lit(col).alias("column_name"), F.col(e).alias("element_count"),
                F.col(u).alias("unexpected_count"))
            parts.append(one.select(F.inline(F.array(
                *[entry("not_null", c, "e", f"n{i}") for i, c in enumerate(cols)], entry("unique", r.column, "e_whole", "twice")))))
        elif r.kind == "foreign_key":
            # one row for each key value before it meets the parents: the child is read once, a hot key is one row
            counts = (df.filter(F.col(r.column).isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("_n")))
            parent = r.parent.select(F.col(r.args[0]).alias(r.column)).distinct().withColumn("_known", F.lit(True))
            both = counts.join(parent, r.column, "left").agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("e"),
                F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("u"))
            parts.append(both.select(F.lit(r.label).alias("rule"), F.lit(r.column).alias("column_name"),
                                     F.col("e").alias("element_count"), F.col("u").alias("unexpected_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(suite).alias("suite"), "rule", "column_name", "element_count",
                      "unexpected_count", (F.col("unexpected_count") == 0).alias("success"))


# -- mergeable suite state (QLT-7) ------------------------------------------------------

def suite_state(df: DataFrame, rules: Sequence[Rule], part: str) -> DataFrame:
    """A row for each value of ``part`` (a day, a load): what the row rules counted there.
    States of different parts merge by sums and maxima, so a rerun reads new parts only."""
    aggs = []
    for i, r in enumerate(rules):
        if r.kind in KEY_KINDS:
            continue
        aggs.append(_element(r).alias(f"e{i}"))
        aggs.append(F.max(r.column).alias(f"m{i}") if r.kind == "max_between" else F.count_if(_violation(r)).alias(f"u{i}"))
    return df.groupBy(part).agg(*aggs)


def key_state(df: DataFrame, key: str, part: str) -> DataFrame:
    """(part, bucket, bits, n): which integer keys a part holds, as bitmaps, and its rows by bucket."""
    return (df.filter(F.col(key).isNotNull()).groupBy(part, F.bitmap_bucket_number(key).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"), F.count(F.lit(1)).alias("n")))


def report_from_state(state: DataFrame, rules: Sequence[Rule], suite: str) -> DataFrame:
    """The report of the row rules from the states of all parts; equal to ``evaluate`` over their rows."""
    kept = [(i, r) for i, r in enumerate(rules) if r.kind not in KEY_KINDS]
    aggs = []
    for i, r in kept:
        aggs.append(F.coalesce(F.sum(f"e{i}"), F.lit(0)).cast("bigint").alias(f"e{i}"))
        if r.kind == "max_between":
            mx = F.max(f"m{i}")
            aggs.append(F.when(mx.isNull() | mx.between(*map(_lit, r.args)), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias(f"u{i}"))
        else:
            aggs.append(F.coalesce(F.sum(f"u{i}"), F.lit(0)).cast("bigint").alias(f"u{i}"))
    entries = [F.struct(F.lit(suite).alias("suite"), F.lit(r.label).alias("rule"), F.lit(r.column).alias("column_name"),
                        F.col(f"e{i}").alias("element_count"), F.col(f"u{i}").alias("unexpected_count")) for i, r in kept]
    return state.agg(*aggs).select(F.inline(F.array(*entries))).withColumn("success", F.col("unexpected_count") == 0)


def unique_from_state(state: DataFrame, key: str, suite: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """The unique rule of an integer key from bitmaps.  Only if some key repeats are ``rows()`` read,
    to count the rows that share one."""
    merged = state.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("keys"), F.sum("n").alias("n"))
    total = merged.agg(F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    one = total.first()
    if one["keys"] != one["n"]:
        return evaluate(rows(), [unique(key)], suite)
    return total.select(F.lit(suite).alias("suite"), F.lit("unique").alias("rule"), F.lit(key).alias("column_name"),
                        F.col("n").cast("bigint").alias("element_count"), F.lit(0).cast("bigint").alias("unexpected_count"),
                        F.lit(True).alias("success"))


def run_suites(suites: Mapping[str, tuple[DataFrame, Sequence[Rule]]],
               report_path: str | None = None, extra_path: str | None = None,
               raise_on_failure: bool = True) -> DataFrame:
    """QLT-7 + SNK-6: evaluate every suite, write the report (and an optional
    second copy) BEFORE raising when any rule failed.  The report is one row
    per rule, so reading its failures on the driver is bounded."""
    report = None
    for name, (df, rules) in suites.items():
        part = evaluate(df, rules, name)
        report = part if report is None else report.unionByName(part)
    # a row per rule: evaluated once, then used by the writes and the check
    report = report.sparkSession.createDataFrame(report.collect(), report.schema)
    for path in (report_path, extra_path):
        if path:
            report.coalesce(1).write.mode("overwrite").json(path)
    if raise_on_failure:
        failed = [f"{r.suite}.{r.rule}({r.column_name})" for r in
                  report.filter(~F.col("success")).select("suite", "rule", "column_name").collect()]
        if failed:
            raise QualityError("quality suites failed: " + ", ".join(failed))
    return report


# -- gates (QLT-8..12) -------------------------------------------------------------

def _gate(name: str, observed: Column, expected: str, ok: Column) -> list[Column]:
    return [F.lit(name).alias("check_name"), observed.cast("bigint").alias("observed"),
            F.lit(expected).alias("expected"), ok.alias("success")]


def gate_not_empty(df: DataFrame, name: str = "row_count") -> DataFrame:          # QLT-8
    n = F.count(F.lit(1))
    return df.agg(*_gate(name, n, "> 0", n > 0))


def gate_min_volume(df: DataFrame, minimum: int = S.MIN_RAW_ACTIVITIES,
                    name: str = "min_volume") -> DataFrame:                      # QLT-9
    n = F.count(F.lit(1))
    return df.agg(*_gate(name, n, f">= {minimum}", n >= minimum))


def gate_same_count(a: DataFrame, b: DataFrame, name: str = "reconciliation") -> DataFrame:  # QLT-10/12
    ca = a.agg(F.count(F.lit(1)).alias("_a"))
    cb = b.agg(F.count(F.lit(1))).scalar()
    return ca.select(*_gate(name, cb, "= reference count", F.col("_a") == cb))


def gate_no_future(df: DataFrame, ts_col: str, as_of: dt.datetime,
                   name: str = "no_future_rows") -> DataFrame:                    # QLT-11
    bad = F.count_if(F.col(ts_col) > F.lit(as_of).cast("timestamp_ntz"))
    return df.agg(*_gate(name, bad, "= 0", bad == 0))


GATES: dict[str, Callable[..., DataFrame]] = {
    "not_empty": gate_not_empty,
    "min_volume": gate_min_volume,
    "same_count": gate_same_count,
    "no_future": gate_no_future,
}


def run_gate(check_name: str, *args, raise_on_failure: bool = True, **kw) -> DataFrame:
    """QLT-18: named check dispatch; an unknown name is an error; a failing gate
    raises after its one-row outcome is computed."""
    if check_name not in GATES:
        raise KeyError(f"unknown check {check_name!r}; known: {sorted(GATES)}")
    out = GATES[check_name](*args, **kw)
    if raise_on_failure:
        row = out.first()
        if not row["success"]:
            raise QualityError(f"check {check_name} failed: observed {row['observed']}, expected {row['expected']}")
    return out


# -- the named checks of a run (QLT-18): written tables against each other -----------

def check_employees_loaded(read, as_of) -> list[DataFrame]:
    return [gate_not_empty(read("staging.employees"), "employees_loaded")]


def check_sports_practice_loaded(read, as_of) -> list[DataFrame]:
    return [gate_not_empty(read("staging.sports_practice"), "sports_practice_loaded")]


def check_activities_generated(read, as_of) -> list[DataFrame]:
    return [gate_min_volume(read("raw.activities")),
            gate_same_count(read("raw.activities"), read("staging.activities")),
            gate_no_future(read("staging.activities"), "start_dt", as_of)]


def check_advantages_computed(read, as_of) -> list[DataFrame]:
    return [gate_same_count(read("staging.employees"), read("marts.eligibility_prime"), "coverage_prime"),
            gate_same_count(read("staging.employees"), read("marts.eligibility_wellbeing"), "coverage_wellbeing")]


CHECKS: dict[str, Callable[..., list[DataFrame]]] = {
    "employees_loaded": check_employees_loaded,
    "sports_practice_loaded": check_sports_practice_loaded,
    "activities_generated": check_activities_generated,
    "advantages_computed": check_advantages_computed,
}


def run_check(name: str, read: Callable[[str], DataFrame], as_of: dt.datetime,
              raise_on_failure: bool = True) -> DataFrame:
    """The outcome rows (check_name, observed, expected, success) of a named
    check on the tables that ``read`` returns; an unknown name is an error."""
    if name not in CHECKS:
        raise KeyError(f"unknown check {name!r}; known: {sorted(CHECKS)}")
    gates = CHECKS[name](read, as_of)
    out = gates[0]
    for g in gates[1:]:
        out = out.unionByName(g)
    if raise_on_failure:
        bad = [f"{r.check_name}: observed {r.observed}, expected {r.expected}" for r in out.collect() if not r.success]
        if bad:
            raise QualityError(f"check {name} failed: " + "; ".join(bad))
    return out
