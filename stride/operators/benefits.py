"""Benefit rules: commute bonus and wellbeing days (E2)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..params import BenefitParams
from .staging import trailing_window


def _audit_cols(params: BenefitParams) -> dict:
    return {
        "computed_at": F.lit(params.as_of).cast("timestamp_ntz"),
        "run_id": F.lit(params.run_id),
    }


def prime_columns(params: BenefitParams) -> dict:
    """PRJ-12/13/14 as named columns over a staged employee row."""
    elig = C.prime_eligible("moyen_deplacement", "is_declaration_suspect")
    return {
        "is_eligible": elig,
        "prime_rate": F.lit(params.prime_rate).cast("decimal(5,4)"),
        "prime_amount": C.prime_amount(elig, params.prime_rate, "salaire_brut"),
        "reason": C.prime_reason("moyen_deplacement", "is_declaration_suspect"),
    }


def compute_prime(employees: DataFrame, params: BenefitParams) -> DataFrame:
    """Mart ``eligibility_prime``: one row per employee, narrow (no shuffle)."""
    cols = prime_columns(params)
    return employees.select(
        "id_employee",
        *[v.alias(k) for k, v in cols.items()],
        *[v.alias(k) for k, v in _audit_cols(params).items()],
    )


def activity_counts(activities: DataFrame, as_of: dt.datetime, window_days: int,
                    key: str = "id_employee", ts_col: str = "start_dt") -> DataFrame:
    """AGG-1 input: activities per employee in the trailing window.

    The window filter is pushed to the scan; the count is partially
    aggregated before the shuffle, so a key holding a third of all rows
    sends one row per map task, not its rows.
    """
    recent = trailing_window(activities.select(key, ts_col), ts_col, as_of, window_days)
    return recent.groupBy(key).agg(F.count(F.lit(1)).alias("activity_count"))


def with_activity_count(employees: DataFrame, counts: DataFrame) -> DataFrame:
    """JON-3 + AGG-1: left join keeps zero-count employees (count 0, not NULL)."""
    return (employees.join(counts, "id_employee", "left")
            .withColumn("activity_count", F.coalesce(F.col("activity_count"), F.lit(0)).cast("int")))


def wellbeing_columns(params: BenefitParams) -> dict:
    """PRJ-15 over a row with ``activity_count``."""
    t = int(params.wellbeing_threshold)
    elig = F.col("activity_count") >= F.lit(t)
    return {
        "is_eligible": elig,
        "activity_count": F.col("activity_count"),
        "threshold": F.lit(t).cast("int"),
        "days_granted": F.when(elig, F.lit(params.days_granted)).otherwise(F.lit(0)).cast("int"),
        "reason": C.wellbeing_reason("activity_count", t),
    }


def compute_wellbeing(employees: DataFrame, activities: DataFrame, params: BenefitParams,
                      counts: DataFrame | None = None) -> DataFrame:
    """Mart ``eligibility_wellbeing``: one row per employee.  ``counts``: the window's
    counts where they are kept (``windows.advance``); else ``activities`` are counted."""
    if counts is None:
        counts = activity_counts(activities, params.as_of, params.window_days)
    joined = with_activity_count(employees.select("id_employee"), counts)
    cols = wellbeing_columns(params)
    return joined.select(
        "id_employee",
        *[v.alias(k) for k, v in cols.items()],
        *[v.alias(k) for k, v in _audit_cols(params).items()],
    )


def compute_benefits(employees: DataFrame, activities: DataFrame, params: BenefitParams) -> DataFrame:
    """Both marts fused on the employee row (one scan of employees, one join).

    Columns: the employee's, ``p_*`` (bonus) and ``w_*`` (wellbeing).
    """
    counts = activity_counts(activities, params.as_of, params.window_days)
    joined = with_activity_count(employees, counts)
    p = prime_columns(params)
    w = wellbeing_columns(params)
    return joined.withColumns({
        **{f"p_{k}": v for k, v in p.items()},
        **{f"w_{k}": v for k, v in w.items() if k != "activity_count"},
    })
