"""Incremental counts over the trailing window (AGG-1, JON-3).

Each batch of arrived activities is counted once by employee and day; the counts of a
window follow from those of the window before it: the days that arrived are added
and the days that left are subtracted.  A late activity of an old day is one more
row of its batch.  A run reads its own batch, the days that left (pushed down to
the row groups, as a batch lies sorted by day) and the counts of the run before.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import TableStore

COUNTS = "marts.window_counts"
STATE = "marts.window_state"
STATE_SCHEMA = "window_from date, batches array<string>"


def day_counts(activities: DataFrame, key: str = "id_employee", ts_col: str = "start_dt") -> DataFrame:
    """(day, key, n): activities by employee and day (partially aggregated, a hot employee is a row a day and task)."""
    return activities.groupBy(F.to_date(ts_col).alias("day"), key).agg(F.count(F.lit(1)).alias("n"))


def slide(previous: DataFrame | None, arrived: DataFrame, known: DataFrame | None, old_from: dt.date | None,
          new_from: dt.date, key: str = "id_employee") -> DataFrame:
    """(key, activity_count) of the window from ``new_from`` on."""
    parts = arrived.filter(F.col("day") >= new_from).select(key, "n")
    if previous is not None:
        left = known.filter((F.col("day") >= old_from) & (F.col("day") < new_from))
        parts = (parts.unionByName(previous.select(key, F.col("activity_count").alias("n")))
                 .unionByName(left.select(key, (-F.col("n")).alias("n"))))
    return parts.groupBy(key).agg(F.sum("n").alias("activity_count")).filter("activity_count > 0")


def advance(store: TableStore, arrived: DataFrame, as_of: dt.datetime, batch: str, window_days: int = 365) -> DataFrame:
    """One run: count the batch of ``arrived`` activities, slide the window to ``as_of``
    and publish the counts.  A run repeated under the same batch name writes the same
    again; a batch that was already counted raises."""
    start = as_of - dt.timedelta(days=window_days)
    if start != dt.datetime.combine(start.date(), dt.time()):
        raise ValueError(f"a window of whole days starts at midnight, not at {start}")
    state = store.read(STATE).first() if store.exists(STATE) else None
    if state and batch in state.batches:
        raise ValueError(f"batch {batch} is already counted")
    if state and start.date() < state.window_from:
        raise ValueError(f"the window starts at {state.window_from}; earlier days are gone")
    folder = store.folder("marts.employee_days", "batches")
    (day_counts(arrived).filter(F.col("day") >= start.date()).repartitionByRange("day").sortWithinPartitions("day")
     .write.mode("overwrite").parquet(f"{folder}/batch={batch}"))
    days = store.spark.read.parquet(folder)
    counts = slide(store.read(COUNTS) if state else None, days.filter(F.col("batch") == batch),
                   days.filter(F.col("batch").isin(state.batches)) if state else None,
                   state.window_from if state else None, start.date())
    store.write(counts, COUNTS)
    store.write(store.spark.createDataFrame([(start.date(), [*(state.batches if state else []), batch])], STATE_SCHEMA), STATE)
    return store.read(COUNTS)
