"""Exact distinct counts that merge (AGG-2, AGG-4): bitmaps kept by group and month.

A month's activities are folded once into bitmaps of employee ids (32,768 ids to a
bitmap, so a group's state is bounded by the ids and not by its rows) and into plain
sums.  Any window of months is then an OR of bitmaps and a sum of sums; the rows
are not read again.  A window that starts inside a month reads that month's rows.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .views import exact_avg_km


def month(ts_col: str) -> F.Column:
    return F.trunc(F.col(ts_col).cast("date"), "month")


def bitmaps(rows: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """(group, bucket, bits): the ids that each group holds (NULL ids are not counted)."""
    return (rows.filter(F.col(key).isNotNull())
            .groupBy(*group, F.bitmap_bucket_number(key).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")))


def merged(state: DataFrame, group: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return state.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(state: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """(group, name): distinct ids from bitmaps."""
    return merged(state, group).groupBy(*group).agg(F.sum(F.bitmap_count("bits")).alias(name))


def sport_months(activities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A month's state by sport: sums (month, sport, n, metres, n_metres) and bitmaps (month, sport, bucket, bits)."""
    rows = activities.select(month("start_dt").alias("month"), F.col("sport_type").alias("sport"), "id_employee", "distance_m")
    sums = rows.groupBy("month", "sport").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance_m").cast("bigint")).alias("metres"),
                                              F.count("distance_m").alias("n_metres"))
    return sums, bitmaps(rows, ["month", "sport"], "id_employee")


def activities_by_sport(sums: DataFrame, bits: DataFrame, activities: DataFrame, as_of: dt.datetime, days: int = 365) -> DataFrame:
    """AGG-4 over a trailing window from monthly state: whole months from the state, the
    rows of a month that the window cuts from ``activities``."""
    start = as_of - dt.timedelta(days=days)
    whole = dt.date(start.year, start.month, 1)
    if start != dt.datetime.combine(whole, dt.time()):
        whole = (whole + dt.timedelta(days=32)).replace(day=1)
        cut = activities.filter((F.col("start_dt") >= F.lit(start)) & (F.col("start_dt") < F.lit(dt.datetime.combine(whole, dt.time()))))
        cut_sums, cut_bits = sport_months(cut)
        sums, bits = sums.filter(F.col("month") >= whole).unionByName(cut_sums), bits.filter(F.col("month") >= whole).unionByName(cut_bits)
    else:
        sums, bits = sums.filter(F.col("month") >= whole), bits.filter(F.col("month") >= whole)
    totals = sums.groupBy("sport").agg(F.sum("n").alias("nb_activites"),
                                       exact_avg_km(F.sum("metres"), F.sum("n_metres")).alias("distance_moyenne_km"))
    people = distinct_count(bits, ["sport"], "nb_salaries")
    return (totals.join(people.withColumnRenamed("sport", "_sport"), F.col("sport").eqNullSafe(F.col("_sport")), "left")
            .select("sport", "nb_activites", F.coalesce("nb_salaries", F.lit(0)).alias("nb_salaries"), "distance_moyenne_km"))
