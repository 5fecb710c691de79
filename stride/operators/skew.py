"""Joins whose hot keys are split by hand (JON-2, JON-10), beside adaptive execution.

The rows of the large side are counted by key (a partial aggregate over the key
column); a key that holds more than ``share`` of all rows is hot.  At most
``1 / share`` keys can be hot, so their list is bounded whatever the data.  A hot key's
rows are dealt out over ``pieces`` sub-keys by their row number in the input, and
its rows on the other side are repeated for each sub-key.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(rows: DataFrame, key: str, share: float) -> DataFrame:
    """(key, rows) of the keys with more than ``share`` of all rows; at most ``1 / share`` of them."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("rows") > total * share)


def split_join(large: DataFrame, small: DataFrame, key: str, how: str = "inner", share: float = 0.05,
               pieces: int | None = None) -> DataFrame:
    """``large.join(small, key, how)`` with the hot keys of ``large`` split.

    ``how``: inner, left, left_semi or left_anti (every row of ``large`` meets all rows of
    its key in ``small`` under its sub-key, so these keep their meaning)."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a split join cannot be {how}")
    spark = large.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = [r[key] for r in hot_keys(large, key, share).select(key).limit(math.ceil(1 / share)).collect()]  # at most 1 / share keys
    if not hot:
        return large.join(small, key, how)
    is_hot = F.col(key).isin(hot)
    dealt = large.withColumn("_piece", F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(pieces))).otherwise(F.lit(0)).cast("int"))
    every = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0))))
    return dealt.join(small.withColumn("_piece", every), [key, "_piece"], how).drop("_piece")
