"""Upserts, insert-if-absent, key updates and change logs (MRG-*, JON-8/9/10).

Parquet has no row-level MERGE, so every merge is a whole-table rewrite
expressed as joins on the key: the result is a new DataFrame that the
caller writes to a new table version (``sources.store.TableStore``), never
over the path it is reading.  Keys of these tables are primary keys, so the
key joins are one-to-one and shuffle each side once on the key.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import surrogate_key


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None) -> DataFrame:
    """MRG-1/2: insert new keys; on a conflicting key replace ``update_cols``
    (default: every non-key column of ``source``); target rows whose key is
    absent from the source stay as they are.

    One full outer join on the key (each side shuffled once, or not at all
    when already partitioned on it).  A key that the source repeats raises:
    no one row of it could be chosen.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    update = set(update_cols if update_cols is not None else [c for c in source.columns if c not in keys])
    t = target.withColumn("_present", F.lit(True)).alias("t")
    s = source.select(*keys, *[c for c in source.columns if c not in keys]) \
        .withColumn("_present", once(keys)).alias("s")
    j = t.join(s, keys, "full_outer")
    in_s = F.col("s._present").isNotNull()
    in_t = F.col("t._present").isNotNull()
    out = []
    for c in cols:
        if c in update:
            out.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in source.columns:
            # not updated on conflict, but an inserted row takes the source value
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*keys, *out)


def once(keys: Sequence[str]) -> Column:
    """TRUE on a row whose key is its own; raises where a key repeats."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    names = ", ".join(keys)
    return F.when(n == 1, F.lit(True)).otherwise(F.raise_error(F.lit(f"merge source repeats a key ({names})")).cast("boolean"))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MRG-3 (``ON CONFLICT DO NOTHING``): source rows with a new key are added
    once; existing keys keep the target row."""
    keys = list(keys)
    new = (source.select(*target.columns).dropDuplicates(keys)
           .join(target.select(*keys), keys, "left_anti"))
    return target.unionByName(new)


def update_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                  cols: Sequence[str]) -> DataFrame:
    """JON-9: set ``cols`` from ``updates`` where the key matches; unmatched
    target rows keep their values; update keys absent from the target are
    ignored."""
    keys = list(keys)
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols]) \
        .withColumn("_hit", F.lit(True))
    j = target.join(u, keys, "left")
    return j.select(*[
        (F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c))
        for c in target.columns])


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """JON-10 / QLT-17: child rows whose non-NULL foreign key has no parent."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def cache_lookup(requests: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON-8: the requests with the cache columns and ``cache_hit``: one left
    join, both sides read once.  Misses (``not cache_hit``) go on to resolution.  Where the
    cache is large and the requests are a filtered few, Spark's runtime filter
    (``session.configure``) drops the cache rows whose key no request can have right
    after the scan, so what is shuffled falls with the requests."""
    keys = list(keys)
    marked = cache.withColumn("cache_hit", F.lit(True))
    return requests.join(marked, keys, "left").withColumn("cache_hit", F.coalesce("cache_hit", F.lit(False)))


# -- MRG-5: change log -----------------------------------------------------------

def _record(df_alias: str, cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{df_alias}.{c}").alias(c) for c in cols])


def _log_frame(rows: DataFrame, key: str, table_name: str, changed_at: dt.datetime,
               changed_by: str, with_id: bool) -> DataFrame:
    out = rows.select(
        F.lit(changed_at).cast("timestamp_ntz").alias("changed_at"),
        F.lit(changed_by).alias("changed_by"),
        F.lit(table_name).alias("table_name"),
        "operation", F.col(key).alias(key), "old_data", "new_data",
    )
    if with_id:
        out = surrogate_key(out, [key, "operation"], "id")
        out = out.select("id", *[c for c in out.columns if c != "id"])
    return out


def change_log_from_merge(before: DataFrame, source: DataFrame, key: str, table_name: str,
                          changed_at: dt.datetime, changed_by: str,
                          with_id: bool = False) -> DataFrame:
    """Rows a row-level trigger logs for ``upsert(before, source)``: INSERT for
    a new key (old NULL), UPDATE for every conflicting key even when nothing
    changed (the upsert always refreshes its timestamp).  Target keys absent
    from the source are not touched, so they log nothing."""
    cols = [c for c in source.columns]
    b = before.select(*cols).withColumn("_present", F.lit(True)).alias("b")
    s = source.alias("s")
    j = s.join(b, key, "left")
    in_b = F.col("b._present").isNotNull()
    rows = j.select(
        F.col(key),
        F.when(in_b, F.lit("UPDATE")).otherwise(F.lit("INSERT")).alias("operation"),
        F.when(in_b, _record("b", cols)).alias("old_data"),
        _record("s", cols).alias("new_data"),
    )
    return _log_frame(rows, key, table_name, changed_at, changed_by, with_id)


def change_log_from_snapshots(before: DataFrame, after: DataFrame, key: str, table_name: str,
                              changed_at: dt.datetime, changed_by: str,
                              ignore: Sequence[str] = (), with_id: bool = False) -> DataFrame:
    """Diff of two snapshots on ``key``: INSERT (new key), DELETE (key gone),
    UPDATE (record differs under null-safe comparison, ``ignore`` columns
    excluded).  Equal records are left out."""
    cols = [c for c in after.columns]
    cmp_cols = [c for c in cols if c != key and c not in ignore]
    b = before.select(*cols).withColumn("_present", F.lit(True)).alias("b")
    a = after.select(*cols).withColumn("_present", F.lit(True)).alias("a")
    j = b.join(a, key, "full_outer")
    in_b, in_a = F.col("b._present").isNotNull(), F.col("a._present").isNotNull()
    same = F.struct(*[F.col(f"b.{c}") for c in cmp_cols]).eqNullSafe(
        F.struct(*[F.col(f"a.{c}") for c in cmp_cols]))
    op = (F.when(~in_b, F.lit("INSERT"))
           .when(~in_a, F.lit("DELETE"))
           .when(~same, F.lit("UPDATE")))
    rows = j.select(
        F.col(key), op.alias("operation"),
        F.when(in_b, _record("b", cols)).alias("old_data"),
        F.when(in_a, _record("a", cols)).alias("new_data"),
    ).filter(F.col("operation").isNotNull())
    return _log_frame(rows, key, table_name, changed_at, changed_by, with_id)
