"""Merges, change logs and quality rules on small frames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stride.operators import merge as M
from stride.operators import quality as Q

T0 = dt.datetime(2025, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_keeps_absent_targets(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, w int")
    src = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    out = M.upsert(tgt, src, ["k"])
    assert rows(out, "k", "v", "w") == [(1, "a", 10), (2, "B", 20), (3, "C", None)]


def test_upsert_listed_columns(spark):
    tgt = spark.createDataFrame([(1, "a", 10)], "k long, v string, w int")
    src = spark.createDataFrame([(1, "A", 99), (2, "B", 5)], "k long, v string, w int")
    out = M.upsert(tgt, src, ["k"], update_cols=["v"])
    assert rows(out, "k", "v", "w") == [(1, "A", 10), (2, "B", 5)]


def test_insert_if_absent(spark):
    tgt = spark.createDataFrame([(1, "Yoga")], "k long, s string")
    src = spark.createDataFrame([(1, "Yoga"), (1, "Tennis"), (1, "Tennis")], "k long, s string")
    assert rows(M.insert_if_absent(tgt, src, ["k", "s"]), "k", "s") == [(1, "Tennis"), (1, "Yoga")]


def test_update_by_key_and_orphans(spark):
    tgt = spark.createDataFrame([(1, None), (2, 5)], "k long, d int")
    upd = spark.createDataFrame([(1, 7), (9, 1)], "k long, d int")
    assert rows(M.update_by_key(tgt, upd, ["k"], ["d"]), "k", "d") == [(1, 7), (2, 5)]
    child = spark.createDataFrame([(1,), (4,), (None,)], "k long")
    assert rows(M.orphans(child, "k", tgt, "k"), "k") == [(4,)]


def test_change_log_from_merge_updates_even_unchanged(spark):
    before = spark.createDataFrame([(1, "x"), (2, "y")], "id_employee long, v string")
    source = spark.createDataFrame([(1, "x"), (3, "z")], "id_employee long, v string")
    log = M.change_log_from_merge(before, source, "id_employee", "t", T0, "me", with_id=True)
    got = rows(log, "id_employee", "operation")
    assert got == [(1, "UPDATE"), (3, "INSERT")]
    r = {x.id_employee: x for x in log.collect()}
    assert r[3].old_data is None and r[1].old_data.v == "x" and r[3].new_data.v == "z"
    assert sorted(x.id for x in r.values()) == [1, 2]


def test_change_log_from_snapshots(spark):
    before = spark.createDataFrame([(1, "x"), (2, "y"), (4, None)], "id_employee long, v string")
    after = spark.createDataFrame([(1, "x"), (3, "z"), (4, None), (2, "Y")], "id_employee long, v string")
    after = after.filter(F.col("id_employee") != 1).unionByName(
        spark.createDataFrame([(1, "x")], "id_employee long, v string"))
    log = M.change_log_from_snapshots(before.filter("id_employee != 4"), after.filter("id_employee != 1"),
                                      "id_employee", "t", T0, "me")
    assert rows(log, "id_employee", "operation") == [(1, "DELETE"), (2, "UPDATE"), (3, "INSERT"), (4, "INSERT")]


def test_quality_one_pass_report(spark):
    df = spark.createDataFrame([(1, 5, "a", 10, 8), (1, None, "b", 3, 4), (None, 100, "z", None, 1)],
                               "id long, n int, c string, e int, m int")
    rep = {(r.rule, r.column_name): r for r in Q.evaluate(df, [
        Q.not_null("id"), Q.unique("id"), Q.between("n", 0, 50), Q.in_set("c", ["a", "b"]),
        Q.pair_ge("e", "m"), Q.max_between("n", 0, 50),
        Q.check("positive", "m", F.col("m") > 1)], "s").collect()}
    assert rep[("not_null", "id")].unexpected_count == 1
    assert rep[("unique", "id")].unexpected_count == 2
    assert rep[("between", "n")].unexpected_count == 1 and rep[("between", "n")].element_count == 2
    assert rep[("in_set", "c")].unexpected_count == 1
    assert rep[("pair_ge", "e,m")].unexpected_count == 1 and rep[("pair_ge", "e,m")].element_count == 2
    assert rep[("max_between", "n")].unexpected_count == 1
    assert rep[("positive", "m")].unexpected_count == 1
    assert not rep[("not_null", "id")].success


def test_suite_writes_report_before_raising(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "id long")
    path = str(tmp_path / "report")
    with pytest.raises(Q.QualityError):
        Q.run_suites({"s": (df, [Q.not_null("id")])}, path)
    assert spark.read.json(path).count() == 1


def test_gates_and_dispatch(spark):
    df = spark.range(3)
    assert Q.run_gate("not_empty", df).first().success
    with pytest.raises(Q.QualityError):
        Q.run_gate("min_volume", df, 500)
    with pytest.raises(KeyError):
        Q.run_gate("no_such_check", df)
    assert Q.run_gate("same_count", df, spark.range(3), name="c").first().success


def test_by_ids_list_and_frame(spark):
    from stride.operators import views as V
    df = spark.range(10).withColumnRenamed("id", "k")
    assert sorted(r.k for r in V.by_ids(df, "k", [1, 3, 99]).collect()) == [1, 3]
    ids = spark.createDataFrame([(2,), (4,), (4,)], "x long")
    assert sorted(r.k for r in V.by_ids(df, "k", ids).collect()) == [2, 4]


def test_upsert_refuses_a_repeated_source_key(spark):
    tgt = spark.createDataFrame([(1, "a")], "k long, v string")
    src = spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")
    with pytest.raises(Exception, match="repeats a key"):
        M.upsert(tgt, src, ["k"]).collect()


def test_keys_in_one_pass(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (9, None)], "a long, b long")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    rep = {(r.rule, r.column_name): (r.element_count, r.unexpected_count) for r in Q.evaluate(
        child, [*Q.primary_key("a", "b"), Q.foreign_key("a", parent, "k")], "s").collect()}
    assert rep == {("not_null", "a"): (5, 1), ("not_null", "b"): (5, 1), ("unique", "a,b"): (3, 2), ("foreign_key", "a"): (4, 1)}
    plan = Q.evaluate(child, Q.primary_key("a", "b"), "s")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1  # the table is read once


def test_cache_lookup_marks_hits(spark):
    req = spark.createDataFrame([(1, "x"), (2, "y")], "id long, k string")
    cache = spark.createDataFrame([("x", 5)], "k string, d int")
    assert rows(M.cache_lookup(req, cache, ["k"]).fillna(-1), "id", "d", "cache_hit") == [(1, 5, True), (2, -1, False)]


def test_cache_scan_is_filtered_by_the_requests(spark, tmp_path):
    """JON-8: a Bloom filter of the requests stands on the cache scan; the cache rows that are shuffled fall with the requests."""
    from stride.functions import columns as C
    from stride.session import BLOOM_SCAN, configure
    configure(spark)
    assert spark.conf.get(BLOOM_SCAN) == "256MB"
    spark.conf.set(BLOOM_SCAN, "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        home = F.concat(F.lit(" Rue "), F.col("id").cast("string"))
        spark.range(20_000).select(C.address_hash(home).alias("address_hash"), F.lit("walking").alias("mode"),
                                   F.col("id").cast("int").alias("distance_m")).write.parquet(f"{tmp_path}/cache")
        spark.range(30_000).select("id", home.alias("home")).write.parquet(f"{tmp_path}/people")
        cache, people = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("cache", "people"))
        requests = people.filter("id % 300 = 7").select("id", C.address_hash("home").alias("address_hash"), F.lit("walking").alias("mode"))
        looked = M.cache_lookup(requests, cache, ["address_hash", "mode"])
        assert "might_contain" in looked._jdf.queryExecution().optimizedPlan().toString()
        got = {r.id: (r.cache_hit, r.distance_m) for r in looked.collect()}
        assert got == {i: (i < 20_000, i if i < 20_000 else None) for i in range(7, 30_000, 300)}
    finally:
        spark.conf.set(BLOOM_SCAN, "256MB")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
