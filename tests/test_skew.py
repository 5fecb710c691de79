"""A hot key holding a third of all rows: results stay whole and exact, and
the per-key count is partially aggregated before its shuffle."""
import datetime as dt

from pyspark.sql import functions as F

from stride.operators import benefits as B
from stride.operators import notify as N
from stride.params import BenefitParams

AS_OF = dt.datetime(2024, 1, 31)


def test_hot_employee(spark):
    n = 30_000
    acts = spark.range(n).select(
        F.col("id").alias("id_activity"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500 + 1000).alias("id_employee"),
        (F.lit(AS_OF).cast("timestamp_ntz") - F.make_dt_interval(F.col("id") % 300)).alias("start_dt"))
    acts = acts.withColumns({"end_dt": F.col("start_dt") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30)),
                             "sport_type": F.lit("Yoga"), "distance_m": F.lit(None).cast("int"),
                             "comment": F.lit(None).cast("string"), "posted_to_slack": F.lit(False)})
    emps = spark.range(1500).select((F.col("id") + 0).alias("id_employee"),
                                    F.lit("X").alias("nom"), F.lit("Y").alias("prenom"))
    counts = B.activity_counts(acts, AS_OF, 365)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    got = {r.id_employee: r.activity_count for r in counts.collect()}
    assert got[7] == n // 3 and sum(got.values()) == n
    w = B.compute_wellbeing(emps, acts, BenefitParams(pii_salt="s", as_of=AS_OF, wellbeing_threshold=60))
    assert w.filter("id_employee = 7").first().is_eligible
    msgs = N.render_messages(acts, emps)
    assert msgs.count() == n
    assert msgs.filter("id_employee = 7").count() == n // 3


def test_surrogate_key_with_a_hot_timestamp(spark):
    from pyspark.sql import Window

    from stride.operators import staging as ST
    n = 20_000
    df = spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(AS_OF)).otherwise(
            F.lit(AS_OF).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 97))
        .cast("timestamp_ntz").alias("t"))
    got = ST.surrogate_key(df.repartition(9), ["t", "k"], "sid")
    want = df.withColumn("sid", F.row_number().over(Window.orderBy("t", "k")))
    assert got.count() == n
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_split_join_levels_a_hot_key(spark):
    """One employee with a third of the rows, adaptive execution off: no task holds twice the
    median, and each join type gives the rows of the plain join."""
    from stride.operators import skew as SK
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 30_000
        rows = spark.range(0, n, 1, 6).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None)
                                              .otherwise(F.col("id") % 900 + 100).cast("long").alias("k"))
        people = spark.range(800).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        people = people.unionByName(people.filter("k = 7"))  # the hot key twice on the other side
        hot = SK.hot_keys(rows, "k", 0.05).collect()
        assert [(r.k, r.rows) for r in hot] == [(7, n // 3)]
        for how in ("inner", "left", "left_semi", "left_anti"):
            got, want = SK.split_join(rows, people, "k", how), rows.join(people, "k", how)
            assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
        tasks = sorted(r["n"] for r in SK.split_join(rows, people, "k", "left", pieces=64).groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n")).collect())
        assert tasks[-1] <= 2 * tasks[len(tasks) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
