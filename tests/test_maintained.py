"""Maintained state equals a full pass: window counts, bitmaps, appended numbers, suite state."""
import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stride.operators import benefits as B
from stride.operators import distinct as D
from stride.operators import quality as Q
from stride.operators import staging as ST
from stride.operators import views as V
from stride.operators import windows as W
from stride.sources.store import TableStore

ACTS = "id_activity long, id_employee long, start_dt timestamp_ntz, sport_type string, distance_m int"


def activities(spark, n=4000, seed=1):
    rnd = random.Random(seed)
    start = dt.datetime(2023, 1, 1)
    rows = [(i, 1 if rnd.random() < 0.33 else rnd.randrange(2, 40_000, 997), start + dt.timedelta(minutes=rnd.randrange(60 * 24 * 500)),
             rnd.choice(["Yoga", "Vélo", None]), rnd.choice([None, rnd.randrange(20_000)])) for i in range(n)]
    return spark.createDataFrame(rows, ACTS)


def test_window_slides(spark):
    acts = activities(spark).cache()
    store = TableStore(spark, tempfile.mkdtemp(prefix="win-"))
    seen = None
    cut = lambda a, b: acts.filter((F.col("start_dt") >= F.lit(a)) & (F.col("start_dt") < F.lit(b)))
    d = dt.datetime
    late = F.col("id_activity") % 17 == 0
    batches = [("a", d(2024, 2, 1), cut(d(2023, 1, 1), d(2024, 2, 1)).filter(~late)),
               ("b", d(2024, 3, 1), cut(d(2024, 2, 1), d(2024, 3, 1)).unionByName(cut(d(2023, 1, 1), d(2024, 2, 1)).filter(late))),
               ("c", d(2024, 3, 1), cut(d(2030, 1, 1), d(2030, 1, 2))),  # nothing arrives, the date stays
               ("d", d(2024, 5, 10), cut(d(2024, 3, 1), d(2024, 6, 1)))]
    for name, as_of, part in batches:
        seen = part if seen is None else seen.unionByName(part)
        got = W.advance(store, part, as_of, name)
        want = B.activity_counts(seen, as_of, 365)
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    with pytest.raises(ValueError, match="already counted"):
        W.advance(store, batches[-1][2], d(2024, 5, 10), "d")
    with pytest.raises(ValueError, match="earlier days"):
        W.advance(store, batches[-1][2], d(2024, 1, 1), "e")
    with pytest.raises(ValueError, match="midnight"):
        W.advance(store, batches[-1][2], d(2024, 6, 1, 12), "e")


def test_window_reads_changed_days_only(spark):
    """The days that left are a pushed-down filter over the written counts."""
    acts = activities(spark, 500)
    folder = tempfile.mkdtemp(prefix="days-")
    W.day_counts(acts).write.mode("overwrite").parquet(f"{folder}/batch=a")
    days = spark.read.parquet(folder)
    slid = W.slide(spark.createDataFrame([], "id_employee long, activity_count long"), days.limit(0), days, dt.date(2023, 2, 1), dt.date(2023, 2, 3))
    plan = slid._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,2023-02-01), LessThan(day,2023-02-03)" in plan


def test_bitmaps_merge_to_exact_distinct_counts(spark):
    acts = activities(spark).unionByName(activities(spark, 50, 2).withColumn("id_employee", F.lit(None).cast("long")))
    sums, bits = (ST.written(x) for x in D.sport_months(acts))
    for as_of in (dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 9, 13, 5)):  # from a month's start, and from inside one
        got = D.activities_by_sport(sums, bits, acts, as_of)
        want = V.activities_by_sport(acts, as_of)
        assert got.count() == want.count() == 3 and got.exceptAll(want.select(*got.columns)).count() == 0
    month = D.distinct_count(bits, ["month"], "n")
    plain = acts.groupBy(D.month("start_dt").alias("month")).agg(F.count_distinct("id_employee").alias("n"))
    assert month.exceptAll(plain).count() == 0


def test_appended_numbers(spark):
    acts = activities(spark, 900)
    want = acts.withColumn("n", F.row_number().over(Window.orderBy("start_dt", "id_activity")))
    cuts = [dt.datetime(2023, 1, 1), dt.datetime(2023, 8, 1), dt.datetime(2023, 8, 1), dt.datetime(2025, 1, 1)]
    out = ranges = None
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):  # the second batch is empty
        part, own = ST.append_numbered(acts.filter((F.col("start_dt") >= F.lit(a)) & (F.col("start_dt") < F.lit(b))),
                                       ["start_dt", "id_activity"], ranges, str(k), "n")
        before = out
        ranges = own if ranges is None else ranges.unionByName(own)
        out = part if out is None else out.unionByName(part)
        if before is not None:
            assert before.join(out, "n", "left_anti").count() == 0
    assert out.count() == 900 and out.exceptAll(want.select(*out.columns)).count() == 0
    ids = sorted((r.first_id, r.last_id) for r in ranges.collect())
    assert ids[0][0] == 1 and ids[-1][1] == 900 and all(a[1] + 1 == b[0] for a, b in zip(ids, ids[1:]))


def test_places_of_a_sorted_frame(spark):
    rows = activities(spark, 700).select("id_activity", "start_dt").orderBy(F.desc("start_dt"), "id_activity")
    want = rows.withColumn("place", F.row_number().over(Window.orderBy(F.desc("start_dt"), "id_activity")))
    assert ST.in_order(rows).exceptAll(want.select("id_activity", "start_dt", "place")).count() == 0


def test_suite_state_equals_a_full_pass(spark):
    acts = activities(spark, 600).withColumn("day", F.to_date("start_dt"))
    rules = [Q.not_null("sport_type"), Q.between("distance_m", 10, 15_000), Q.in_set("sport_type", ["Yoga"]), Q.pair_ge("distance_m", "id_employee"),
             Q.max_between("start_dt", F.lit(dt.datetime(2023, 1, 1)), F.lit(dt.datetime(2024, 1, 1))), Q.check("near", "distance_m", F.col("distance_m") < 9000)]
    first, later = acts.filter("day < '2023-06-01'"), acts.filter("day >= '2023-06-01'")
    state = ST.written(Q.suite_state(first, rules, "day")).unionByName(ST.written(Q.suite_state(later, rules, "day")))
    got, want = Q.report_from_state(state, rules, "s"), Q.evaluate(acts, rules, "s")
    assert got.count() == len(rules) and got.exceptAll(want.select(*got.columns)).count() == 0
    keys = Q.key_state(first, "id_activity", "day").unionByName(Q.key_state(later, "id_activity", "day"))
    none = lambda: pytest.fail("rows were read")
    assert Q.unique_from_state(keys, "id_activity", "s", none).first() == Q.evaluate(acts, [Q.unique("id_activity")], "s").first()
    twice = acts.unionByName(acts.limit(3))
    keys = Q.key_state(twice, "id_activity", "day")
    got = Q.unique_from_state(keys, "id_activity", "s", lambda: twice).first()
    assert got.unexpected_count == 6 and got.element_count == 603
