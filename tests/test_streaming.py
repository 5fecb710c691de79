"""STR-1 / STR-2 invariants: batch equality, replay and restart, exactly once."""
import datetime as dt
import pathlib
import tempfile

from pyspark.sql import functions as F

from stride.operators import staging as ST
from stride.plans.inputs import Inputs
from stride.sources import bindings as BD
from stride.sources.store import TableStore
from stride.streaming import incremental as STR
from tests.conftest import SF0001

FLAT = ("source_activity_id long, id_employee long, start_dt timestamp_ntz, end_dt timestamp_ntz, "
        "sport_type string, distance_m int, moving_time_s int, comment string, posted_to_slack boolean, "
        "delivered_at timestamp, delivered_file string, delivered_digest long")


def undo_last_commit(checkpoint: str) -> None:
    """As if the driver died after the sink's commit and before the batch was logged as done."""
    commits = [p for p in pathlib.Path(checkpoint, "commits").iterdir() if p.name.isdigit()]
    last = max(commits, key=lambda p: int(p.name))
    last.unlink()
    pathlib.Path(checkpoint, "commits", f".{last.name}.crc").unlink(missing_ok=True)


def test_incremental_flatten_equals_batch_also_after_a_replay(spark):
    I = Inputs(spark, SF0001)
    root = tempfile.mkdtemp(prefix="str1-")
    docs = I.raw_documents
    old = I.event_fields.filter(F.col("activity_id") % 3 == 0).withColumns(
        {"start": F.col("start") - F.expr("INTERVAL 1 DAY"), "comment": F.lit("old")})
    want = BD.event_staging(I.table("events"))  # the direct projection: stream == batch == binding

    def flatten():
        STR.incremental_flatten(spark, f"{root}/landing", f"{root}/flat", f"{root}/ckpt", max_files=1).awaitTermination()

    def same():
        got = STR.staging_activities(spark, f"{root}/flat")
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0

    STR.write_landing(ST.build_payloads(old), f"{root}/landing")
    STR.write_landing(docs.repartition(3), f"{root}/landing")
    flatten()
    same()
    rows = spark.read.parquet(f"{root}/flat").count()
    undo_last_commit(f"{root}/ckpt")
    flatten()  # the batch runs again; the sink has it already
    assert spark.read.parquet(f"{root}/flat").count() == rows
    same()
    # re-delivered documents (same ids) must not duplicate rows
    STR.write_landing(docs.filter(F.col("activity_id") % 3 == 1), f"{root}/landing")
    flatten()
    assert spark.read.parquet(f"{root}/flat").count() > rows
    same()
    store = TableStore(spark, f"{root}/tables")
    assert STR.snapshot(spark, f"{root}/flat", store) == want.count()
    assert store.read(STR.STAGING).drop("start_day").exceptAll(want).count() == 0


def test_latest_delivery_wins_whatever_the_batches(spark):
    t = lambda d: dt.datetime(2024, 1, d, 8)
    given = [(1, 1, "a", 0), (2, 2, "b", 0), (1, 3, "a2", 2), (1, 2, "a1", 1), (3, 3, "c", 1)]  # key, day, comment, minute
    rows = spark.createDataFrame([(k, 1, t(d), t(d), "Yoga", None, 1, c, False, dt.datetime(2024, 2, 1, 0, m), "f", 0)
                                  for k, d, c, m in given], FLAT)
    got = sorted((r.source_activity_id, r.comment, r.start_dt.day) for r in STR.latest(rows).collect())
    assert got == [(1, "a2", 3), (2, "b", 2), (3, "c", 3)]


def deliver(spark, I, root, rows, **kw):
    rows.write.mode("append").parquet(f"{root}/pending")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/pending")
    STR.idempotent_delivery(spark, stream, I.employees, f"{root}/outbox", f"{root}/ckpt", **kw).awaitTermination()
    return spark.read.parquet(f"{root}/outbox")


def test_delivery_is_exactly_once(spark):
    I = Inputs(spark, SF0001)
    root = tempfile.mkdtemp(prefix="str2-")
    acts = BD.event_staging(I.table("events")).withColumnRenamed("source_activity_id", "id_activity")
    n = acts.count()
    half = acts.filter(F.col("id_activity") % 2 == 0)
    assert deliver(spark, I, root, half).count() == half.count()
    undo_last_commit(f"{root}/ckpt")
    assert deliver(spark, I, root, acts).count() == n           # replays the first batch, then everything arrives
    assert deliver(spark, I, root, acts.unionByName(acts)).count() == n  # restarted; twice again in one batch
    out = spark.read.parquet(f"{root}/outbox")
    assert out.select("id_activity").distinct().count() == n


def test_posted_rows_and_unknown_employees_are_not_delivered(spark):
    I = Inputs(spark, SF0001)
    root = tempfile.mkdtemp(prefix="str2b-")
    acts = BD.event_staging(I.table("events")).withColumnRenamed("source_activity_id", "id_activity")
    posted = acts.withColumn("posted_to_slack", F.col("id_activity") % 5 == 0) \
        .withColumn("id_employee", F.when(F.col("id_activity") % 5 == 1, F.lit(-1)).otherwise(F.col("id_employee")))
    want = acts.filter("id_activity % 5 > 1").count()
    assert deliver(spark, I, root, posted).count() == want
    # the employee is known by now: the activity is delivered when it arrives again
    assert deliver(spark, I, root, acts.filter("id_activity % 5 = 1")).count() == want + acts.filter("id_activity % 5 = 1").count()


def test_horizon_bounds_the_state(spark):
    I = Inputs(spark, SF0001)
    root = tempfile.mkdtemp(prefix="str2c-")
    acts = BD.event_staging(I.table("events")).withColumnRenamed("source_activity_id", "id_activity")
    day = lambda lo, hi: acts.filter(F.dayofmonth("start_dt").between(lo, hi))
    deliver(spark, I, root, day(1, 5), horizon="10 days")
    deliver(spark, I, root, day(3, 9), horizon="10 days")   # days 3 to 5 again, inside the horizon
    out = deliver(spark, I, root, day(5, 20), horizon="10 days")
    assert out.count() == day(1, 20).count() == out.select("id_activity").distinct().count()
