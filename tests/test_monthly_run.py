"""E1 monthly run on sf0.001: files in, layered tables, constraints, run log, re-run behaviour."""
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from stride import schemas as S
from stride.operators import quality as Q
from stride.params import BenefitParams
from stride.plans import catalog, monthly_run
from stride.sources.exports import export_files
from stride.sources.store import TableStore
from tests.conftest import SF0001

PARAMS = BenefitParams(pii_salt="s", as_of=dt.datetime(2024, 1, 31), wellbeing_threshold=3, run_id="t-1")


@pytest.fixture(scope="module")
def first(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="stride-store-"))
    reports = tempfile.mkdtemp(prefix="stride-reports-")
    return monthly_run.run(spark, SF0001, PARAMS, store, report_dir=f"{reports}/a", report_copy=f"{reports}/b"), reports


def test_tables_and_logs(spark, first):
    res, reports = first
    store, n = res.store, res.counts["employees"]
    assert store.read("marts.eligibility_prime").count() == n
    assert store.read("marts.eligibility_wellbeing").count() == n
    assert res.counts["activities"] == res.counts["raw_activities"] > 0
    for table in ("raw.employees", "raw.sports"):  # provenance of the files
        assert store.read(table).filter(F.col("source_file").startswith("part-") & (F.col("loaded_at") == F.lit(PARAMS.as_of))).count() \
            == store.read(table).count() > 0
    # delivery state is a small table of posted ids, joined on read
    assert res.counts["posted"] == 50 == store.read("staging.posted_activities").count()
    assert store.read("staging.activities").filter("posted_to_slack").count() == 0
    assert monthly_run.current_activities(store).filter("posted_to_slack").count() == 50
    outbox = spark.read.json(f"{store.root}/outbox_jsonl")
    assert outbox.count() == 50 and set(outbox.columns) == {"payload", "error"}
    for suite in ("employees", "activities"):
        a, b = (spark.read.json(f"{reports}/{copy}/{suite}") for copy in "ab")
        assert a.count() == b.count() > 0 and a.exceptAll(b.select(*a.columns)).count() == 0
    cache = store.read("staging.distance_cache")
    active = store.read("staging.employees").filter(F.col("distance_domicile_m").isNotNull()).count()
    assert 0 < cache.count() <= active and cache.dropDuplicates(["address_hash", "mode"]).count() == cache.count()
    # an active commuter without an answer has no distance, and the declaration is suspect
    open_ = store.read("staging.employees").filter(F.col("moyen_deplacement").isin(*S.ACTIVE_TRANSPORTS) & F.col("distance_domicile_m").isNull())
    assert open_.count() > 0 and open_.filter("not is_declaration_suspect").count() == 0
    steps = {r.step_name: r for r in store.read("audit.run_log").collect()}
    assert all(r.status == "OK" for r in steps.values()) and len(steps) == 22
    assert steps["validate_geo_resolve"].rows_out == cache.count() and steps["notify_mark_posted"].rows_out == 50
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("stride_run_")]  # scratch tables are gone


def test_named_checks_see_a_lost_row(spark, first):
    store = first[0].store
    for name in Q.CHECKS:
        Q.run_check(name, store.read, PARAMS.as_of)

    def without_one(table):
        return lambda q: store.read(q).filter(F.col(store.read(q).columns[0]) != store.read(q).first()[0]) if q == table else store.read(q)

    for table, name in (("marts.eligibility_prime", "advantages_computed"), ("marts.eligibility_wellbeing", "advantages_computed"),
                        ("staging.activities", "activities_generated")):
        with pytest.raises(Q.QualityError, match=name):
            Q.run_check(name, without_one(table), PARAMS.as_of)
    for table, name in (("staging.employees", "employees_loaded"), ("staging.sports_practice", "sports_practice_loaded")):
        with pytest.raises(Q.QualityError, match=name):
            Q.run_check(name, lambda q: store.read(q).limit(0), PARAMS.as_of)
    with pytest.raises(KeyError):
        Q.run_check("no_such_check", store.read, PARAMS.as_of)


def test_second_run(spark, first):
    """The reload empties what depends on it: every mart row is an insert again, and no id is posted any more."""
    store, n = first[0].store, first[0].counts["employees"]
    assert store.read("audit.eligibility_changes").count() == 2 * n
    res = monthly_run.run(spark, SF0001, PARAMS.with_(run_id="t-2"), store)
    changes = store.read("audit.eligibility_changes")
    assert changes.filter(F.col("operation") == "INSERT").count() == 4 * n == changes.count()
    assert store.read("audit.run_log").select("run_id").distinct().count() == 2
    assert store.read("staging.posted_activities").select("run_id").distinct().collect()[0][0] == "t-2"
    ids = store.read("staging.activities").agg(F.min("id_activity"), F.max("id_activity")).first()
    assert (ids[0], ids[1]) == (1, res.counts["activities"])


def test_bad_rows_stop_the_run_before_publication(spark):
    """A file row that breaks a constraint: the table is not published, the log says so."""
    folder = tempfile.mkdtemp(prefix="stride-files-")
    files = export_files(spark, SF0001, folder)
    hr = spark.read.option("header", True).csv(files.hr)
    for column, value, rule in (("ID salarié", F.lit("7"), "unique"), ("Moyen de déplacement", F.lit("fusée"), "moyen_deplacement_known")):
        path = f"{folder}/{rule}"
        odd = hr.withColumn(column, F.when(F.pmod(F.col("`ID salarié`").cast("int"), F.lit(40)) == 3, value).otherwise(F.col(f"`{column}`")))
        odd.write.options(header=True).csv(path)
        store = TableStore(spark, tempfile.mkdtemp(prefix="stride-store-"))
        with pytest.raises(Q.ConstraintError, match=rule):
            monthly_run.run_files(spark, type(files)(path, files.sport, files.answers, files.activities), PARAMS, store)
        assert store.exists("raw.employees") and not store.exists("staging.employees")
        last = {r.step_name: r for r in store.read("audit.run_log").collect()}["extract_rh_to_staging"]
        assert last.status == "FAIL" and rule in last.message


def test_command_line(spark, capsys):
    from stride.__main__ import main
    out = main(["--sf-dir", SF0001, "--threshold", "3", "--as-of", "2024-01-31", "--salt", "s",
                "--post-limit", "10"])
    assert out["employees"] == out["marts.eligibility_prime"] == out["marts.eligibility_wellbeing"]
    assert out["posted"] == 10 and out["activities"] == out["raw_activities"]
    assert '"run_id"' in capsys.readouterr().out


def test_queries_run_over_the_tables_as_they_are(spark, tmp_path):
    """A query of the monthly run counts the rows of now, not those of an earlier query's run over the same folder."""
    spark.range(1, 31).selectExpr("id AS c_custkey", "format_string('Customer#%09d', id) AS c_name", "CAST(id % 25 AS int) AS c_nationkey",
                                  "CAST(id AS double) AS c_acctbal", "'UNIT' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    for n in (520, 540):
        spark.range(n).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-02 08:00:00' AS ts", "id % 30 + 1 AS user_id", "'view' AS event_type",
                                  "1.5D AS value", "'{\"k\": 3}' AS props").write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        log = {r.step_name: r for r in catalog.QUERIES["e1_monthly_run_log"](spark, str(tmp_path)).collect()}
        assert log["load_raw_activities"].rows_out == log["transform_activities"].rows_out == n
        assert len(log) == 22 and {r.status for r in log.values()} == {"OK"}
