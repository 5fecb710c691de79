"""Raw -> staging: JSON build/flatten, surrogate key, sports staging."""
import datetime as dt
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stride import schemas as S
from stride.operators import staging as ST
from stride.params import BenefitParams



def test_flatten_sample_row(spark):
    doc = {"id": 10000000123, "athlete": {"id": 43015}, "name": "Course à pied", "type": "Run",
           "sport_type": "Run", "distance": 10879, "moving_time": 4200, "elapsed_time": 4617,
           "start_date": "2025-12-09T08:09:00Z", "start_date_local": "2025-12-09T09:09:00+01:00",
           "timezone": "(GMT+01:00) Europe/Paris", "comment": None}
    raw = spark.createDataFrame([(doc["id"], 43015, json.dumps(doc), "strava_sim")],
                                S.RAW_ACTIVITIES_SCHEMA)
    r = ST.flatten_payloads(raw).first()
    assert (r.source_activity_id, r.id_employee, r.start_dt, r.end_dt, r.sport_type, r.distance_m,
            r.moving_time_s, r.comment) == (10000000123, 43015, dt.datetime(2025, 12, 9, 8, 9),
                                            dt.datetime(2025, 12, 9, 9, 25, 57), "Course à pied",
                                            10879, 4200, None)


def test_flatten_rejects_non_integer(spark):
    good = json.dumps({"id": 2, "athlete": {"id": 2}, "distance": 10, "start_date": "2025-01-01T00:00:00Z",
                       "elapsed_time": 10, "comment": None})
    bad = json.dumps({"id": 1, "athlete": {"id": 2}, "distance": 10.5, "start_date": "2025-01-01T00:00:00Z",
                      "elapsed_time": 10})
    raw = spark.createDataFrame([(1, 2, bad, "x"), (2, 2, good, "x")], S.RAW_ACTIVITIES_SCHEMA)
    with pytest.raises(Exception, match="invalid integer"):
        ST.flatten_payloads(raw).collect()
    lenient = {r.source_activity_id: r for r in ST.flatten_payloads(raw, strict=False).collect()}
    assert lenient[1].distance_m is None and lenient[2].distance_m == 10
    assert lenient[2].end_dt == dt.datetime(2025, 1, 1, 0, 0, 10)
    rej = ST.rejected_documents(raw).collect()
    assert [(r.activity_id, list(r.bad_fields)) for r in rej] == [(1, ["distance"])]


def test_build_payload_contract(spark):
    fields = spark.createDataFrame(
        [(1, 7, "Escalade", None, 90, 100, dt.datetime(2025, 6, 1, 8, 30), None)],
        "activity_id long, athlete_id long, sport string, distance long, moving_time long, "
        "elapsed_time long, start timestamp_ntz, comment string")
    r = ST.build_payloads(fields).first()
    doc = json.loads(r.payload)
    assert doc["start_date"] == "2025-06-01T08:30:00Z"
    assert doc["start_date_local"].endswith("+02:00")
    assert doc["distance"] is None and "comment" in doc and doc["comment"] is None
    assert doc["sport_type"] == "RockClimbing" and doc["athlete"] == {"id": 7}
    assert doc["moving_time"] <= doc["elapsed_time"]
    assert (r.activity_id, r.athlete_id, r.source) == (1, 7, "strava_sim")


def test_unknown_sport_code_raises(spark):
    fields = spark.createDataFrame([(1, 7, "Pétanque", None, 1, 1, dt.datetime(2025, 1, 1), None)],
                                   "activity_id long, athlete_id long, sport string, distance long, "
                                   "moving_time long, elapsed_time long, start timestamp_ntz, comment string")
    with pytest.raises(Exception):
        ST.build_payloads(fields).collect()


def test_surrogate_key_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("t"), F.col("id").alias("k"))
    got = ST.surrogate_key(df.repartition(7), ["t", "k"], "sid")
    want = df.withColumn("sid", F.row_number().over(Window.orderBy("t", "k")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_stage_sports(spark):
    emps = spark.createDataFrame([(1,), (2,)], "id_employee long")
    rows = spark.createDataFrame([(1, "Yoga"), (1, "Yoga"), (2, None), (3, "Tennis"), (2, "Tennis")],
                                 "id_salarie long, sport_pratique string")
    got = sorted(tuple(r) for r in ST.stage_sports(rows, emps).collect())
    assert got == [(1, "Yoga"), (2, "Tennis")]


def test_empty_guard(spark):
    with pytest.raises(ST.EmptyInputError):
        ST.ensure_not_empty(spark.createDataFrame([], S.RAW_ACTIVITIES_SCHEMA), "raw")


def test_stage_employees_types(spark):
    from stride.sources import bindings as BD
    from tests.conftest import SF0001
    hr = BD.hr_file(BD.table(spark, SF0001, "customer"))
    st = ST.stage_employees(hr, BenefitParams(pii_salt="s"))
    types = dict(st.dtypes)
    assert types["id_employee"] == "bigint" and types["salaire_brut"] == "decimal(12,2)"
    assert types["date_naissance"] == "date" and types["jours_cp"] == "int"
    modes = {r.moyen_deplacement for r in st.select("moyen_deplacement").distinct().collect()}
    assert modes <= set(S.TRANSPORT_MODES)


def test_flatten_round_trip_equals_staging_binding(spark):
    from stride.plans.inputs import Inputs
    from stride.sources import bindings as BD
    from tests.conftest import SF0001
    I = Inputs(spark, SF0001)
    a, b = I.flattened_documents, BD.event_staging(I.table("events"))
    assert a.count() == b.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_flatten_rejects_malformed_and_missing(spark):
    doc = {"id": 1, "athlete": {"id": 2}, "start_date": "2025-01-01T00:00:00Z", "elapsed_time": 10}
    rows = {1: json.dumps(doc), 2: "this is not json", 3: json.dumps({**doc, "elapsed_time": None}),
            4: json.dumps({k: v for k, v in doc.items() if k != "start_date"})}
    raw = spark.createDataFrame([(k, 2, v, "x") for k, v in rows.items()], S.RAW_ACTIVITIES_SCHEMA)
    assert ST.flatten_payloads(raw.filter("activity_id = 1")).count() == 1
    for k in (2, 3, 4):
        with pytest.raises(Exception, match="missing payload field"):
            ST.flatten_payloads(raw.filter(F.col("activity_id") == k)).collect()
    assert {r.activity_id: list(r.bad_fields) for r in ST.rejected_documents(raw).collect()} == {
        2: ["start_date", "elapsed_time"], 3: ["elapsed_time"], 4: ["start_date"]}
    assert ST.flatten_payloads(raw, strict=False).count() == 4


def test_csv_values_that_do_not_parse_raise(spark, tmp_path):
    from stride.sources import readers as RD
    header = ",".join(S.SPORT_COLUMN_MAP)
    for name, id_, ok in (("good", "12", True), ("bad", "abc", False)):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{id_},Yoga\n,Tennis\n", encoding="utf-8")
        df = RD.scan_sport_file(spark, str(tmp_path / f"{name}.csv"))
        if ok:
            assert sorted(str((r.id_salarie, r.sport_pratique)) for r in df.collect()) == ["(12, 'Yoga')", "(None, 'Tennis')"]
        else:
            with pytest.raises(Exception, match="invalid bigint"):
                df.collect()
