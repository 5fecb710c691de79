"""Scalar rules (PRJ-*) on the golden cases of FIXTURES.md."""
import datetime as dt
import hashlib

from pyspark.sql import functions as F

from stride.functions import columns as C


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values.keys())) if values else spark.range(1)
    return df.select(col.alias("v")).first()["v"]


def test_transport_normalisation(spark):
    df = spark.createDataFrame([("MARCHE/RUNNING",), ("velo/trottinette/autres",), ("inventé",),
                                (" \tTransports en commun\n",)], ["m"])
    got = [r.v for r in df.select(C.normalize_transport("m").alias("v")).collect()]
    assert got == ["Marche/running", "Vélo/Trottinette/Autres", "inventé", "Transports en commun"]


def test_salted_hash(spark):
    df = spark.createDataFrame([("Dupont", "Jean")], ["nom", "prenom"])
    a = df.select(C.salted_hash("s1", "nom", "prenom").alias("h")).first().h
    b = df.select(C.salted_hash("s1", "nom", "prenom").alias("h")).first().h
    c = df.select(C.salted_hash("s2", "nom", "prenom").alias("h")).first().h
    assert a == b and a != c and len(a) == 64
    assert a == hashlib.sha256("s1DupontJean".encode()).hexdigest()


def test_sport_normalisation(spark):
    df = spark.createDataFrame([("running",), ("velo",), ("foot",), ("Pétanque",), (None,), ("ESCALADE",)],
                               "s string")
    got = [r.v for r in df.select(C.normalize_sport("s").alias("v")).collect()]
    assert got == ["Course à pied", "Vélo", "Football", None, None, "Escalade"]


def test_address_hash_normalised(spark):
    df = spark.createDataFrame([("  12 Rue X ",), ("12 rue x",)], ["a"])
    h = [r.h for r in df.select(C.address_hash("a").alias("h")).collect()]
    assert h[0] == h[1] == hashlib.sha256(b"12 rue x").hexdigest()


def test_haversine_ranges(spark):
    lat, lon = 43.5667, 3.9000
    df = spark.createDataFrame([(lat, lon), (48.8566, 2.3522), (43.6108, 3.8767)], ["la", "lo"])
    d = [r.d for r in df.select(C.haversine_m("la", "lo", lat, lon).alias("d")).collect()]
    assert d[0] == 0
    assert 580_000 <= d[1] <= 740_000
    assert 4_000 <= d[2] <= 12_000


def test_plausibility(spark):
    df = spark.createDataFrame(
        [("Marche/running", 15000), ("Marche/running", 15001), ("Vélo/Trottinette/Autres", None),
         ("Transports en commun", 99999)], "m string, d int")
    dist, sus = C.plausibility("m", "d", 15, 25)
    got = [(r.dist, r.sus) for r in df.select(dist.alias("dist"), sus.alias("sus")).collect()]
    assert got == [(15000, False), (15001, True), (None, True), (None, False)]


def test_distance_and_duration_text(spark):
    df = spark.createDataFrame([(10879, 180), (1304, 4617), (None, 3600), (10850, 59)], "d int, s int")
    got = [(r.a, r.b) for r in df.select(C.distance_text("d").alias("a"),
                                          C.duration_text("s").alias("b")).collect()]
    assert got == [("10.9 km", "3 min"), ("1.3 km", "1 h 16"), ("session", "1 h 00"), ("10.9 km", "0 min")]


def test_message(spark):
    df = spark.createDataFrame([(0, "Jean", "Dupont", "Course à pied", 10800, 2700, "Top"),
                                (3, "Ana", "Lee", "Yoga", None, 600, None)],
                               "k long, p string, n string, s string, d int, t int, c string")
    rows = df.select(C.activity_message("k", "p", "n", "s", "d", "t", "c").alias("m")).collect()
    assert rows[0].m.startswith("Bravo Jean Dupont") and "10.8 km" in rows[0].m and "45 min" in rows[0].m
    assert rows[0].m.endswith(' ("Top")')
    assert rows[1].m.startswith("Ana Lee est en feu ! yoga : session en 10 min")


def test_iso_times(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 6, 1, 8, 30),), (dt.datetime(2025, 12, 9, 8, 9),)],
                               "t timestamp_ntz")
    got = [(r.z, r.l) for r in df.select(C.iso_utc_z("t").alias("z"), C.iso_local("t").alias("l")).collect()]
    assert got == [("2025-06-01T08:30:00Z", "2025-06-01T10:30:00+02:00"),
                   ("2025-12-09T08:09:00Z", "2025-12-09T09:09:00+01:00")]


def test_salary_band(spark):
    df = spark.createDataFrame([(29999.99,), (30000.0,), (79999.0,), (80000.0,), (None,)], "s double")
    got = [r.b for r in df.select(C.salary_band("s").alias("b")).collect()]
    assert got == ["< 30k", "30-50k", "50-80k", "> 80k", "> 80k"]


def test_geo_fallback(spark):
    from stride.operators import staging as ST
    from stride.params import BenefitParams
    df = spark.createDataFrame([(1, "Marche/running", None, 43.5667, 3.9), (2, "Marche/running", None, 48.8566, 2.3522)],
                               "id long, moyen_deplacement string, d int, la double, lo double")
    p = BenefitParams(pii_salt="s")
    plain = {r.id: (r.distance_domicile_m, r.is_declaration_suspect) for r in ST.apply_geo(df, p, "d").collect()}
    assert plain == {1: (None, True), 2: (None, True)}
    fb = C.haversine_m("la", "lo", 43.5667, 3.9)
    got = {r.id: (r.distance_domicile_m, r.is_declaration_suspect)
           for r in ST.apply_geo(df, p, "d", fallback=fb).collect()}
    assert got[1] == (0, False) and got[2][1] is True and got[2][0] > 500_000
