"""Publication of tables, and exact arithmetic against Python models."""
import random
import tempfile
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from stride.functions import columns as C
from stride.operators import merge as M
from stride.operators import quality as Q
from stride.operators import views as V
from stride.sources.store import TableStore


def failing(spark, n):
    return spark.range(n).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")))


def test_failed_write_is_never_published(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="store-"))
    assert not store.exists("raw.t")
    assert store.write(spark.range(5), "raw.t") == 5
    with pytest.raises(Exception, match="boom"):
        store.write(failing(spark, 9), "raw.t")
    assert store.read("raw.t").count() == 5
    # a table may be read while its successor is written; the same root finds the names again
    store.write(store.read("raw.t").unionByName(spark.range(2)), "raw.t")
    assert TableStore(spark, store.root).read("raw.t").count() == 7
    with pytest.raises(FileNotFoundError):
        store.read("raw.other")


def test_rows_that_break_rules_are_not_published(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="store-"))
    parents = spark.range(10)
    rules = [*Q.primary_key("k"), Q.not_null("v"), Q.check("positive", "v", F.col("v") > 0), Q.foreign_key("p", parents, "id")]
    good = spark.createDataFrame([(1, 1, 1), (2, 2, None)], "k long, v int, p long")
    assert store.write(good, "staging.t", rules=rules) == 2
    for row, rule in (((1, 5, 1), "unique"), ((None, 5, 1), "not_null"), ((3, None, 1), "not_null"), ((3, 0, 1), "positive"), ((3, 1, 77), "foreign_key")):
        with pytest.raises(Q.ConstraintError, match=rule) as e:
            store.write(good.unionByName(spark.createDataFrame([row], good.schema)), "staging.t", rules=rules)
        assert e.value.broken[0][2] == (2 if rule == "unique" else 1)
        assert store.read("staging.t").count() == 2
    # appends: the job fails before anything is visible
    row_rules = [Q.check("positive", "v", F.col("v") > 0), Q.not_null("k")]
    with pytest.raises(Exception, match="positive"):
        store.append(spark.createDataFrame([(7, 7, 1), (8, -1, 1)], good.schema), "staging.t", row_rules)
    assert store.read("staging.t").count() == 2
    assert store.append(spark.createDataFrame([(7, 7, 1)], good.schema), "staging.t", row_rules) == 1
    assert store.read("staging.t").count() == 3


def test_refresh_cascades_to_dependents(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="store-"),
                       cascade={"staging.employees": ("marts.m",)})
    store.write(spark.range(3), "marts.m")
    store.refresh(spark.range(10), "staging.employees")
    assert store.read("marts.m").count() == 0 and store.read("marts.m").columns == ["id"]
    store.append(spark.range(2), "marts.m")  # an emptied table starts anew
    assert store.read("marts.m").count() == 2


def test_appends_are_whole(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="store-"))
    store.append(spark.range(2), "audit.t")
    store.append(spark.range(3), "audit.t")
    with pytest.raises(Exception, match="boom"):
        store.append(failing(spark, 4), "audit.t")
    store.append(spark.range(1), "audit.t")
    assert store.read("audit.t").count() == 6


def test_rounded_ratio_matches_decimal_model(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(0, 10**12), rng.randrange(1, 10**6)) for _ in range(3000)]
    rows += [(5, 1000), (15, 1000), (25, 10000), (0, 3)]  # exact ties
    df = spark.createDataFrame(rows, "n long, d long")
    got = {(r.n, r.d): r.v for r in df.select("n", "d", V.rounded_ratio(F.col("n"), F.col("d"), 2).alias("v")).collect()}
    for n, d in rows:
        want = (Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[(n, d)] == want, (n, d)


def test_distance_text_half_up(spark):
    rng = random.Random(3)
    vals = [rng.randrange(0, 500_000) for _ in range(2000)] + [50, 149, 150, 10850, 0]
    df = spark.createDataFrame([(v,) for v in vals], "d int")
    got = {r.d: r.t for r in df.select("d", C.distance_text("d").alias("t")).collect()}
    for v in vals:
        km = (Decimal(v) / 1000).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)
        assert got[v] == f"{km} km"


def test_upsert_matches_dict_model(spark):
    rng = random.Random(11)
    tgt = {k: rng.randrange(100) for k in rng.sample(range(500), 200)}
    src = {k: rng.randrange(100) for k in rng.sample(range(500), 200)}
    out = M.upsert(spark.createDataFrame(list(tgt.items()), "k long, v long"),
                   spark.createDataFrame(list(src.items()), "k long, v long"), ["k"])
    assert {r.k: r.v for r in out.collect()} == {**tgt, **src}
