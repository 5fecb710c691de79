"""Benefit marts on the golden cases of FIXTURES.md (bonus and wellbeing)."""
import datetime as dt
from decimal import Decimal

import pytest

from stride.operators import benefits as B
from stride.operators import staging as ST
from stride.params import BenefitParams

AS_OF = dt.datetime(2025, 6, 30)


@pytest.fixture()
def employees(spark):
    rows = [(1, "Marketing", Decimal("30000.00"), "Marche/running", 5000),
            (2, "R&D", Decimal("50000.00"), "Vélo/Trottinette/Autres", 60000),
            (3, "Ventes", Decimal("40000.00"), "Transports en commun", None)]
    df = spark.createDataFrame(rows, "id_employee long, bu string, salaire_brut decimal(12,2), "
                                     "moyen_deplacement string, distance_resolved_m int")
    return ST.apply_geo(df, BenefitParams(pii_salt="s", as_of=AS_OF))


def test_prime_golden(spark, employees):
    p = {r.id_employee: r for r in B.compute_prime(employees, BenefitParams(pii_salt="s", as_of=AS_OF)).collect()}
    assert [k for k, r in p.items() if r.is_eligible] == [1]
    assert p[1].prime_amount == Decimal("1500.00")
    assert p[1].reason == "OK — transport actif + déclaration cohérente"
    assert "suspecte" in p[2].reason and not p[2].is_eligible
    assert "non actif" in p[3].reason and p[3].prime_amount == Decimal("0.00")


def test_prime_new_rate(spark, employees):
    p = {r.id_employee: r for r in
         B.compute_prime(employees, BenefitParams(pii_salt="s", prime_rate=Decimal("0.07"), as_of=AS_OF)).collect()}
    assert p[1].prime_amount == Decimal("2100.00")


@pytest.mark.parametrize("threshold,eligible", [(15, 1), (16, 0)])
def test_wellbeing_threshold_boundary(spark, employees, threshold, eligible):
    acts = spark.createDataFrame([(1, AS_OF - dt.timedelta(days=d + 1)) for d in range(15)],
                                 "id_employee long, start_dt timestamp_ntz")
    w = B.compute_wellbeing(employees, acts, BenefitParams(pii_salt="s", wellbeing_threshold=threshold, as_of=AS_OF))
    rows = {r.id_employee: r for r in w.collect()}
    assert sum(r.is_eligible for r in rows.values()) == eligible
    assert rows[1].activity_count == 15 and rows[3].activity_count == 0
    assert rows[1].days_granted == (5 if eligible else 0)
    assert rows[1].reason == (f"OK — 15 activités sur 12 mois" if eligible
                              else f"KO — 15 activités < seuil {threshold}")


def test_window_edge_excludes_old(spark, employees):
    acts = spark.createDataFrame([(1, AS_OF - dt.timedelta(days=365)), (1, AS_OF - dt.timedelta(days=366))],
                                 "id_employee long, start_dt timestamp_ntz")
    rows = {r.id_employee: r for r in B.compute_wellbeing(employees, acts, BenefitParams(pii_salt="s", as_of=AS_OF)).collect()}
    assert rows[1].activity_count == 1


def test_params_bounds():
    with pytest.raises(ValueError):
        BenefitParams(pii_salt="s", prime_rate=Decimal("1.5"))
    with pytest.raises(ValueError):
        BenefitParams(pii_salt="s", wellbeing_threshold=0)
    with pytest.raises(ValueError):
        BenefitParams(pii_salt="s", walking_max_km=0)
