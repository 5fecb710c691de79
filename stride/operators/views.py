"""BI views and aggregates (AGG-*, JON-4/5/6, PRJ-17, SRT-*, MON-3)."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .staging import trailing_window


def employees_safe(employees: DataFrame) -> DataFrame:
    """PRJ-16/17: masked view — pseudonym and salary band, no names, salary or address."""
    return employees.select(
        "id_employee",
        F.col("nom_hash").alias("employee_hash"),
        "bu",
        C.salary_band("salaire_brut").alias("salary_band"),
        "moyen_deplacement",
        "distance_domicile_m",
        "is_declaration_suspect",
    )


def _kpi_by_unit(rows: DataFrame) -> DataFrame:
    """Second half of the unit KPI from one row per (bu, id_employee)."""
    return rows.groupBy("bu").agg(
        F.count("id_employee").alias("nb_employees"),
        F.count(F.when(F.col("_p"), F.col("id_employee"))).alias("nb_eligible_prime"),
        F.count(F.when(F.col("_w"), F.col("id_employee"))).alias("nb_eligible_wellbeing"),
        F.coalesce(F.sum("_amt"), F.lit(0)).cast("decimal(38,2)").alias("total_prime_cost_eur"),
        F.coalesce(F.sum("_days"), F.lit(0)).cast("bigint").alias("total_wellbeing_days"),
    )


def kpi_by_bu(employees: DataFrame, prime: DataFrame, wellbeing: DataFrame) -> DataFrame:
    """JON-4 + AGG-2: unit KPI over two left joins onto the employee key.

    ``COUNT(DISTINCT id) FILTER (...)`` is computed as a group by
    (bu, id) followed by a group by bu: the first aggregate dedupes employee
    rows (partially, before its shuffle), the second shuffles one partial
    row per unit and task — no Expand of the input for the three distinct
    counts.  ``kpi_by_bu_fused`` avoids the joins altogether when the marts
    are computed on the employee row.
    """
    p = prime.select("id_employee", F.col("is_eligible").alias("p_elig"), "prime_amount")
    w = wellbeing.select("id_employee", F.col("is_eligible").alias("w_elig"), "days_granted")
    joined = (employees.select("id_employee", "bu")
              .join(p, "id_employee", "left")
              .join(w, "id_employee", "left"))
    per_emp = (joined.filter(F.col("id_employee").isNotNull())
               .groupBy("bu", "id_employee").agg(
                   F.max(F.coalesce("p_elig", F.lit(False))).alias("_p"),
                   F.max(F.coalesce("w_elig", F.lit(False))).alias("_w"),
                   F.sum(F.when(F.col("p_elig"), F.col("prime_amount"))).alias("_amt"),
                   F.sum(F.when(F.col("w_elig"), F.col("days_granted"))).alias("_days")))
    return _kpi_by_unit(per_emp)


def kpi_by_bu_fused(benefits: DataFrame) -> DataFrame:
    """AGG-2 over the fused benefit frame (employee key unique: no re-grouping)."""
    rows = benefits.select(
        "bu", "id_employee",
        F.col("p_is_eligible").alias("_p"),
        F.col("w_is_eligible").alias("_w"),
        F.when(F.col("p_is_eligible"), F.col("p_prime_amount")).alias("_amt"),
        F.when(F.col("w_is_eligible"), F.col("w_days_granted")).alias("_days"),
    )
    return _kpi_by_unit(rows)


def kpi_global(safe: DataFrame, prime: DataFrame, wellbeing: DataFrame) -> DataFrame:
    """AGG-3: one-row KPI; each table is read once with fused conditional
    aggregates; the bonus and wellbeing figures join the employee row as
    scalar subqueries (each a one-row aggregate, run once)."""
    p = prime.agg(
        F.count_if(F.col("is_eligible")).alias("n"),
        F.coalesce(F.sum(F.when(F.col("is_eligible"), F.col("prime_amount"))), F.lit(0))
         .cast("decimal(38,2)").alias("cost"))
    w = wellbeing.agg(
        F.count_if(F.col("is_eligible")).alias("n"),
        F.coalesce(F.sum(F.when(F.col("is_eligible"), F.col("days_granted"))), F.lit(0))
         .cast("bigint").alias("days"))
    e = safe.agg(F.count(F.lit(1)).alias("nb_salaries"),
                 F.count_if(F.col("is_declaration_suspect")).alias("nb_declarations_suspectes"))
    return e.select(
        "nb_salaries",
        p.select("n").scalar().alias("nb_eligibles_prime"),
        p.select("cost").scalar().alias("cout_prime_eur"),
        w.select("n").scalar().alias("nb_eligibles_bienetre"),
        w.select("days").scalar().alias("jours_bienetre"),
        "nb_declarations_suspectes")


def int_div(a: F.Column, b: F.Column) -> F.Column:
    """Exact floor division of non-negative integers as decimal(38,0):
    ``(a - a mod b) / b`` divides exactly, so no rounding step is involved."""
    a, b = a.cast("decimal(38,0)"), b.cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def rounded_ratio(num: F.Column, den: F.Column, scale: int, out: str | None = None) -> F.Column:
    """``ROUND(num / den, scale)`` half up for ``num >= 0``, exact at any volume
    (integer arithmetic, no double rounding); NULL when ``den`` is 0."""
    f = 10 ** scale
    units = int_div(num.cast("decimal(38,0)") * (2 * f) + den, den.cast("decimal(38,0)") * 2)
    value = units / F.lit(f).cast("decimal(38,0)")
    return F.when(den > 0, value.cast(out or f"decimal(38,{scale})"))


def exact_avg_km(sum_m: F.Column, n: F.Column) -> F.Column:
    """ROUND(AVG(m) / 1000, 2) on exact integers (half up), NULL when n = 0."""
    return rounded_ratio(sum_m, n * 1000, 2, "decimal(12,2)")


def activities_by_sport(activities: DataFrame, as_of: dt.datetime, days: int = 365) -> DataFrame:
    """AGG-4: per category over the trailing window: count, distinct employees,
    mean distance in km (NULL distances ignored, all NULL -> NULL)."""
    recent = trailing_window(activities, "start_dt", as_of, days)
    return recent.groupBy(F.col("sport_type").alias("sport")).agg(
        F.count(F.lit(1)).alias("nb_activites"),
        F.count_distinct("id_employee").alias("nb_salaries"),
        exact_avg_km(F.sum(F.col("distance_m").cast("bigint")), F.count("distance_m"))
         .alias("distance_moyenne_km"),
    ).orderBy(F.desc("nb_activites"), "sport")


def prime_detail(safe: DataFrame, prime: DataFrame) -> DataFrame:
    """JON-5: masked employee view joined to the bonus mart."""
    return safe.join(prime, "id_employee").select(
        F.col("id_employee").alias("id_salarie"), "bu",
        F.col("salary_band").alias("tranche_salaire"),
        "moyen_deplacement", "distance_domicile_m",
        F.col("is_eligible").alias("eligible"),
        F.col("prime_rate").alias("taux"),
        F.col("prime_amount").alias("montant_prime_eur"),
        F.col("reason").alias("motif"))


def wellbeing_detail(safe: DataFrame, wellbeing: DataFrame) -> DataFrame:
    """JON-6: masked employee view joined to the wellbeing mart."""
    return safe.join(wellbeing, "id_employee").select(
        F.col("id_employee").alias("id_salarie"), "bu",
        F.col("activity_count").alias("nb_activites"),
        F.col("threshold").alias("seuil"),
        F.col("is_eligible").alias("eligible"),
        F.col("days_granted").alias("jours_accordes"),
        F.col("reason").alias("motif"))


def step_health(run_log: DataFrame) -> DataFrame:
    """MON-3: renamed projection of the run log, latest first (rows of one time by run, step and message)."""
    return run_log.select(
        "run_id",
        F.col("step_name").alias("etape"),
        F.col("status").alias("statut"),
        F.col("rows_in").alias("lignes_entree"),
        F.col("rows_out").alias("lignes_sortie"),
        F.col("duration_ms").alias("duree_ms"),
        F.col("started_at").alias("demarre_a"),
        "message",
    ).orderBy(F.desc("demarre_a"), "run_id", "etape", "message")


def latest(df: DataFrame, ts_col: str, n: int, *tiebreak: str) -> DataFrame:
    """SRT-2/4: latest-first top-n (TakeOrderedAndProject: a bounded heap per task)."""
    return df.orderBy(F.desc(ts_col), *[F.asc(t) for t in tiebreak]).limit(n)


def rate_summary(prime: DataFrame) -> DataFrame:
    """AGG-5: per rate: eligible count, total amount."""
    return prime.groupBy("prime_rate").agg(
        F.count_if(F.col("is_eligible")).alias("nb_eligible"),
        F.sum("prime_amount").cast("decimal(38,2)").alias("cout_total"),
    ).orderBy("prime_rate")


def what_if_cost(detail: DataFrame, new_rate: Decimal) -> DataFrame:
    """AGG-8: projected cost ``SUM(amount) / rate * new_rate`` over eligible rows.

    Amounts are summed exactly per rate (as cents); the ratio of the two rates
    is a ratio of integers, rounded half up once per rate, so the last cent does
    not depend on the order of the sum."""
    cents = (F.sum(F.col("montant_prime_eur").cast("decimal(38,2)")) * 100).cast("decimal(38,0)")
    per_rate = (detail.filter(F.col("eligible") & (F.col("taux") > 0)).groupBy("taux").agg(cents.alias("cents"))
                .select(rounded_ratio(F.col("cents") * int(new_rate * 10000), (F.col("taux") * 10000).cast("decimal(38,0)"), 0)
                        .alias("c")))
    return per_rate.agg((F.coalesce(F.sum("c"), F.lit(0)).cast("decimal(30,0)") * F.lit(Decimal("0.01")))
                        .cast("decimal(38,2)").alias("cout_projete"))


def kpi_by_cost(kpi: DataFrame) -> DataFrame:
    """SRT-3: the unit KPI, costliest unit first, with its place (one row per unit)."""
    by_cost = Window.orderBy(F.desc("total_prime_cost_eur"), "bu")
    return kpi.withColumn("place", F.row_number().over(by_cost)).orderBy("place")


def count_histogram(detail: DataFrame, column: str = "nb_activites") -> DataFrame:
    """AGG-9: distribution of a per-employee count."""
    return detail.groupBy(column).agg(F.count(F.lit(1)).alias("nb_salaries"))


def days_total(detail: DataFrame) -> DataFrame:
    """AGG-10: sum of granted days."""
    return detail.agg(F.coalesce(F.sum("jours_accordes"), F.lit(0)).cast("bigint").alias("total_jours"))


def step_durations(run_log: DataFrame) -> DataFrame:
    """AGG-11: duration by step."""
    return run_log.groupBy(F.col("step_name").alias("etape")).agg(
        F.count(F.lit(1)).alias("nb_runs"),
        F.sum("duration_ms").cast("bigint").alias("duree_totale_ms"),
        rounded_ratio(F.sum("duration_ms"), F.count("duration_ms"), 3, "decimal(20,3)")
         .alias("duree_moyenne_ms"))


def share(by_category: DataFrame, category: str, measure: str) -> DataFrame:
    """AGG-12: share of each category.  The total is a scalar subquery (a
    one-row aggregate run once), so no task ever holds all categories the
    way an unpartitioned window would; it is projected once and then
    referenced, so the plan holds one subquery."""
    total = by_category.agg(F.sum(measure)).scalar()
    with_total = by_category.select(category, measure, total.alias("_total"))
    return with_total.select(category, measure,
                             rounded_ratio(F.col(measure), F.col("_total"), 6, "decimal(8,6)").alias("part"))


def slice_detail(detail: DataFrame, bu: str | None = None, eligible: bool | None = None) -> DataFrame:
    """PRJ-27: BI slicer — optional unit and eligibility filters (pushed to the scan)."""
    out = detail
    if bu is not None:
        out = out.filter(F.col("bu") == F.lit(bu))
    if eligible is not None:
        out = out.filter(F.col("eligible") == F.lit(bool(eligible)))
    return out


def row_counts(df: DataFrame, predicate: F.Column, name: str = "filtered") -> DataFrame:
    """AGG-6: total and filtered row counts in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(predicate).alias(name))


def by_ids(df: DataFrame, key: str, ids) -> DataFrame:
    """PRJ-28: rows whose key is in ``ids`` — a left semi join when ``ids`` is
    a DataFrame (any size), ``isin`` for a short literal list."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")
    return df.filter(F.col(key).isin(list(ids)))
