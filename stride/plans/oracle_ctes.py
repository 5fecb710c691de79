"""Reference SQL for the catalog, runnable by DuckDB over the driver tables.

Each common table expression restates one binding or mart of
``stride.sources.bindings`` / ``stride.operators`` directly from the raw
tables, so a catalog query can be checked against an independent plan.
``compose(needs, body)`` prefixes a query body with the CTEs it names (and
their dependencies) in dependency order.
"""
from __future__ import annotations

ACTIVE = "('Marche/running', 'Vélo/Trottinette/Autres')"
SALT = "stride-salt"

# FIXED VALUES: the reason texts, by verdict.
REASONS = ("OK — transport actif + déclaration cohérente",
           "KO — déclaration suspecte (distance hors seuil)",
           "KO — transport non actif")


def bonus_sql(rate: str, run_id: str, computed_at: str, source: str) -> str:
    """The bonus mart at ``rate`` from rows of ``facts``: half-up cents of rate times salary for verdict 1."""
    texts = ", ".join(f"'{t}'" for t in REASONS)
    return f"""
  SELECT id_employee, verdict = 1 AS is_eligible, CAST({rate} AS DECIMAL(5,4)) AS prime_rate,
         CAST(if(verdict = 1, round(CAST({rate} AS DECIMAL(5,4)) * salaire_brut, 2), 0) AS DECIMAL(12,2)) AS prime_amount,
         [{texts}][verdict] AS reason, TIMESTAMP '{computed_at}' AS computed_at, '{run_id}' AS run_id
  FROM {source}"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    # staged employees (PRJ-1/2/5) with the resolved commute distance
    "emp": ((), f"""
  SELECT c_custkey AS id_employee,
         split_part(c_name, '#', 1) AS nom,
         split_part(c_name, '#', 2) AS prenom,
         sha256('{SALT}' || split_part(c_name, '#', 1) || split_part(c_name, '#', 2)) AS nom_hash,
         CAST(DATE '1960-01-01' + CAST(c_custkey % 14000 AS INTEGER) AS DATE) AS date_naissance,
         c_mktsegment AS bu,
         CAST(DATE '1995-01-01' + CAST((c_custkey * 37) % 9000 AS INTEGER) AS DATE) AS date_embauche,
         CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) * 10 + 10000 AS DECIMAL(12,2)) AS salaire_brut,
         CASE WHEN c_acctbal >= 0 THEN 'CDI' ELSE 'CDD' END AS type_contrat,
         CAST(c_nationkey AS INTEGER) AS jours_cp,
         c_name AS adresse_domicile,
         CASE c_nationkey % 4 WHEN 0 THEN 'Marche/running'
                              WHEN 1 THEN 'Vélo/Trottinette/Autres'
                              WHEN 2 THEN 'Transports en commun'
                              ELSE 'véhicule thermique/électrique' END AS moyen_deplacement,
         if(c_custkey % 50 = 13, NULL, CAST((c_custkey * 7919) % 40000 AS INTEGER)) AS distance_resolved_m,
         43.0 + (c_custkey % 1000) / 1000.0 AS home_lat,
         3.0 + ((c_custkey * 7) % 1000) / 1000.0 AS home_lon
  FROM customer"""),
    # PRJ-19: the limit of each active mode in metres; a mode without a limit is never suspect, an unresolved distance is
    "geo": (("emp",), """
  SELECT emp.*, if(l.limit_m IS NULL, NULL, distance_resolved_m) AS distance_domicile_m,
         l.limit_m IS NOT NULL AND coalesce(distance_resolved_m > l.limit_m, TRUE) AS is_declaration_suspect
  FROM emp LEFT JOIN (VALUES ('Marche/running', 15000), ('Vélo/Trottinette/Autres', 25000)) l(label, limit_m)
    ON l.label = moyen_deplacement"""),
    # one row of facts per employee: verdict 1 (bonus), 2 (suspect) or 3 (not an active mode), recent activities
    "facts": (("geo", "acts"), f"""
  SELECT geo.*, CASE WHEN NOT list_contains([{ACTIVE[1:-1]}], moyen_deplacement) THEN 3
                     WHEN is_declaration_suspect THEN 2 ELSE 1 END AS verdict,
         coalesce(recent.n, 0) AS n_recent
  FROM geo LEFT JOIN (SELECT id_employee AS who, CAST(count(*) AS INTEGER) AS n FROM acts
                      WHERE start_dt >= TIMESTAMP '2000-08-01 00:00:00' GROUP BY ALL) recent ON recent.who = geo.id_employee"""),
    # bonus mart at rate 0.05 (PRJ-12/13/14)
    "prime": (("facts",), bonus_sql("0.05", "run-0001", "2001-08-01 00:00:00", "facts")),
    # staging activities bound to orders
    "acts": ((), """
  SELECT o_orderkey AS id_activity,
         o_orderkey AS source_activity_id,
         o_custkey AS id_employee,
         o_orderdate AS start_dt,
         o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT) % 7200 + 600) AS end_dt,
         o_orderpriority AS sport_type,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 20000 AS INTEGER) END AS distance_m,
         CAST(floor((CAST(floor(o_totalprice) AS BIGINT) % 7200 + 600) * 9 / 10) AS INTEGER) AS moving_time_s,
         CASE WHEN o_orderstatus = 'P' THEN 'Order still being filled' END AS comment,
         FALSE AS posted_to_slack
  FROM orders"""),
    # wellbeing mart at threshold 3 (PRJ-15)
    "wb": (("facts",), """
  SELECT id_employee, n_recent > 2 AS is_eligible, n_recent AS activity_count, 3 AS threshold,
         5 * CAST(n_recent > 2 AS INTEGER) AS days_granted,
         format(if(n_recent > 2, 'OK — {} activités sur 12 mois', 'KO — {} activités < seuil 3'), n_recent) AS reason,
         TIMESTAMP '2001-08-01 00:00:00' AS computed_at, 'run-0001' AS run_id
  FROM facts"""),
    # PRJ-16/17 masked view: the band is the first whose upper end lies above the salary
    "safe": (("geo",), """
  SELECT id_employee, nom_hash AS employee_hash, bu,
         ['< 30k', '30-50k', '50-80k', '> 80k'][1 + len(list_filter([30000, 50000, 80000], lambda t: t <= salaire_brut))]
           AS salary_band,
         moyen_deplacement, distance_domicile_m, is_declaration_suspect
  FROM geo"""),
    # flat activity fields of the event documents
    "evf": ((), """
  SELECT event_id AS activity_id, user_id AS athlete_id, ts AS start,
         CASE event_type WHEN 'view' THEN 'Marche' WHEN 'click' THEN 'Course à pied'
                         WHEN 'signup' THEN 'Vélo' WHEN 'purchase' THEN 'Natation'
                         WHEN 'error' THEN 'Escalade' END AS sport,
         CASE event_type WHEN 'view' THEN 'Walk' WHEN 'click' THEN 'Run'
                         WHEN 'signup' THEN 'Ride' WHEN 'purchase' THEN 'Swim'
                         WHEN 'error' THEN 'RockClimbing' END AS code,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(floor(value * 60) + 60 AS BIGINT) AS elapsed_time
  FROM events"""),
    "evd": (("evf",), """
  SELECT activity_id, athlete_id, start, sport, code, elapsed_time,
         CASE WHEN sport IN ('Tennis', 'Football', 'Escalade', 'Yoga', 'Crossfit') THEN NULL
              ELSE CAST(k * 100 AS BIGINT) END AS distance,
         CAST(floor(elapsed_time * 9 / 10) AS BIGINT) AS moving_time,
         CASE WHEN k % 10 = 0 THEN 'Every tenth key' END AS comment
  FROM evf"""),
    # flattened event documents (PRJ-9/10)
    "evact": (("evd",), """
  SELECT activity_id AS source_activity_id, athlete_id AS id_employee,
         start AS start_dt, start + to_seconds(elapsed_time) AS end_dt,
         sport AS sport_type, CAST(distance AS INTEGER) AS distance_m,
         CAST(moving_time AS INTEGER) AS moving_time_s, comment, FALSE AS posted_to_slack
  FROM evd"""),
    # the same with the delivery state of an earlier run (every 7th was posted)
    "evstate": (("evact",), "SELECT * REPLACE (source_activity_id % 7 = 0 AS posted_to_slack) FROM evact"),
    # run log bound to events
    "runlog": ((), """
  SELECT 'run-' || strftime(ts, '%Y%m%d') AS run_id,
         event_type AS step_name,
         CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'OK' END AS status,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_in,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_out,
         CAST(floor(value * 1000) AS BIGINT) AS duration_ms,
         'event ' || CAST(event_id AS VARCHAR) AS message,
         ts AS started_at
  FROM events"""),
    # declared sport labels of the sport file
    "sportrows": ((), """
  SELECT user_id AS id_salarie,
         CASE event_type WHEN 'view' THEN 'MARCHE' WHEN 'click' THEN 'running'
                         WHEN 'signup' THEN ' velo ' WHEN 'purchase' THEN 'Pétanque' END AS sport_pratique
  FROM events"""),
}


def _order(needs: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen:
            return
        for dep in CTES[name][0]:
            visit(dep)
        seen.append(name)

    for n in needs:
        visit(n)
    return seen


def compose(needs: tuple[str, ...], body: str) -> str:
    """``WITH <needed CTEs> <body>``."""
    names = _order(needs)
    if not names:
        return body.strip()
    defs = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in names)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {defs},\n{body[5:]}"
    return f"WITH {defs}\n{body}"
