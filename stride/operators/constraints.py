"""The constraints of each table (QLT-13..17), checked when it is written.

``rules(name, read)`` gives the rules of a table; ``read`` returns the tables its
foreign keys point to.  A CHECK passes on NULL, as in SQL; columns that must not be
NULL say so.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from . import quality as Q

Read = Callable[[str], DataFrame]


def _not_null(*columns: str) -> list[Q.Rule]:
    return [Q.not_null(c) for c in columns]


def _at_least(column: str, low: int) -> Q.Rule:
    return Q.check(f"{column}_at_least_{low}", column, F.col(column) >= low)


def _one_of(column: str, values) -> Q.Rule:
    return Q.check(f"{column}_known", column, F.col(column).isin(*values))


def raw_file(read: Read) -> list[Q.Rule]:
    return _not_null("source_file", "loaded_at")


def raw_activities(read: Read) -> list[Q.Rule]:
    return [*Q.primary_key("activity_id"), *_not_null("athlete_id", "payload", "source")]


def employees(read: Read) -> list[Q.Rule]:
    return [*Q.primary_key("id_employee"),
            *_not_null("nom", "prenom", "nom_hash", "date_naissance", "bu", "date_embauche", "salaire_brut",
                       "type_contrat", "jours_cp", "adresse_domicile", "moyen_deplacement"),
            Q.check("salary_positive", "salaire_brut", F.col("salaire_brut") > 0), _at_least("jours_cp", 0),
            _one_of("moyen_deplacement", S.TRANSPORT_MODES), _at_least("distance_domicile_m", 0)]


def sports_practice(read: Read) -> list[Q.Rule]:
    return [*Q.primary_key("id_employee", "sport_pratique"),
            Q.foreign_key("id_employee", read("staging.employees"), "id_employee")]


def activities(read: Read) -> list[Q.Rule]:
    elapsed = F.timestamp_diff("SECOND", F.col("start_dt"), F.col("end_dt"))
    return [*Q.primary_key("id_activity"),
            Q.foreign_key("source_activity_id", read("raw.activities"), "activity_id"),
            Q.foreign_key("id_employee", read("staging.employees"), "id_employee"),
            *_not_null("id_employee", "start_dt", "end_dt", "sport_type", "posted_to_slack"),
            _at_least("moving_time_s", 0), _at_least("distance_m", 0),
            Q.check("end_after_start", "end_dt", F.col("end_dt") > F.col("start_dt")),
            Q.check("moving_within_elapsed", "moving_time_s", F.col("moving_time_s") <= elapsed)]


def posted_activities(read: Read) -> list[Q.Rule]:
    return _not_null("id_activity", "run_id", "posted_at")


def _mart(read: Read) -> list[Q.Rule]:
    return [*Q.primary_key("id_employee"), Q.foreign_key("id_employee", read("staging.employees"), "id_employee"),
            *_not_null("is_eligible", "reason", "computed_at", "run_id")]


def prime(read: Read) -> list[Q.Rule]:
    return [*_mart(read), *_not_null("prime_rate", "prime_amount"), _at_least("prime_amount", 0)]


def wellbeing(read: Read) -> list[Q.Rule]:
    return [*_mart(read), *_not_null("activity_count", "threshold", "days_granted"),
            _at_least("activity_count", 0), _at_least("days_granted", 0)]


def distance_cache(read: Read) -> list[Q.Rule]:
    return [*Q.primary_key("address_hash", "mode"), *_not_null("distance_m", "duration_s", "resolved_at"),
            _one_of("mode", S.ROUTING_MODES)]


def run_log(read: Read) -> list[Q.Rule]:
    return [*_not_null("run_id", "step_name", "status", "started_at"), _one_of("status", S.STEP_STATUSES)]


def eligibility_changes(read: Read) -> list[Q.Rule]:
    return [*_not_null("changed_at", "table_name", "operation"), _one_of("operation", S.CHANGE_OPERATIONS)]


TABLES: dict[str, Callable[[Read], list[Q.Rule]]] = {
    "raw.employees": raw_file,
    "raw.sports": raw_file,
    "raw.activities": raw_activities,
    "staging.employees": employees,
    "staging.sports_practice": sports_practice,
    "staging.activities": activities,
    "staging.posted_activities": posted_activities,
    "staging.distance_cache": distance_cache,
    "marts.eligibility_prime": prime,
    "marts.eligibility_wellbeing": wellbeing,
    "audit.run_log": run_log,
    "audit.eligibility_changes": eligibility_changes,
}


def rules(table: str, read: Read) -> list[Q.Rule]:
    return TABLES[table](read) if table in TABLES else []
