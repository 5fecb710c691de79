"""Bindings of the driver tables to the pipeline's roles.

The driver's parquet tables stand in for the HR file, the sport file, the raw
activity documents, the staging activities and the run log.  Each binding is a
pure projection of one table (no join, no driver-side data), so its cost grows
with that table and Catalyst prunes the columns it does not need.

Binding choices (all deterministic):

* employees      <- customer: id ``c_custkey``, address ``c_name``, unit
  ``c_mktsegment``, salary ``10000 + abs(c_acctbal) * 10``, commute mode from
  ``c_nationkey % 4`` (label spelling varies with ``c_nationkey / 4``), resolved
  commute distance ``(c_custkey * 7919) % 40000`` metres, unresolved for every 50th.
* activities     <- orders: id ``o_orderkey``, employee ``o_custkey``, start
  ``o_orderdate``, category ``o_orderpriority``.
* raw documents  <- events: one JSON activity document per event.
* posted ids     <- events: every 7th was posted by an earlier run.
* sport file     <- distinct (user_id, declared label of event_type).
* run log        <- events: one step row per event (step = event type).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C

# Binding tables of this repository (not source-system values).
COMMUTE_LABEL_SPELLINGS = (
    # index = c_nationkey % 4; spelling chosen by (c_nationkey / 4) % 3
    ("Marche/running", "MARCHE/RUNNING", "  marche/running\t"),
    ("Vélo/Trottinette/Autres", "VÉLO/TROTTINETTE/AUTRES", " velo/trottinette/autres "),
    ("Transports en commun", "TRANSPORTS EN COMMUN", "transports en commun "),
    ("véhicule thermique/électrique", "VÉHICULE THERMIQUE/ÉLECTRIQUE", "vehicule thermique/electrique"),
)
EVENT_SPORT = {
    "view": "Marche",
    "click": "Course à pied",
    "signup": "Vélo",
    "purchase": "Natation",
    "error": "Escalade",
}
EVENT_DECLARED_SPORT = {
    "view": "MARCHE",
    "click": "running",
    "signup": " velo ",
    "purchase": "Pétanque",
    # "error" declares nothing (NULL)
}
ACTIVITY_NO_DISTANCE_CATEGORY = "4-NOT SPECIFIED"
ACTIVITY_COMMENT_BY_STATUS = {"P": "Order still being filled"}
EVENT_COMMENT_TEXT = "Every tenth key"
DISTANCE_MULTIPLIER = 7919
DISTANCE_MODULUS = 40000
UNRESOLVED_EVERY, UNRESOLVED_AT = 50, 13
POSTED_EVERY = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- employees ------------------------------------------------------------

def commute_label(nationkey: Column) -> Column:
    """Raw commute label as it appears in the HR file."""
    mode = F.pmod(nationkey, F.lit(4))
    spelling = F.pmod(F.floor(nationkey / 4), F.lit(3)).cast("int")
    arr = F.array(*[F.array(*[F.lit(s) for s in row]) for row in COMMUTE_LABEL_SPELLINGS])
    return F.element_at(F.element_at(arr, (mode + 1).cast("int")), spelling + 1)


def hr_file(customer: DataFrame) -> DataFrame:
    """HR file columns (already renamed) plus the commute geo answers."""
    key = F.col("c_custkey")
    return customer.select(
        key.alias("id_salarie"),
        F.substring_index("c_name", "#", 1).alias("nom"),
        F.substring_index("c_name", "#", -1).alias("prenom"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(key, F.lit(14000)).cast("int")).alias("date_naissance"),
        F.col("c_mktsegment").alias("bu"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(key * 37, F.lit(9000)).cast("int")).alias("date_embauche"),
        salary_from_balance(F.col("c_acctbal")).alias("salaire_brut"),
        F.when(F.col("c_acctbal") >= 0, F.lit("CDI")).otherwise(F.lit("CDD")).alias("type_contrat"),
        F.col("c_nationkey").cast("int").alias("jours_cp"),
        F.col("c_name").alias("adresse_domicile"),
        commute_label(F.col("c_nationkey")).alias("moyen_deplacement"),
        # answers of the distance service (none for some addresses) and home coordinates for this address
        F.when(F.pmod(key, F.lit(UNRESOLVED_EVERY)) != UNRESOLVED_AT,
               F.pmod(key * DISTANCE_MULTIPLIER, F.lit(DISTANCE_MODULUS)).cast("int")).alias("distance_resolved_m"),
        (F.lit(43.0) + F.pmod(key, F.lit(1000)) / 1000.0).alias("home_lat"),
        (F.lit(3.0) + F.pmod(key * 7, F.lit(1000)) / 1000.0).alias("home_lon"),
    )


def salary_from_balance(acctbal: Column) -> Column:
    """Staging salary of the binding: 10,000 and ten times ``abs(balance)`` to cents (inside the suite's range)."""
    return (F.abs(acctbal).cast("decimal(12,2)") * 10 + 10000).cast("decimal(12,2)")


# -- activities -------------------------------------------------------------

def elapsed_from_price(price: Column) -> Column:
    return (F.pmod(F.floor(price), F.lit(7200)) + 600).cast("int")


def activities(orders: DataFrame) -> DataFrame:
    """Staging activities bound to orders (one activity per order)."""
    elapsed = elapsed_from_price(F.col("o_totalprice"))
    start = F.col("o_orderdate")
    category = F.col("o_orderpriority")
    comment = F.try_element_at(C.literal_map(ACTIVITY_COMMENT_BY_STATUS), F.col("o_orderstatus"))
    return orders.select(
        F.col("o_orderkey").alias("id_activity"),
        F.col("o_orderkey").alias("source_activity_id"),
        F.col("o_custkey").alias("id_employee"),
        start.alias("start_dt"),
        C.plus_seconds(start, elapsed).alias("end_dt"),
        category.alias("sport_type"),
        F.when(category == ACTIVITY_NO_DISTANCE_CATEGORY, F.lit(None).cast("int"))
         .otherwise(F.pmod(F.floor(F.col("o_totalprice")), F.lit(20000)).cast("int")).alias("distance_m"),
        F.floor(elapsed * 9 / 10).cast("int").alias("moving_time_s"),
        comment.alias("comment"),
        F.lit(False).alias("posted_to_slack"),
    )


# -- raw activity documents ---------------------------------------------------

def event_activity_fields(events: DataFrame) -> DataFrame:
    """Flat activity fields derived from events (input of the JSON builder)."""
    sport = F.try_element_at(C.literal_map(EVENT_SPORT), F.col("event_type"))
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    elapsed = (F.floor(F.col("value") * 60) + 60).cast("bigint")
    return events.select(
        F.col("event_id").alias("activity_id"),
        F.col("user_id").alias("athlete_id"),
        sport.alias("sport"),
        F.when(sport.isin(*S.SPORTS_WITHOUT_DISTANCE), F.lit(None).cast("bigint"))
         .otherwise((k * 100).cast("bigint")).alias("distance"),
        F.floor(elapsed * 9 / 10).cast("bigint").alias("moving_time"),
        elapsed.alias("elapsed_time"),
        F.col("ts").alias("start"),
        F.when(F.pmod(k, F.lit(10)) == 0, F.lit(EVENT_COMMENT_TEXT)).alias("comment"),
    )


def event_staging(events: DataFrame) -> DataFrame:
    """Staging activities of the event documents, read as the staging table
    holds them: the same rows ``flatten_payloads(build_payloads(...))``
    produces (that round trip is checked against this projection), without
    rebuilding and re-parsing the JSON for every query that reads them."""
    f = event_activity_fields(events)
    return f.select(
        F.col("activity_id").alias("source_activity_id"),
        F.col("athlete_id").alias("id_employee"),
        F.col("start").alias("start_dt"),
        C.plus_seconds(F.col("start"), F.col("elapsed_time")).alias("end_dt"),
        F.col("sport").alias("sport_type"),
        F.col("distance").cast("int").alias("distance_m"),
        F.col("moving_time").cast("int").alias("moving_time_s"),
        F.col("comment"),
        F.lit(False).alias("posted_to_slack"),
    )


def posted_before(events: DataFrame) -> DataFrame:
    """Delivery state that an earlier run left: (id_activity, run_id, posted_at)."""
    return events.filter(F.pmod("event_id", F.lit(POSTED_EVERY)) == 0).select(
        F.col("event_id").alias("id_activity"), F.lit("run-0000").alias("run_id"), F.col("ts").alias("posted_at"))


def sport_file(events: DataFrame) -> DataFrame:
    """Sport file rows: (id_salarie, sport_pratique), one per event (duplicates kept)."""
    declared = F.try_element_at(C.literal_map(EVENT_DECLARED_SPORT), F.col("event_type"))
    return events.select(F.col("user_id").alias("id_salarie"), declared.alias("sport_pratique"))


# -- run log -------------------------------------------------------------------

def run_log(events: DataFrame) -> DataFrame:
    """Run-log rows bound to events: one run per day, one step per event."""
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    return events.select(
        F.concat(F.lit("run-"), F.date_format(F.col("ts"), "yyyyMMdd")).alias("run_id"),
        F.col("event_type").alias("step_name"),
        F.when(F.col("event_type") == "error", F.lit("FAIL")).otherwise(F.lit("OK")).alias("status"),
        k.alias("rows_in"),
        k.alias("rows_out"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.col("ts").alias("started_at"),
    )
