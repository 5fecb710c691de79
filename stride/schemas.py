"""Schemas, header contracts and fixed business values.

Everything under "FIXED VALUES" must equal the source system's values for the
results to match (labels, messages, limits, coordinates).  They are stated
plainly, in natural order, and are not derived from anything.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — labels, texts and limits of the benefit rules
# ---------------------------------------------------------------------------

# Commute modes accepted by the staging enum, in declaration order.
TRANSPORT_MODES = (
    "Marche/running",
    "Vélo/Trottinette/Autres",
    "Transports en commun",
    "véhicule thermique/électrique",
)
# Active commute modes (bonus candidates).
ACTIVE_TRANSPORTS = ("Marche/running", "Vélo/Trottinette/Autres")

# Commute label normalisation: trimmed lower-case form -> canonical label.
# Unknown labels pass through unchanged.
TRANSPORT_NORMALIZE = {
    "marche/running": "Marche/running",
    "vélo/trottinette/autres": "Vélo/Trottinette/Autres",
    "velo/trottinette/autres": "Vélo/Trottinette/Autres",
    "transports en commun": "Transports en commun",
    "véhicule thermique/électrique": "véhicule thermique/électrique",
    "vehicule thermique/electrique": "véhicule thermique/électrique",
}

# Routing mode per active commute mode, and the plausibility limit in km.
ACTIVE_MODE_ROUTING = {
    "Marche/running": "walking",
    "Vélo/Trottinette/Autres": "bicycling",
}
# Routing modes, step statuses and logged operations that the tables accept.
ROUTING_MODES = ("walking", "bicycling", "driving", "transit")
STEP_STATUSES = ("OK", "WARN", "FAIL")
CHANGE_OPERATIONS = ("INSERT", "UPDATE", "DELETE")

DEFAULT_WALKING_MAX_KM = 15.0
DEFAULT_CYCLING_MAX_KM = 25.0

# Canonical sport labels, in declaration order.
SPORTS = (
    "Tennis",
    "Course à pied",
    "Vélo",
    "Randonnée",
    "Natation",
    "Football",
    "Escalade",
    "Yoga",
    "Crossfit",
    "Marche",
)
# Synonyms accepted after the case-insensitive canonical match.
SPORT_SYNONYMS = {
    "running": "Course à pied",
    "course": "Course à pied",
    "velo": "Vélo",
    "rando": "Randonnée",
    "swim": "Natation",
    "foot": "Football",
}
# Canonical sport label -> activity API sport code.
SPORT_TO_CODE = {
    "Tennis": "Tennis",
    "Course à pied": "Run",
    "Vélo": "Ride",
    "Randonnée": "Hike",
    "Natation": "Swim",
    "Football": "Soccer",
    "Escalade": "RockClimbing",
    "Yoga": "Yoga",
    "Crossfit": "Crossfit",
    "Marche": "Walk",
}
# Sports recorded without a distance.
SPORTS_WITHOUT_DISTANCE = ("Tennis", "Football", "Escalade", "Yoga", "Crossfit")

# Bonus reasons (eligible / suspect declaration / inactive commute).
REASON_PRIME_OK = "OK — transport actif + déclaration cohérente"
REASON_PRIME_SUSPECT = "KO — déclaration suspecte (distance hors seuil)"
REASON_PRIME_INACTIVE = "KO — transport non actif"
# Wellbeing reasons: "OK — <n> activités sur 12 mois" / "KO — <n> activités < seuil <t>".
REASON_WB_OK_PREFIX = "OK — "
REASON_WB_OK_SUFFIX = " activités sur 12 mois"
REASON_WB_KO_PREFIX = "KO — "
REASON_WB_KO_MIDDLE = " activités < seuil "

WELLBEING_DAYS_GRANTED = 5
DEFAULT_PRIME_RATE = "0.05"
DEFAULT_WELLBEING_THRESHOLD = 15
WELLBEING_WINDOW_DAYS = 365

# Salary bands: right-open bins.
SALARY_BANDS = ((30000, "< 30k"), (50000, "30-50k"), (80000, "50-80k"))
SALARY_BAND_TOP = "> 80k"

# Company location (latitude, longitude) and the earth radius in metres.
COMPANY_COORDS = (43.5667, 3.9000)
EARTH_RADIUS_M = 6_371_000

# Local time zone of the company and its label in activity payloads.
LOCAL_TZ = "Europe/Paris"
LOCAL_TZ_LABEL = "(GMT+01:00) Europe/Paris"
RAW_ACTIVITY_SOURCE = "strava_sim"

# Notification templates ({prenom} {nom} {sport_lower} {distance} {duree}).
MESSAGE_TEMPLATES = (
    "Bravo {prenom} {nom} ! Tu viens de faire {sport_lower} sur {distance} en {duree} ! Quelle énergie ! 🔥🏅",
    "Magnifique {prenom} {nom} ! Une session de {sport_lower} de {distance} terminée en {duree} ! 🌄",
    "Allez {prenom} {nom} ! Encore une activité {sport_lower} de {distance} bouclée en {duree} 💪",
    "{prenom} {nom} est en feu ! {sport_lower} : {distance} en {duree} 🚴‍♂️",
)
DISTANCE_NONE_TEXT = "session"

# Quality-suite bounds.
SALARY_MIN, SALARY_MAX = 10000, 300000
LEAVE_DAYS_MIN, LEAVE_DAYS_MAX = 0, 60
ACTIVITY_DISTANCE_MIN, ACTIVITY_DISTANCE_MAX = 0, 200_000
MOVING_TIME_MIN, MOVING_TIME_MAX = 0, 86_400
ACTIVITY_MIN_START = "2024-01-01 00:00:00"
MIN_RAW_ACTIVITIES = 500

# ---------------------------------------------------------------------------
# Header contracts of the input files
# ---------------------------------------------------------------------------

# HR file: ordered header -> column name.
HR_COLUMN_MAP = {
    "ID salarié": "id_salarie",
    "Nom": "nom",
    "Prénom": "prenom",
    "Date de naissance": "date_naissance",
    "BU": "bu",
    "Date d'embauche": "date_embauche",
    "Salaire brut": "salaire_brut",
    "Type de contrat": "type_contrat",
    "Nombre de jours de CP": "jours_cp",
    "Adresse du domicile": "adresse_domicile",
    "Moyen de déplacement": "moyen_deplacement",
}
# Sport file: unordered header set -> column name.
SPORT_COLUMN_MAP = {
    "ID salarié": "id_salarie",
    "Pratique d'un sport": "sport_pratique",
}

# ---------------------------------------------------------------------------
# Table schemas (Spark)
# ---------------------------------------------------------------------------

HR_FILE_SCHEMA = T.StructType([
    T.StructField("ID salarié", T.LongType()),
    T.StructField("Nom", T.StringType()),
    T.StructField("Prénom", T.StringType()),
    T.StructField("Date de naissance", T.StringType()),
    T.StructField("BU", T.StringType()),
    T.StructField("Date d'embauche", T.StringType()),
    T.StructField("Salaire brut", T.DecimalType(12, 2)),
    T.StructField("Type de contrat", T.StringType()),
    T.StructField("Nombre de jours de CP", T.IntegerType()),
    T.StructField("Adresse du domicile", T.StringType()),
    T.StructField("Moyen de déplacement", T.StringType()),
])

SPORT_FILE_SCHEMA = T.StructType([
    T.StructField("ID salarié", T.LongType()),
    T.StructField("Pratique d'un sport", T.StringType()),
])

# Raw activity payload (JSON document).
ACTIVITY_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("athlete", T.StructType([T.StructField("id", T.LongType())])),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("sport_type", T.StringType()),
    T.StructField("distance", T.LongType()),
    T.StructField("moving_time", T.LongType()),
    T.StructField("elapsed_time", T.LongType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("start_date_local", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("comment", T.StringType()),
])

# The same document read with its numbers as text: the flatten casts them
# itself, strictly (a non-integer raises) or leniently (NULL, counted).
PAYLOAD_REQUIRED_FIELDS = ("start_date", "elapsed_time")
PAYLOAD_INT_FIELDS = ("id", "distance", "moving_time", "elapsed_time")
ACTIVITY_PAYLOAD_TEXT_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType()) if f.name in PAYLOAD_INT_FIELDS
    else T.StructField("athlete", T.StructType([T.StructField("id", T.StringType())])) if f.name == "athlete"
    else f
    for f in ACTIVITY_PAYLOAD_SCHEMA.fields
])

RAW_ACTIVITIES_SCHEMA = T.StructType([
    T.StructField("activity_id", T.LongType(), False),
    T.StructField("athlete_id", T.LongType(), False),
    T.StructField("payload", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
])

# Run-log rows as written by the step wrapper (wall-clock UTC, no zone).
RUN_LOG_SCHEMA_NTZ = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("step_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType(), False),
])

# Cached answers of the distance service.
DISTANCE_CACHE_SCHEMA = T.StructType([
    T.StructField("address_hash", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("distance_m", T.IntegerType()),
    T.StructField("duration_s", T.IntegerType()),
    T.StructField("resolved_at", T.TimestampNTZType()),
])
