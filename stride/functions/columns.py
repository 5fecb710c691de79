"""Scalar rules as native Column expressions (PRJ-*).

Everything here compiles to Catalyst expressions and stays inside whole-stage
codegen; lookup tables are literal maps, so no join and no Python runs per row.
"""
from __future__ import annotations

import re
from decimal import Decimal
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: dict) -> Column:
    """A literal MAP column from a small fixed dict (constant-folded)."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` keeps tabs)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


# -- PRJ-2 / PRJ-3 / PRJ-4: label lookups -------------------------------------

def normalize_transport(c: ColumnOrName) -> Column:
    """Trimmed lower-case lookup; unknown labels pass through unchanged."""
    c = _c(c)
    key = F.lower(strip_ws(c))
    return F.coalesce(F.try_element_at(literal_map(S.TRANSPORT_NORMALIZE), key), c)


def _sport_lookup() -> dict:
    # Rule: every canonical label under its lower-case form, then the synonyms.
    table = {label.lower(): label for label in S.SPORTS}
    for k, v in S.SPORT_SYNONYMS.items():
        table.setdefault(k, v)
    return table


def normalize_sport(c: ColumnOrName) -> Column:
    """Case-insensitive canonical match, then synonyms; unknown -> NULL."""
    key = F.lower(strip_ws(_c(c)))
    return F.try_element_at(literal_map(_sport_lookup()), key)


def sport_code(c: ColumnOrName) -> Column:
    """Canonical sport label -> API code; a missing label is an error."""
    c = _c(c)
    code = F.try_element_at(literal_map(S.SPORT_TO_CODE), c)
    return F.coalesce(code, F.raise_error(F.concat(F.lit("unknown sport label: "),
                                                    F.coalesce(c, F.lit("NULL")))))


# -- PRJ-5 / PRJ-6: hashes -----------------------------------------------------

def salted_hash(salt: str, *cols: ColumnOrName) -> Column:
    """Hex SHA-256 of ``salt || col1 || col2 ...`` (64 characters)."""
    return F.sha2(F.concat(F.lit(salt), *[_c(c) for c in cols]), 256)


def address_hash(c: ColumnOrName) -> Column:
    """Unsalted key hash of the trimmed lower-cased address."""
    return F.sha2(F.lower(strip_ws(_c(c))), 256)


# -- PRJ-18 / PRJ-19: geography ------------------------------------------------

def haversine_m(lat1: ColumnOrName, lon1: ColumnOrName,
                lat2: ColumnOrName | float, lon2: ColumnOrName | float) -> Column:
    """Great-circle distance in metres, truncated to int."""
    to_col = lambda v: F.lit(float(v)) if isinstance(v, (int, float)) else _c(v)
    p1, l1 = F.radians(to_col(lat1)), F.radians(to_col(lon1))
    p2, l2 = F.radians(to_col(lat2)), F.radians(to_col(lon2))
    a = (F.pow(F.sin((p2 - p1) / 2), 2)
         + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2))
    return (F.lit(2.0 * S.EARTH_RADIUS_M) * F.asin(F.sqrt(a))).cast("int")


def distance_limit_m(mode: ColumnOrName, walking_max_km: float, cycling_max_km: float) -> Column:
    """Plausibility limit in metres for active modes, NULL otherwise."""
    mode = _c(mode)
    return (F.when(mode == S.ACTIVE_TRANSPORTS[0], F.lit(float(walking_max_km) * 1000))
             .when(mode == S.ACTIVE_TRANSPORTS[1], F.lit(float(cycling_max_km) * 1000)))


def plausibility(mode: ColumnOrName, distance_m: ColumnOrName,
                 walking_max_km: float, cycling_max_km: float) -> tuple[Column, Column]:
    """(distance_domicile_m, is_declaration_suspect).

    Not an active mode -> (NULL, false); unresolved distance -> (NULL, true);
    otherwise (d, d > limit) with a strict comparison.
    """
    limit = distance_limit_m(mode, walking_max_km, cycling_max_km)
    d = _c(distance_m)
    dist = F.when(limit.isNull(), F.lit(None).cast("int")).otherwise(d.cast("int"))
    suspect = (F.when(limit.isNull(), F.lit(False))
                .when(d.isNull(), F.lit(True))
                .otherwise(d.cast("double") > limit))
    return dist, suspect


# -- PRJ-12..16: benefit rules -------------------------------------------------

def is_active_commute(mode: ColumnOrName) -> Column:
    return _c(mode).isin(*S.ACTIVE_TRANSPORTS)


def prime_eligible(mode: ColumnOrName, suspect: ColumnOrName) -> Column:
    """``mode IN active AND COALESCE(suspect, FALSE) = FALSE`` (three-valued)."""
    return is_active_commute(mode) & (F.coalesce(_c(suspect), F.lit(False)) == F.lit(False))


def prime_amount(eligible: Column, rate: Decimal, salary: ColumnOrName) -> Column:
    """ROUND(rate * salary, 2) when eligible, else 0, as decimal(12,2)."""
    rate_lit = F.lit(Decimal(rate)).cast("decimal(5,4)")
    amount = F.round(rate_lit * _c(salary).cast("decimal(12,2)"), 2)
    return F.when(eligible, amount).otherwise(F.lit(0)).cast("decimal(12,2)")


def prime_reason(mode: ColumnOrName, suspect: ColumnOrName) -> Column:
    """Eligible / suspect / inactive, tested in that order."""
    active = is_active_commute(mode)
    return (F.when(prime_eligible(mode, suspect), F.lit(S.REASON_PRIME_OK))
             .when(active & (_c(suspect) == F.lit(True)), F.lit(S.REASON_PRIME_SUSPECT))
             .otherwise(F.lit(S.REASON_PRIME_INACTIVE)))


def wellbeing_reason(count: ColumnOrName, threshold: int) -> Column:
    n = _c(count).cast("string")
    return F.when(_c(count) >= F.lit(threshold),
                  F.concat(F.lit(S.REASON_WB_OK_PREFIX), n, F.lit(S.REASON_WB_OK_SUFFIX))) \
            .otherwise(F.concat(F.lit(S.REASON_WB_KO_PREFIX), n, F.lit(S.REASON_WB_KO_MIDDLE),
                                F.lit(str(int(threshold)))))


def salary_band(salary: ColumnOrName) -> Column:
    """Right-open bins; NULL falls in the top band, as in a CASE without ELSE NULL."""
    s = _c(salary)
    expr = None
    for upper, label in S.SALARY_BANDS:
        expr = F.when(s < upper, F.lit(label)) if expr is None else expr.when(s < upper, F.lit(label))
    return expr.otherwise(F.lit(S.SALARY_BAND_TOP))


# -- PRJ-8 / PRJ-10 / PRJ-11: time -----------------------------------------

def as_instant(ts: ColumnOrName) -> Column:
    """A wall-clock UTC timestamp (NTZ or LTZ) as an instant.  Requires the
    session zone UTC (``session.configure``), which every entry point sets."""
    return _c(ts).cast("timestamp")


def plus_seconds(ts: ColumnOrName, seconds: ColumnOrName) -> Column:
    """``ts + n seconds`` keeping the input timestamp type."""
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(seconds).cast("decimal(18,6)"))


def elapsed_seconds(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds between two timestamps, as int."""
    return F.timestamp_diff("SECOND", _c(start), _c(end)).cast("int")


def _iso_fraction(ts: Column) -> Column:
    # Microseconds are printed only when non-zero (ISO-8601 as Python prints it).
    micros = F.unix_micros(ts) - F.unix_seconds(ts) * 1_000_000
    return F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))) \
            .otherwise(F.lit(""))


def iso_utc_z(ts: ColumnOrName) -> Column:
    """UTC instant as ``YYYY-MM-DDTHH:MM:SS[.ffffff]Z``."""
    t = as_instant(ts)
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), _iso_fraction(t), F.lit("Z"))


def iso_local(ts: ColumnOrName, tz: str = S.LOCAL_TZ) -> Column:
    """Local wall time in ``tz`` with its UTC offset, e.g. ``...T09:09:00+01:00``."""
    t = as_instant(ts)
    local = F.from_utc_timestamp(t, tz)
    offset_min = ((F.unix_seconds(local) - F.unix_seconds(t)) / 60).cast("int")
    sign = F.when(offset_min < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(offset_min)
    offset = F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                      F.lpad((a % 60).cast("string"), 2, "0"))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), _iso_fraction(local), offset)


# -- PRJ-20 / PRJ-21 / PRJ-22: message rendering -------------------------------

def distance_text(distance_m: ColumnOrName) -> Column:
    """NULL -> 'session'; else km with one decimal, rounded half up on the decimal value."""
    d = _c(distance_m)
    km = F.round(d.cast("decimal(20,0)") / F.lit(1000), 1).cast("decimal(21,1)")
    return F.when(d.isNull(), F.lit(S.DISTANCE_NONE_TEXT)) \
            .otherwise(F.concat(km.cast("string"), F.lit(" km")))


def duration_text(seconds: ColumnOrName) -> Column:
    """``N min`` below an hour, else ``H h MM``; seconds are dropped."""
    minutes = F.floor(_c(seconds) / 60).cast("bigint")
    hours_part = F.concat((F.floor(minutes / 60)).cast("bigint").cast("string"), F.lit(" h "),
                          F.lpad(F.pmod(minutes, F.lit(60)).cast("string"), 2, "0"))
    return F.when(minutes >= 60, hours_part).otherwise(F.concat(minutes.cast("string"), F.lit(" min")))


_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def render_template(template: str, fields: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders of a fixed template with columns."""
    parts, pos = [], 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(fields[m.group(1)])
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def activity_message(key: ColumnOrName, prenom: ColumnOrName, nom: ColumnOrName,
                     sport: ColumnOrName, distance_m: ColumnOrName,
                     seconds: ColumnOrName, comment: ColumnOrName) -> Column:
    """One of the fixed templates, chosen by ``pmod(key, n)`` (deterministic),
    plus the ``("comment")`` suffix when the comment is not empty."""
    fields = {
        "prenom": _c(prenom),
        "nom": _c(nom),
        "sport_lower": F.lower(_c(sport)),
        "distance": distance_text(distance_m),
        "duree": duration_text(seconds),
    }
    rendered = [render_template(t, fields) for t in S.MESSAGE_TEMPLATES]
    idx = F.pmod(_c(key), F.lit(len(rendered))).cast("int") + 1
    body = F.element_at(F.array(*rendered), idx)
    comment = _c(comment)
    has_comment = comment.isNotNull() & (F.length(comment) > 0)
    return F.when(has_comment, F.concat(body, F.lit(' ("'), comment, F.lit('")'))).otherwise(body)
