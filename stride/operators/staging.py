"""Raw -> staging operators: typed projection, JSON flatten, sports staging,
surrogate keys."""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..params import BenefitParams
from ..session import work_path


class EmptyInputError(RuntimeError):
    """A step refuses to run on an empty input table."""


# -- employees --------------------------------------------------------------

def stage_employees(hr: DataFrame, params: BenefitParams,
                    salary: "F.Column | None" = None) -> DataFrame:
    """PRJ-1/2/5: typed staging projection of the HR file.

    Casts are ANSI (bad values raise); the commute label is normalised and the
    pseudonym is ``sha256(salt || nom || prenom)``.  Columns of ``hr`` that are
    not part of the contract (provenance, geo answers) are kept.
    """
    extra = [c for c in hr.columns if c not in S.HR_COLUMN_MAP.values()]
    salary_col = salary if salary is not None else F.col("salaire_brut").cast("decimal(12,2)")
    return hr.select(
        F.col("id_salarie").cast("bigint").alias("id_employee"),
        F.col("nom"),
        F.col("prenom"),
        C.salted_hash(params.pii_salt, "nom", "prenom").alias("nom_hash"),
        F.to_date("date_naissance").alias("date_naissance"),
        F.col("bu"),
        F.to_date("date_embauche").alias("date_embauche"),
        salary_col.alias("salaire_brut"),
        F.col("type_contrat"),
        F.col("jours_cp").cast("int").alias("jours_cp"),
        F.col("adresse_domicile"),
        C.normalize_transport("moyen_deplacement").alias("moyen_deplacement"),
        *extra,
    )


def apply_geo(employees: DataFrame, params: BenefitParams,
              distance_col: str = "distance_resolved_m",
              fallback: "F.Column | None" = None) -> DataFrame:
    """PRJ-19: set ``distance_domicile_m`` and ``is_declaration_suspect`` from a
    resolved distance column (NULL = unresolved).

    ``fallback`` (optional) is used where the distance is unresolved, e.g. the
    great-circle distance ``columns.haversine_m`` from home coordinates; by
    default an unresolved distance stays NULL and the declaration is suspect.
    """
    d = F.col(distance_col)
    if fallback is not None:
        d = F.coalesce(d, fallback)
    dist, suspect = C.plausibility("moyen_deplacement", d,
                                   params.walking_max_km, params.cycling_max_km)
    return employees.withColumns({"distance_domicile_m": dist, "is_declaration_suspect": suspect})


# -- activities ---------------------------------------------------------------

def ensure_not_empty(df: DataFrame, what: str) -> None:
    """SNK-3: raise on an empty input (a LIMIT 1 job, not a count)."""
    if df.isEmpty():
        raise EmptyInputError(f"{what} is empty — load it first")


def parse_documents(raw: DataFrame, *keep: str, column: str = "payload",
                    schema=S.ACTIVITY_PAYLOAD_SCHEMA) -> DataFrame:
    """SRC-5: the JSON payload parsed ONCE per row into top-level columns.

    The struct goes through a one-element ``inline`` generator: reading its
    fields straight off ``from_json`` lets the optimizer split the parse into
    one pruned parse per field (measured 3x slower on the event documents).
    """
    parsed = F.from_json(F.col(column), schema)
    return raw.select(*keep, F.inline(F.array(parsed)))


def json_int(text: "F.Column", field: str, strict: bool) -> "F.Column":
    """A JSON number read as text, as bigint.  Strict: a value that is not an
    integer (``"10.5"``, ``"abc"``) raises, like ``(payload->>'x')::int``;
    lenient: it becomes NULL (see ``rejected_documents``)."""
    value = text.try_cast("bigint")
    if not strict:
        return value
    bad = text.isNotNull() & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"invalid integer in payload field {field}: "), text))) \
            .otherwise(value)


def required(text: "F.Column", field: str, strict: bool) -> "F.Column":
    """A field every document must have; a malformed document has none of them."""
    if not strict:
        return text
    return F.when(text.isNull(), F.raise_error(F.concat(
        F.lit(f"missing payload field {field} in document "), F.col("activity_id").cast("string")))).otherwise(text)


def rejected_documents(raw: DataFrame) -> DataFrame:
    """Documents the strict flatten refuses (malformed, a required field missing,
    an integer field that is none), with the offending field names."""
    doc = parse_documents(raw, "activity_id", schema=S.ACTIVITY_PAYLOAD_TEXT_SCHEMA)
    texts = {f: F.col(f) for f in S.PAYLOAD_INT_FIELDS}
    texts["athlete.id"] = F.col("athlete")["id"]
    bad = [F.when(F.col(f).isNull(), F.lit(f)) for f in S.PAYLOAD_REQUIRED_FIELDS]
    bad += [F.when(t.isNotNull() & t.try_cast("bigint").isNull(), F.lit(f)) for f, t in texts.items()]
    return (doc.select("activity_id", F.array_compact(F.array(*bad)).alias("bad_fields"))
            .filter(F.size("bad_fields") > 0))


def flatten_payloads(raw: DataFrame, with_id: bool = False, strict: bool = True,
                     scratch: str | None = None, id_start: int = 1, keep: tuple = ()) -> DataFrame:
    """PRJ-9/10: typed projection of the JSON activity documents.

    start_dt is the UTC instant of ``start_date`` (wall clock, NTZ);
    end_dt = start_dt + elapsed_time seconds; JSON null -> NULL.  Integer
    fields are read as text and cast here: strictly by default (malformed
    documents, missing required fields and ``"10.5"`` raise), or leniently (NULL;
    ``rejected_documents`` lists them).  Columns ``keep`` of ``raw`` are carried.
    """
    doc = parse_documents(raw, "activity_id", "athlete_id", *keep, schema=S.ACTIVITY_PAYLOAD_TEXT_SCHEMA)
    start = required(F.col("start_date"), "start_date", strict).cast("timestamp").cast("timestamp_ntz")
    elapsed = json_int(required(F.col("elapsed_time"), "elapsed_time", strict), "elapsed_time", strict)
    out = doc.select(
        F.col("activity_id").alias("source_activity_id"),
        F.col("athlete_id").alias("id_employee"),
        start.alias("start_dt"),
        C.plus_seconds(start, elapsed).alias("end_dt"),
        F.col("name").alias("sport_type"),
        json_int(F.col("distance"), "distance", strict).cast("int").alias("distance_m"),
        json_int(F.col("moving_time"), "moving_time", strict).cast("int").alias("moving_time_s"),
        F.col("comment").alias("comment"),
        F.lit(False).alias("posted_to_slack"),
        *keep,
    )
    if with_id:
        # number narrow rows, already parsed and written: ranging them twice (a range
        # exchange samples its input) would parse every document twice
        out = written(out, scratch)
        out = surrogate_key(out, ["start_dt", "source_activity_id"], "id_activity",
                            start=id_start, scratch=scratch)
    return out


def build_payloads(fields: DataFrame, source: str = S.RAW_ACTIVITY_SOURCE) -> DataFrame:
    """PRJ-7/8 + SNK-4: raw documents from flat fields.

    ``fields``: activity_id, athlete_id, sport (canonical label), distance,
    moving_time, elapsed_time, start (UTC wall clock), comment.  NULL fields
    are written as JSON nulls.
    """
    doc = F.struct(
        F.col("activity_id").alias("id"),
        F.struct(F.col("athlete_id").alias("id")).alias("athlete"),
        F.col("sport").alias("name"),
        C.sport_code("sport").alias("type"),
        C.sport_code("sport").alias("sport_type"),
        F.col("distance").alias("distance"),
        F.col("moving_time").alias("moving_time"),
        F.col("elapsed_time").alias("elapsed_time"),
        C.iso_utc_z("start").alias("start_date"),
        C.iso_local("start").alias("start_date_local"),
        F.lit(S.LOCAL_TZ_LABEL).alias("timezone"),
        F.col("comment").alias("comment"),
    )
    return fields.select(
        F.col("activity_id"),
        F.col("athlete_id"),
        F.to_json(doc, {"ignoreNullFields": "false"}).alias("payload"),
        F.lit(source).alias("source"),
    )


# -- sports practice ---------------------------------------------------------

def stage_sports(sport_rows: DataFrame, employees: DataFrame) -> DataFrame:
    """PRJ-25 + SET-1 + JON-7: drop NULL labels, deduplicate on the key, keep
    only known employees (semi join; no key set on the driver)."""
    clean = (sport_rows
             .dropna(subset=["sport_pratique"])
             .select(F.col("id_salarie").cast("bigint").alias("id_employee"), "sport_pratique")
             .dropDuplicates(["id_employee", "sport_pratique"]))
    known = employees.select("id_employee")
    return clean.join(known, "id_employee", "left_semi")


# -- SRT-1: surrogate key in a global order ------------------------------------

def written(df: DataFrame, scratch: str | None = None) -> DataFrame:
    """``df`` written once in the shared work folder and read back.  ``scratch`` names a
    database of managed tables, which go when their owner drops it."""
    spark = df.sparkSession
    if scratch:
        table = f"{scratch}.written_{uuid.uuid4().hex}"
        df.write.saveAsTable(table)
        return spark.table(table)
    path = work_path(spark, "tmp", f"written-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_order(rows: DataFrame, name: str = "place") -> DataFrame:
    """A globally sorted frame with each row's place: the sorted rows are written with
    their partition and position, and per-partition counts give the offsets."""
    mid = F.monotonically_increasing_id()
    kept = written(rows.withColumns({"_pid": F.shiftright(mid, 33), "_rn": mid.bitwiseAND(F.lit((1 << 33) - 1)) + 1}))
    return _numbered(kept, name, 1)


def _numbered(kept: DataFrame, name: str, start: int) -> DataFrame:
    """Dense numbers from written (partition, position) pairs."""
    counts = kept.groupBy("_pid").agg(F.max("_rn").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_pid", before.alias("_off"))  # a row per partition
    return (kept.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rn") + (start - 1)).cast("bigint"))
            .drop("_pid", "_rn", "_off"))


def surrogate_key(df: DataFrame, order_cols: list[str], name: str = "id",
                  start: int = 1, scratch: str | None = None) -> DataFrame:
    """Dense 1-based row number in ``order_cols`` order, without a one-partition window.

    Range-partition by the order and sort inside each partition; the
    position ``(partition, row)`` of every row is then its global order.
    That numbered frame is written once as a table in the shared work
    folder (``spark.checkpoint.dir``) and read back, so the per-partition
    counts and the rows come from the SAME physical partitions — two
    evaluations of a range exchange may sample different bounds or be
    coalesced differently by adaptive execution — and the lineage is cut
    (a lost executor re-reads the table, not the upstream plan).
    The offsets are one row per partition (bounded by the partition
    count), so their broadcast is size-checked by construction.
    ``order_cols`` must be a total order (include a unique key).
    """
    mid = F.monotonically_increasing_id()
    numbered = (df.repartitionByRange(*order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumns({"_pid": F.shiftright(mid, 33), "_rn": mid.bitwiseAND(F.lit((1 << 33) - 1)) + 1}))
    return _numbered(written(numbered, scratch), name, start)


def append_numbered(rows: DataFrame, order_cols: list[str], ranges: DataFrame | None, batch: str,
                    name: str = "id", scratch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """SRT-1 for arriving rows: they are numbered after all numbers given before, and no
    earlier row is touched.  ``ranges`` holds a row (batch, first_id, last_id) for each
    batch so far; returns the numbered rows and the batch's own range row.  Batches that
    arrive in order get the numbers that one numbering of all rows gives them."""
    last = ranges.agg(F.max("last_id")).first()[0] if ranges is not None else None
    start = (last or 0) + 1
    numbered = written(surrogate_key(rows, order_cols, name, start, scratch), scratch)
    own = numbered.agg(F.lit(batch).alias("batch"), F.lit(start).cast("bigint").alias("first_id"),
                       F.coalesce(F.max(name), F.lit(start - 1)).cast("bigint").alias("last_id"))
    return numbered, own


def trailing_window(df: DataFrame, ts_col: str, as_of: dt.datetime, days: int) -> DataFrame:
    """PRJ-24: ``ts >= as_of - days`` (no upper bound)."""
    start = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")
    return df.filter(F.col(ts_col) >= start)
